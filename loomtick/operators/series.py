"""Folds over ordered series: what no window function says, streamed through sorted partitions as Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Rows of finished groups that are sent on together.
_ROWS = 50_000


def _starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Where the keys change; NULLs are equal to each other."""
    new = np.zeros(len(table), bool)
    if len(table):
        new[0] = True
    for k in keys:
        col = table[k].combine_chunks()
        a, b = col.slice(1), col.slice(0, max(len(col) - 1, 0))
        differs = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
        new[1:] |= differs.to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def fold_series(df: DataFrame, keys: Sequence[str], order: Sequence[str], inputs: Sequence[str], fold: Callable[..., dict], new: str, keep: str | None = None) -> DataFrame:
    """Adds the columns ``new`` (DDL) that ``fold`` makes of each key's rows in ``order``.

    ``fold`` gets the ``inputs`` as arrays (numbers; NULL is NaN) and answers with arrays of the same length. With ``keep``
    its boolean array of that name chooses the rows that stay. Other columns pass through as they are, whatever their
    types. One exchange and one sort by the keys; what a task holds of a key is its series, so keys should bound it (a
    symbol's day of bars or events, not of ticks). Empty input gives no rows.
    """
    added = T._parse_datatype_string(new) if new else T.StructType([])
    schema = T.StructType([*df.schema.fields, *added.fields])
    clash = {f.name for f in added.fields} & set(df.columns)
    if clash:
        raise ValueError(f"these columns are there already: {sorted(clash)}")

    def done(table: pa.Table, starts: Sequence[int]) -> pa.RecordBatch:
        cols = [table[c].to_numpy() for c in inputs]
        parts: dict[str, list] = {}
        for lo, hi in zip(starts, [*starts[1:], len(table)]):
            for name, values in fold(*(c[lo:hi] for c in cols)).items():
                parts.setdefault(name, []).append(values)
        for f in added.fields:
            values = np.concatenate(parts[f.name])
            table = table.append_column(f.name, pa.array(values, from_pandas=True).cast(_ARROW[f.dataType.typeName()]))
        return table if keep is None else table.filter(pa.array(np.concatenate(parts[keep]).astype(bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= _ROWS:
                table = pa.Table.from_batches(held).combine_chunks()
                starts = _starts(table, keys)
                last = int(starts[-1])  # the last group may go on
                if last:
                    yield from done(table.slice(0, last), starts[:-1].tolist()).to_batches()
                    table = table.slice(last)
                held, rows = table.to_batches(), len(table)
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from done(table, _starts(table, keys).tolist()).to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


_ARROW = {"double": pa.float64(), "long": pa.int64(), "integer": pa.int32(), "boolean": pa.bool_()}
