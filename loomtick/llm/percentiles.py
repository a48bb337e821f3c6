"""Percentiles of very large numeric columns from mergeable digests with a deterministic rank error."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values fall into a universe of 2**BITS ordered codes: a sign, an exponent and FRACTION bits of the fraction.
FRACTION, BITS = 20, 32
_HALF, _LOW = 1 << (BITS - 1), -1022


def code_of(value: Column) -> Column:
    """The ordered code of a number, exact for integers below 2**21 and to a part in 2**20 for the rest (towards zero).

    NULL and NaN have none; infinities fall on the ends, numbers nearer to zero than 2**-1022 on zero. Whether log2 rounds up
    or down at a power of two doesn't matter: both give the same code.
    """
    x = value.cast("double")
    size = F.least(F.abs(x), F.lit(1.7976931348623157e308))
    e = F.least(F.greatest(F.floor(F.log2(size)), F.lit(_LOW)), F.lit(1023))
    half = F.when(e > 0, F.pow(F.lit(2.0), e - F.lit(1)) * F.lit(2.0)).otherwise(F.pow(F.lit(2.0), e))  # no overflow at the top
    code = (e - F.lit(_LOW)) * F.lit(1 << FRACTION) + F.floor((size / half - F.lit(1.0)) * F.lit(float(1 << FRACTION))) + F.lit(1)
    code = F.when(size < F.lit(2.0**_LOW), F.lit(0)).otherwise(code.cast("bigint"))
    signed = F.when(x < 0, F.lit(_HALF) - code).otherwise(F.lit(_HALF) + code)
    return F.when(x.isNotNull() & ~F.isnan(x), F.least(F.greatest(signed, F.lit(0)), F.lit((1 << BITS) - 1)))


def value_of(code: np.ndarray) -> np.ndarray:
    """The number of least size that has the code."""
    signed = np.asarray(code, np.int64) - _HALF
    size = np.abs(signed) - 1
    value = np.ldexp(1.0 + (size % (1 << FRACTION)) / float(1 << FRACTION), (size >> FRACTION) + _LOW)
    return np.where(signed == 0, 0.0, np.sign(signed) * value)


def _added(group: np.ndarray, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal nodes of a group added; sorted by group and node."""
    if not len(node):
        return group, node, count
    order = np.lexsort((node, group))
    group, node, count = group[order], node[order], count[order]
    first = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (node[1:] != node[:-1])])
    return group[first], node[first], np.add.reduceat(count, first)


def compress(group: np.ndarray, node: np.ndarray, count: np.ndarray, k: int, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dyadic-tree counts with light children moved to their parent, all groups at once, level by level from the leaves.

    A node is 1 for the root and 2n, 2n+1 for the halves of n, so leaf ``c`` is ``2**bits + c``. A pair of siblings whose
    counts with their parent's are at most ``n div k`` (n: the group's count) becomes the parent's. Each count may be
    lifted once a level, so ranks err by at most ``bits * n / k``; that adds up over parts, as their n do.
    """
    group, node, count = _added(group, node, count)
    if not len(node):
        return group, node, count
    limit = np.bincount(group, weights=count).astype(np.int64) // k
    if not limit.any():
        return group, node, count
    level = np.frexp(node.astype(np.float64))[1] - 1
    at = [(group[m], node[m], count[m]) for m in (level == lv for lv in range(bits + 1))]
    kept = []
    for lv in range(bits, 0, -1):
        g, n, c = at[lv]
        if not len(n):
            continue
        up = n >> 1
        first = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (up[1:] != up[:-1])])
        pg, pn, pc = g[first], up[first], np.add.reduceat(c, first)
        og, on, oc = at[lv - 1]
        both = np.zeros(len(pn), np.int64)
        if len(on):  # the parents' own counts
            ix = np.searchsorted(og * (1 << (bits + 1)) + on, pg * (1 << (bits + 1)) + pn)
            hit = ix < len(on)
            hit[hit] = (og[ix[hit]] == pg[hit]) & (on[ix[hit]] == pn[hit])
            both[hit] = oc[ix[hit]]
        lift = pc + both <= limit[pg]
        stay = ~np.repeat(lift, np.diff(np.r_[first, len(n)]))
        kept.append((g[stay], n[stay], c[stay]))
        at[lv - 1] = _added(np.r_[og, pg[lift]], np.r_[on, pn[lift]], np.r_[oc, pc[lift]])
    kept.append(at[0])
    return _added(*(np.concatenate(x) for x in zip(*kept)))


def quantiles(node: np.ndarray, count: np.ndarray, shares: Sequence[float], bits: int = BITS) -> np.ndarray:
    """Codes at the given shares: nodes in the order of their upper ends, smaller ranges first; the first that reaches the rank."""
    level = np.frexp(node.astype(np.float64))[1] - 1
    shift = bits - level
    upper = ((node + 1) << shift) - 1 - (1 << bits)
    order = np.lexsort((shift, upper))
    cum = np.cumsum(count[order])
    ranks = np.maximum(np.ceil(np.asarray(shares) * cum[-1]), 1)
    return upper[order][np.searchsorted(cum, ranks)]


class _Digests:
    """Digests of many groups under construction; compressed whenever they have grown by ``most`` entries."""

    def __init__(self, k: int, most: int = 2_000_000) -> None:
        self.k, self.most, self.names, self.parts, self.held = k, most, {}, [], 0

    def add(self, names: Sequence[tuple], group: np.ndarray, node: np.ndarray, count: np.ndarray) -> None:
        index = np.array([self.names.setdefault(n, len(self.names)) for n in names], np.int64)
        self.parts.append(_added(index[group], node, count) if len(node) else (group, node, count))
        self.held += len(self.parts[-1][1])
        if self.held > self.most:
            self.shrink()
            self.most = max(self.most, 2 * self.held)

    def shrink(self) -> None:
        if self.parts:
            self.parts = [compress(*(np.concatenate(x) for x in zip(*self.parts)), self.k)]
            self.held = len(self.parts[0][1])

    def rows(self) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
        self.shrink()
        if not self.names or not self.parts:
            return
        g, n, c = self.parts[0]
        ends = np.searchsorted(g, np.arange(len(self.names) + 1))
        for name, i in self.names.items():
            if ends[i + 1] > ends[i]:
                yield name, n[ends[i] : ends[i + 1]], c[ends[i] : ends[i + 1]]


def _packed(counts: np.ndarray) -> bytes:
    return counts.astype(np.int32 if counts.max(initial=0) < 2**31 else np.int64).tobytes()


def _unpacked(counts: bytes, n: int) -> np.ndarray:
    return np.frombuffer(counts, np.int32 if len(counts) == 4 * n else np.int64).astype(np.int64)


def digests(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column], error: float = 0.002, fan_in: int = 64) -> DataFrame:
    """One q-digest per group and measure: the keys, ``medida``, ``n``, ``nodes`` and ``counts`` (little-endian integers).

    Ranks taken from a digest, or from digests merged by :func:`merge_digests`, err by at most ``error * n``. NULL and NaN
    values don't count; a group without values has no digest; NULL keys are a group of their own. Values are quantized as
    in :func:`code_of`. Ties and repeated rows only raise counts; an empty table gives no digests.

    Scale: every input partition makes its own digests, so rows are never shuffled and a group with a third of all
    rows costs the merging tasks one digest of at most ``3 * BITS / error`` nodes a partition. Merging is a tree: at most
    ``fan_in`` partitions' digests first, then those.
    """
    k = int(np.ceil(BITS / error))
    names = list(measures)
    kinds = dict(df.dtypes)
    cols = [f"k{i}" for i in range(len(keys))]
    ddl = ", ".join(f"{c} {kinds[b]}" for c, b in zip(cols, keys)) + ", medida string, parte bigint, n bigint, nodes binary, counts binary"

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _Digests(k)
        for pdf in batches:
            if pdf.empty:
                continue
            group, names_ = _groups(pdf, cols)
            for m, name in enumerate(names):
                code = pdf[f"m{m}"].to_numpy()
                ok = ~pd.isna(code)
                if ok.any():
                    own.add([(*g, name) for g in names_], group[ok], code[ok].astype(np.int64) + (1 << BITS), np.ones(int(ok.sum()), np.int64))
        yield from _frames(own, cols, TaskContext.get().partitionId() // fan_in)

    picked = df.select(*(F.col(b).alias(c) for b, c in zip(keys, cols)), *(code_of(measures[n]).alias(f"m{m}") for m, n in enumerate(names)))
    parts = picked.mapInPandas(partial, ddl)
    merged = _merge(_merge(parts, cols, ddl, k, True), cols, ddl, k, False)
    return merged.select(*(F.col(c).alias(b) for b, c in zip(keys, cols)), "medida", "n", "nodes", "counts")


def merge_digests(parts: DataFrame, keys: Sequence[str], error: float = 0.002) -> DataFrame:
    """Digests of parts (days, partitions) as one per key and ``medida``, by adding nodes. ``error`` must be that of the parts."""
    cols = [f"k{i}" for i in range(len(keys))]
    kinds = dict(parts.dtypes)
    ddl = ", ".join(f"{c} {kinds[b]}" for c, b in zip(cols, keys)) + ", medida string, parte bigint, n bigint, nodes binary, counts binary"
    rows = parts.select(*(F.col(b).alias(c) for b, c in zip(keys, cols)), "medida", F.lit(0).cast("bigint").alias("parte"), "n", "nodes", "counts")
    return _merge(rows, cols, ddl, int(np.ceil(BITS / error)), False).select(*(F.col(c).alias(b) for b, c in zip(keys, cols)), "medida", "n", "nodes", "counts")


def _groups(pdf: pd.DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, list[tuple]]:
    group = np.zeros(len(pdf), np.int64)
    for c in cols:
        code, values = pd.factorize(pdf[c], use_na_sentinel=False)
        group = group * (len(values) + 1) + code
    _, first, group = np.unique(group, return_index=True, return_inverse=True)
    heads = pdf[list(cols)].iloc[first].itertuples(index=False, name=None)
    return group, [tuple(None if pd.isna(v) else v for v in head) for head in heads]


def _frames(own: _Digests, cols: Sequence[str], part: int) -> Iterator[pd.DataFrame]:
    rows = [(*name, part, int(c.sum()), n.tobytes(), _packed(c)) for name, n, c in own.rows()]
    if rows:
        yield pd.DataFrame(rows, columns=[*cols, "medida", "parte", "n", "nodes", "counts"])


def _merge(parts: DataFrame, cols: Sequence[str], ddl: str, k: int, by_part: bool) -> DataFrame:
    by = [*cols, "medida", *["parte"] * by_part]

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, names = _Digests(k), None
        for pdf in batches:
            for key, nodes, counts in zip(pdf[by].itertuples(index=False, name=None), pdf.nodes, pdf.counts):
                key = tuple(None if pd.isna(v) else v for v in key)
                if names is not None and key != names and len(own.names) >= 256:  # sorted: these groups are complete
                    yield from _part_frames(own, cols) if by_part else _frames(own, cols, 0)
                    own = _Digests(k)
                names = key
                node = np.frombuffer(nodes, np.int64)
                own.add([key], np.zeros(len(node), np.int64), node, _unpacked(counts, len(node)))
        yield from _part_frames(own, cols) if by_part else _frames(own, cols, 0)

    return parts.repartition(*by).sortWithinPartitions(*by).mapInPandas(merge, ddl)


def _part_frames(own: _Digests, cols: Sequence[str]) -> Iterator[pd.DataFrame]:
    rows = [(*name, int(c.sum()), n.tobytes(), _packed(c)) for name, n, c in own.rows()]
    if rows:
        yield pd.DataFrame(rows, columns=[*cols, "medida", "parte", "n", "nodes", "counts"])


def percentiles(digest: DataFrame, keys: Sequence[str], shares: Mapping[str, float]) -> DataFrame:
    """The digests' values at the given shares, a double column each, with ``n``."""
    kinds = dict(digest.dtypes)
    head = [*keys, "medida", "n"]
    ddl = ", ".join(f"`{c}` {kinds[c]}" for c in head) + "".join(f", {s} double" for s in shares)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes = [quantiles(np.frombuffer(n, np.int64), _unpacked(c, len(n) // 8), list(shares.values())) for n, c in zip(pdf.nodes, pdf.counts)]
            got = value_of(np.array(codes).reshape(len(pdf), len(shares)))
            yield pd.concat([pdf[head].reset_index(drop=True), pd.DataFrame(got, columns=list(shares))], axis=1)

    return digest.select(*head, "nodes", "counts").mapInPandas(look, ddl)
