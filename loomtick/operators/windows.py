"""Window idioms: strict-past scores, islands, carried values, running statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

FLAT_SD = 1e-12


def strict_past_z(x: Column, by: WindowSpec, rows: int, least: int | None = None) -> Column:
    """(x − mean)/sd over the ``rows`` rows before the current one; NULL below ``least`` values or for a flat window."""
    w = by.rowsBetween(-rows, -1)
    sd = F.stddev_samp(x).over(w)
    return F.when((F.count(x).over(w) >= (max(2, rows // 2) if least is None else least)) & (sd > FLAT_SD), (x - F.avg(x).over(w)) / sd)


def valid_only_z(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, rows: int, name: str) -> DataFrame:
    """A full-window strict-past score over the last ``rows`` *valid* values: NULL rows are skipped, and get no score."""
    valid = df.where(F.col(column).isNotNull())
    scored = valid.withColumn(name, strict_past_z(F.col(column), Window.partitionBy(*keys).orderBy(*order), rows, rows))
    return scored.unionByName(df.where(F.col(column).isNull()).withColumn(name, F.lit(None).cast("double")))


def full_window(agg: Column, x: Column, by: WindowSpec, first: int, last: int) -> Column:
    """An aggregate over rows first..last, NULL until the window is full."""
    w = by.rowsBetween(first, last)
    return F.when(F.count(x).over(w) == last - first + 1, agg.over(w))


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], starts: Column, name: str = "ilha") -> DataFrame:
    """Numbers runs of rows from 1: ``starts`` (with lags over the same window) says where a new one begins."""
    w = Window.partitionBy(*keys).orderBy(*order)
    flagged = df.withColumn("_s", F.when(F.coalesce(starts, F.lit(True)), 1).otherwise(0))
    return flagged.withColumn(name, F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint")).drop("_s")


def carried(x: Column, by: WindowSpec, strictly: bool = False) -> Column:
    """The last value that isn't NULL, up to the current row or strictly before it."""
    return F.last(x, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1 if strictly else 0))


def sliced_running_sum(df: DataFrame, keys: Sequence[str], at: str, slice_size: int, order: Sequence[str], sums: dict[str, Column], before: bool = True, enrich: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Running sums in two levels, so that a long key isn't one task's work: adds each of ``sums`` (``before``: without the
    current row) and ``<name>_all``, the key's total.

    Rows are summed per slice of ``at`` first; a window over a key's slices gives what came earlier, and a window inside
    each slice the rest. Integers stay exact; doubles are added slice by slice. NULLs add nothing. ``enrich`` may add
    columns to the table of slices (keys and totals), which then reach every row without a further join.
    """
    rows = df.withColumn("_slice", F.expr(f"(`{at}` - pmod(`{at}`, {slice_size})) div {slice_size}"))
    rows = rows.withColumns({f"_x_{n}": F.coalesce(c, F.lit(0)) for n, c in sums.items()})
    per = rows.groupBy(*keys, "_slice").agg(*(F.sum(f"_x_{n}").alias(f"_s_{n}") for n in sums))
    key = Window.partitionBy(*keys)
    earlier = key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, "_slice", *(F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums), *(F.sum(f"_s_{n}").over(key).alias(f"{n}_all") for n in sums))
    per = enrich(per) if enrich else per
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    out = rows.join(per, [*keys, "_slice"])
    out = out.withColumns({n: F.col(f"_o_{n}") + F.coalesce(F.sum(f"_x_{n}").over(inside), F.lit(0)) for n in sums})
    return out.drop("_slice", *(f"_x_{n}" for n in sums), *(f"_o_{n}" for n in sums))


def with_previous(df: DataFrame, keys: Sequence[str], at: str, slice_size: int, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Adds ``_prev``: a struct of ``columns`` of the row before in the key's order (NULL for its first row), in two levels.

    Inside a slice of ``at`` it is a lag; a slice's first row takes the last row of the nearest earlier slice, from a table
    of one row per slice. So no task sorts a whole key.
    """
    rows = df.withColumn("_slice", F.expr(f"(`{at}` - pmod(`{at}`, {slice_size})) div {slice_size}"))
    row = F.struct(*columns)
    ends = rows.groupBy(*keys, "_slice").agg(F.max_by(row, F.struct(*order)).alias("_end"))
    ends = ends.select(*keys, "_slice", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_end"))
    inside = F.lag(row).over(Window.partitionBy(*keys, "_slice").orderBy(*order))
    return rows.join(ends, [*keys, "_slice"]).withColumn("_prev", F.coalesce(inside, "_end")).drop("_slice", "_end")


def average_rank(x: Column, keys: Sequence[Column | str]) -> Column:
    """Rank with ties averaged."""
    w = Window.partitionBy(*keys).orderBy(x)
    return F.rank().over(w) + (F.count(F.lit(1)).over(Window.partitionBy(*keys, x)) - 1) / F.lit(2.0)


def drawdown(df: DataFrame, keys: Sequence[str], order: Sequence[str], pnl: str) -> DataFrame:
    """Cumulative result, its running maximum (from an origin of 0) and the fall from it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("acumulado", F.sum(pnl).over(w))
    out = out.withColumn("topo", F.greatest(F.max("acumulado").over(w), F.lit(0.0)))
    return out.withColumn("queda", F.col("acumulado") - F.col("topo"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson's coefficient; NULL for a constant column (the built-in divides by zero there)."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
