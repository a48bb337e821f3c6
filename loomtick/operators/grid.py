"""Irregular readings onto a regular grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OBSERVED, INTERPOLATED, GAP = "observado", "interpolado", "lacuna"


def regular_grid(
    readings: DataFrame,
    source: Sequence[str],
    at: str,
    step: int,
    interpolate: Sequence[str] = (),
    add: Sequence[str] = (),
    gap_limit: int | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per source and grid cell, from the cell of its first reading to that of its last.

    ``at`` is an integer instant and cell ``k`` covers ``[k*step, (k+1)*step)``. The sorted grid and the sorted readings
    of a source are merged as-of: the grid instant ``k*step`` takes the last reading before it and the first one at or
    after it, and each column of ``interpolate`` gets the time-weighted linear value between both. If they are more than
    ``gap_limit`` apart (None: no limit) the value is NULL.

    Columns out: the source's, ``cell``, ``n`` (readings in the cell), for each ``interpolate`` column c ``c_grid`` (value
    at ``k*step``) and ``c_last`` (last in the cell, NULL in an empty one), for each ``add`` column ``c_sum`` (NULL in an
    empty cell), ``state``: ``observado`` (cell has a reading), ``interpolado`` (none, but the neighbours are within
    the limit) or ``lacuna``, and the as-of pair itself: ``anterior`` (instant of the last reading before ``k*step``, NULL if
    there is none) and ``seguinte`` (of the first one at or after it), which tells whether the cell is empty.

    Defined cases: rows with a NULL ``at`` are no readings; a NULL source value is a source of its own; a NULL value of an
    interpolated column is no neighbour of any grid point but counts in ``n``; readings of one instant are ordered by
    ``order`` and then by value, so ties and repeated rows give one result; before a source's first value there is nothing
    to interpolate and the value is NULL unless a reading lies on the grid instant; an empty input gives no rows; columns
    not named are ignored.

    Scale: readings are reduced to one row per source and cell before the only large shuffle, so a hot source costs no
    more there than its cells, and what one task holds of a source is its cells. A source should therefore hold a bounded
    span (a symbol and a day, not a symbol).
    """
    source, t = list(source), F.col(at)
    aggs = [F.count(F.lit(1)).alias("n"), F.min(t).alias("_f"), F.max(t).alias("_l")]
    for c in interpolate:
        reading = F.when(F.col(c).isNotNull(), F.struct(t.alias("at"), *(F.col(o).alias(f"o{i}") for i, o in enumerate(order)), F.col(c).cast("double").alias("v")))
        aggs += [F.min(reading).alias(f"_f_{c}"), F.max(reading).alias(f"_l_{c}")]
    aggs += [F.sum(c).alias(f"{c}_sum") for c in add]
    cells = readings.where(t.isNotNull()).groupBy(*source, F.expr(f"(`{at}` - pmod(`{at}`, {step})) div {step}").alias("_c")).agg(*aggs)

    w = Window.partitionBy(*source).orderBy("_c")
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    onward = w.rowsBetween(0, Window.unboundedFollowing)
    merged = cells.withColumns(
        {"_from": F.coalesce(F.lag("_c").over(w) + 1, F.col("_c")), "anterior": F.last("_l").over(upto), "seguinte": F.first("_f").over(onward)}
        | {f"_b_{c}": F.last(f"_l_{c}", ignorenulls=True).over(upto) for c in interpolate}
        | {f"_a_{c}": F.first(f"_f_{c}", ignorenulls=True).over(onward) for c in interpolate}
    )
    points = merged.withColumn("cell", F.explode(F.sequence("_from", "_c")))
    here = ~_between(F.col("anterior"), F.col("seguinte"), step)
    out, near = [], F.lit(True)
    for c in interpolate:
        b, a, g = F.col(f"_b_{c}"), F.col(f"_a_{c}"), F.col("cell") * F.lit(step)
        span = a["at"] - b["at"]
        share = (g - b["at"]).cast("double") / span.cast("double")
        within = F.coalesce(span <= F.lit(gap_limit), F.lit(False)) if gap_limit is not None else span.isNotNull()
        value = F.when(a["at"] == g, a["v"]).when(within, b["v"] + (a["v"] - b["v"]) * share)
        out += [value.alias(f"{c}_grid"), F.when(here, F.col(f"_l_{c}")["v"]).alias(f"{c}_last")]
        near = near & within
    out += [F.when(here, F.col(f"{c}_sum")).alias(f"{c}_sum") for c in add]
    state = F.when(here, OBSERVED).when(near, INTERPOLATED).otherwise(GAP)
    return points.select(*source, "cell", F.when(here, F.col("n")).otherwise(0).cast("bigint").alias("n"), *out, state.alias("state"), "anterior", "seguinte")


def _between(before: Column, after: Column, step: int) -> Column:
    """Whether the as-of pair of a grid instant leaves its cell empty: the last reading before it and the first one not before the next instant."""
    return F.coalesce((before < F.col("cell") * F.lit(step)) & (after >= (F.col("cell") + 1) * F.lit(step)), F.lit(False))


def missing_cells(grid: DataFrame, step: int) -> DataFrame:
    """The grid's cells without any reading, by their as-of neighbours."""
    return grid.where(_between(F.col("anterior"), F.col("seguinte"), step))
