"""As-of, range, band and first-touch joins without cross products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, values: Sequence[str], exact: bool = True, tie: Sequence[str] = (), slice_size: int | None = None) -> DataFrame:
    """Each left row with the values of the last right row at or before it (``exact`` false: strictly before).

    One union and one window over ``keys``; of right rows of one instant the largest (``tie``, then values) counts. Left
    rows without a predecessor get NULLs. Columns of ``left`` stay; ``values`` must not clash with them. With
    ``slice_size`` the window is over slices of ``at``, and a slice starts from the last right row of those before it (a
    table of one row per slice), so that no task holds a whole key.
    """
    kinds = dict(left.dtypes)
    r = right.groupBy(*keys, at).agg(F.max(F.struct(*tie, *values)).alias("_r"))
    lefts = left.withColumns({"_r": F.lit(None).cast(dict(r.dtypes)["_r"]), "_side": F.lit(1 if exact else -1)})
    rights = r.withColumns({c: F.lit(None).cast(kinds[c]) for c in left.columns if c not in (*keys, at)} | {"_side": F.lit(0)})
    both = lefts.unionByName(rights.select(*lefts.columns))
    if slice_size is None:
        w = Window.partitionBy(*keys).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
        both = both.withColumn("_r", F.last("_r", ignorenulls=True).over(w))
    else:
        both = both.withColumn("_slice", _bucket(at, slice_size))
        ends = both.groupBy(*keys, "_slice").agg(F.max_by("_r", F.when(F.col("_side") == 0, F.col(at))).alias("_end"))
        earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select(*keys, "_slice", F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
        w = Window.partitionBy(*keys, "_slice").orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
        both = both.join(ends, [*keys, "_slice"]).withColumn("_r", F.coalesce(F.last("_r", ignorenulls=True).over(w), "_before")).drop("_slice", "_before")
    return both.where("_side <> 0").select(*left.columns, *(F.col(f"_r.{v}").alias(v) for v in values))


def _bucket(at: str, size: int) -> Column:
    """Which stretch of ``size`` an integer instant is in; whole numbers all the way, as a double can't tell nanoseconds apart."""
    return F.expr(f"(`{at}` - pmod(`{at}`, {size})) div {size}")


def range_join(events: DataFrame, path: DataFrame, keys: Sequence[str], at: str, path_at: str, horizon: int, keep: Sequence[str]) -> DataFrame:
    """Path rows in (at, at + horizon] of each event. Buckets of ``horizon`` bound the fan-out: an event meets at most two."""
    bucket = lambda c: _bucket(c, horizon)
    e = events.withColumn("_b", F.explode(F.array(bucket(at), bucket(at) + 1)))
    p = path.select(*keys, F.col(path_at).alias("_at"), *keep).withColumn("_b", bucket("_at"))
    return e.join(p, [*keys, "_b"]).where((F.col("_at") > F.col(at)) & (F.col("_at") <= F.col(at) + F.lit(horizon))).drop("_b")


def path_extremes(events: DataFrame, path: DataFrame, keys: Sequence[str], ident: Sequence[str], at: str, path_at: str, horizon: int, value: str, step: int = 1_000_000_000) -> DataFrame:
    """Greatest and least ``value`` and the number of path rows in (at, at + horizon] of each event: ``ident``, ``maior``, ``menor``, ``n``.

    The path is reduced to its extremes per ``step`` first; an event meets the whole steps inside its horizon, and rows only
    of the two steps that its ends cut. So a busy minute costs an event its seconds, not its trades. Events whose horizon
    holds no row have none in the result.
    """
    p = path.select(*keys, F.col(path_at).alias("_at"), F.col(value).alias("_v")).withColumn("_step", _bucket("_at", step))
    e = events.select(*ident, *(k for k in keys if k not in ident), F.col(at).alias("_from"))
    per = p.groupBy(*keys, "_step").agg(F.max("_v").alias("maior"), F.min("_v").alias("menor"), F.count("_v").alias("n"))
    whole = range_join(e, per.withColumn("_start", F.col("_step") * step), keys, "_from", "_start", horizon, ["maior", "menor", "n"])
    whole = whole.where(F.col("_at") + (step - 1) <= F.col("_from") + horizon).select(*ident, "maior", "menor", "n")
    ends = e.withColumn("_to", F.col("_from") + horizon).withColumns({"_a": _bucket("_from", step), "_b": _bucket("_to", step)})
    cut = F.filter(F.array_distinct(F.array("_a", "_b")), lambda s: (s == F.col("_a")) | ((s + 1) * step - 1 > F.col("_to")))
    edge = ends.withColumn("_step", F.explode(cut)).join(p, [*keys, "_step"]).where("_at > _from and _at <= _to")
    edge = edge.select(*ident, F.col("_v").alias("maior"), F.col("_v").alias("menor"), F.col("_v").isNotNull().cast("bigint").alias("n"))
    return whole.unionByName(edge).groupBy(*ident).agg(F.max("maior").alias("maior"), F.min("menor").alias("menor"), F.sum("n").alias("n"))


def first_hit(events: DataFrame, path: DataFrame, keys: Sequence[str], event_id: Sequence[str], at: str, path_at: str, horizon: int, keep: Sequence[str], hit: Column, order: Sequence[str]) -> DataFrame:
    """The first path row after each event, within ``horizon``, for which ``hit`` holds; one row per event that has one."""
    hits = range_join(events, path, keys, at, path_at, horizon, keep).where(hit)
    first = F.min_by(F.struct("_at", *keep), F.struct("_at", *order)).alias("_h")
    return hits.groupBy(*event_id).agg(first).select(*event_id, F.col("_h._at").alias("hit_at"), *(F.col(f"_h.{c}").alias(f"hit_{c}") for c in keep))


def has_within(a: DataFrame, b: DataFrame, keys: Sequence[str], at: str, tolerance: int) -> DataFrame:
    """Rows of ``a`` with a row of ``b`` of the same keys at most ``tolerance`` away on either side.

    Both sides meet in buckets of the tolerance (``b`` in its own and both neighbours), and inside one the nearest ``b`` on
    either side is read off the merged line: no pairs, and a hot key spreads over its buckets.
    """
    bucket = lambda c: _bucket(c, max(tolerance, 1))
    near = F.array(bucket(at) - 1, bucket(at), bucket(at) + 1)
    b1 = b.select(*keys, at).distinct().select(*keys, at, F.col(at).alias("_b"), F.explode(near).alias("_k"))
    kinds = dict(a.dtypes)
    lefts = a.withColumns({"_b": F.lit(None).cast(kinds[at]), "_k": bucket(at), "_l": F.lit(1)})
    rights = b1.withColumns({c: F.lit(None).cast(kinds[c]) for c in a.columns if c not in (*keys, at)} | {"_l": F.lit(0)})
    w = Window.partitionBy(*keys, "_k").orderBy(at)
    before = F.last("_b", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    after = F.first("_b", ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))
    close = F.coalesce(F.col(at) - before <= tolerance, F.lit(False)) | F.coalesce(after - F.col(at) <= tolerance, F.lit(False))
    return lefts.unionByName(rights.select(*lefts.columns)).withColumn("_n", close).where("_l = 1 and _n").select(*a.columns)
