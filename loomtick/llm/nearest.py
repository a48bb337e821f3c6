"""Matching records by nearest time through tick expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nearest_by_ticks(left: DataFrame, right: DataFrame, tolerance: int, tick: int) -> DataFrame:
    """Pairs every left record with the nearest right record of its entity, before or after, at most ``tolerance`` apart (inclusive).

    ``left`` has ``entity``, ``at`` (integer instant) and ``left_id``; ``right`` has ``entity``, ``at`` and ``right_id``.
    Columns out: ``left_id``, ``right_id``, ``distance`` (right minus left). Left records without a partner have no row.

    Each right record is exploded to every tick (of length ``tick``) that its tolerance reaches. Of a tick only the
    nearest remain: the last record before it, the first one after it, and the distinct instants inside it. Left records
    meet them on (entity, tick), and a window over the tick's few rows takes the nearest on either side, so the answer is
    exact although a tick is coarser than the instants, and no pairs are formed.

    Defined cases: NULL entities, instants or ids take no part; of right records of one instant the smallest id counts; of
    two at the same distance on either side the smaller id; repeated left rows give repeated results; empty tables give no
    rows; other columns are ignored.

    Scale: right records far from any left record leave before the explosion (semi-join on cells of the tolerance), and
    every shuffle is keyed by entity and time, so an entity with a third of all rows spreads over its ticks. What one
    task holds together is a tick of one entity, at most its distinct instants.
    """
    lft = left.select("entity", F.col("at").cast("bigint").alias("at"), "left_id").where("entity is not null and at is not null and left_id is not null")
    rgt = right.select("entity", F.col("at").cast("bigint").alias("at"), "right_id").where("entity is not null and at is not null and right_id is not null")
    floor = lambda c, by: f"(({c}) - pmod({c}, {by})) div {by}"

    reach = max(tolerance, 1)
    cells = lft.select("entity", F.expr(floor("at", reach)).alias("c")).distinct()
    cells = cells.select("entity", F.explode(F.array(F.col("c") - 1, F.col("c"), F.col("c") + 1)).alias("cell")).distinct()
    near = rgt.withColumn("cell", F.expr(floor("at", reach))).join(cells, ["entity", "cell"], "left_semi")
    single = near.groupBy("entity", "at").agg(F.min("right_id").alias("right_id"))

    own = F.expr(floor("at", tick))
    spread = single.withColumn("tick", F.explode(F.sequence(F.expr(floor(f"at - {tolerance}", tick)), F.expr(floor(f"at + {tolerance}", tick)))))
    who = F.struct("at", "right_id")
    before = F.max(F.when(own < F.col("tick"), who))
    after = F.min(F.when(own > F.col("tick"), who))
    sides = spread.where(own != F.col("tick")).groupBy("entity", "tick").agg(before.alias("b"), after.alias("a"))
    outside = sides.select("entity", "tick", F.explode(F.array("b", "a")).alias("w")).where("w is not null").select("entity", "tick", "w.at", "w.right_id")
    inside = single.select("entity", own.alias("tick"), "at", "right_id")

    rights = outside.unionByName(inside).select("entity", "tick", "at", F.lit(None).cast(dict(lft.dtypes)["left_id"]).alias("left_id"), who.alias("r"))
    lefts = lft.select("entity", own.alias("tick"), "at", "left_id", F.lit(None).cast(dict(rights.dtypes)["r"]).alias("r"))
    w = Window.partitionBy("entity", "tick").orderBy("at")
    met = rights.unionByName(lefts).select(
        "left_id", "at",
        F.last("r", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("b"),
        F.first("r", ignorenulls=True).over(w.rangeBetween(Window.currentRow, Window.unboundedFollowing)).alias("a"),
    )
    option = lambda c: F.when(F.abs(F.col(f"{c}.at") - F.col("at")) <= tolerance, F.struct(F.abs(F.col(f"{c}.at") - F.col("at")).alias("d"), F.col(f"{c}.right_id").alias("right_id"), F.col(f"{c}.at").alias("at")))
    best = met.where("left_id is not null").select("left_id", "at", F.array_min(F.array_compact(F.array(option("b"), option("a")))).alias("n"))
    return best.where("n is not null").select("left_id", "n.right_id", (F.col("n.at") - F.col("at")).alias("distance"))
