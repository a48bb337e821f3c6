"""Randomised tests whose draws are hashes, so every run and every partitioning gives the same ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def uniform(*parts: Column, seed: int = 7) -> Column:
    """A number in (0, 1) from a hash of the parts."""
    return (F.pmod(F.xxhash64(*parts, F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def persistence(flows: DataFrame, keys: Sequence[str], agent: str, day: str, value: str) -> DataFrame:
    """Per key and agent the matched flow of consecutive days: min(|v|, |next|) with the sign of v·next; ``k`` numbers the later day."""
    w = Window.partitionBy(*keys, agent).orderBy("_d")
    n = flows.withColumn("_d", F.dense_rank().over(Window.partitionBy(*keys).orderBy(day)))
    nxt, nd = F.lead(value).over(w), F.lead("_d").over(w)
    pair = F.when(nd == F.col("_d") + 1, F.least(F.abs(value), F.abs(nxt)) * F.signum(value) * F.signum(nxt))
    return n.withColumn("casado", pair).where("casado is not null").select(*keys, agent, (F.col("_d") + 1).alias("k"), F.col("casado").cast("double").alias("casado"))


def sign_flip_test(matched: DataFrame, keys: Sequence[str], agent: str, draws: int = 1000, seed: int = 2026) -> DataFrame:
    """Observed S, its z and one-sided p against independent signs per agent and day (the first day's fixed).

    Draws × transitions are exploded, summed map-side and never collected: S of a draw is one sum.
    """
    sign = lambda day, r: F.when(day <= 1, 1.0).otherwise(F.when(uniform(F.col(agent), day, r, seed=seed) < 0.5, -1.0).otherwise(1.0))
    rows = matched.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(draws))))  # draw 0 is the observation
    flipped = F.when(F.col("_r") == 0, F.col("casado")).otherwise(F.col("casado") * sign(F.col("k") - 1, F.col("_r")) * sign(F.col("k"), F.col("_r")))
    s = rows.groupBy(*keys, "_r").agg(F.sum(flipped).alias("s"))
    seen = s.where("_r = 0").select(*keys, F.col("s").alias("estatistica"))
    null = s.where("_r > 0").join(seen, list(keys)) if keys else s.where("_r > 0").crossJoin(F.broadcast(seen))
    out = null.groupBy(*keys, "estatistica").agg(F.avg("s").alias("_m"), F.stddev_pop("s").alias("_sd"), ((1 + F.count_if(F.col("s") >= F.col("estatistica"))) / F.lit(1.0 + draws)).alias("p"))
    return out.select(*keys, "estatistica", F.when(F.col("_sd") > 0, (F.col("estatistica") - F.col("_m")) / F.col("_sd")).alias("z"), "p")


def permuted(rows: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], seed: int = 7) -> DataFrame:
    """The rows with ``columns`` permuted jointly inside each key: the i-th row gets those of the i-th by a hash of its own order."""
    spot = Window.partitionBy(*keys)
    numbered = rows.withColumns({"_i": F.row_number().over(spot.orderBy(*order)), "_h": F.row_number().over(spot.orderBy(F.xxhash64(*order, F.lit(seed)), *order))})
    moved = numbered.select(*keys, F.col("_h").alias("_i"), *(F.col(c).alias(c) for c in columns))
    return numbered.drop("_h", *columns).join(moved, [*keys, "_i"]).drop("_i").select(*rows.columns)


def random_walk_tape(spark: SparkSession, days: int, trades: int, tick: float = 5.0, start: float = 140_000.0, seed: int = 1) -> DataFrame:
    """A tape without any information, for honesty gates: steps of −1, 0, 1 ticks, random sides, sizes and brokers; one trade a second from 12:00 UTC."""
    rows = spark.range(days * trades).select((F.col("id") / trades).cast("bigint").alias("_d"), F.pmod("id", F.lit(trades)).alias("_t"), "id")
    pick = lambda name, n: F.floor(uniform(F.col("id"), F.lit(name), seed=seed) * n).cast("bigint")
    rows = rows.withColumn("_s", pick("passo", 3) - 1)
    walk = F.sum("_s").over(Window.partitionBy("_d").orderBy("_t").rowsBetween(Window.unboundedPreceding, 0))
    day = F.date_add(F.lit("2018-01-08").cast("date"), F.col("_d").cast("int"))
    ts = F.unix_date(day).cast("bigint") * 86_400_000_000_000 + F.lit(43_200_000_000_000) + F.col("_t") * 1_000_000_000
    return rows.select(
        ts.alias("ts_ns"), (ts + 1_000_000).alias("ts_recv_ns"), F.lit("RUIDO").alias("symbol"), F.date_format(day, "yyyy-MM-dd").alias("dt"), (F.col("_t") + 1).alias("trade_id"),
        (F.lit(start) + tick * walk).alias("price"), (1 + pick("qtd", 10)).alias("quantidade"), (1 + pick("c", 40)).alias("agente_comprador"), (1 + pick("v", 40)).alias("agente_vendedor"), (2 + pick("lado", 2)).alias("trade_type"),
    )


def matched_control(rows: DataFrame, stratum: Sequence[str], signal: str, ident: Sequence[str], seed: int = 7) -> DataFrame:
    """As many rows without the signal as with it, per stratum, drawn by hash: a time-matched control. Adds ``grupo``."""
    own = rows.where(F.col(signal))
    want = own.groupBy(*stratum).agg(F.count(F.lit(1)).alias("_n"))
    rest = rows.where(~F.col(signal)).join(want, list(stratum))
    w = Window.partitionBy(*stratum).orderBy(F.xxhash64(*ident, F.lit(seed)), *ident)
    drawn = rest.withColumn("_r", F.row_number().over(w)).where("_r <= _n").drop("_r", "_n")
    return own.withColumn("grupo", F.lit("sinal")).unionByName(drawn.withColumn("grupo", F.lit("controle")))
