"""Walk-forward evaluation and inference."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def walk_forward(days: DataFrame, day: str, train: int, test: int) -> DataFrame:
    """Each day with its ``fold``: expanding training over whole days, test blocks of ``test`` days from day ``train`` on (NULL before)."""
    n = F.dense_rank().over(Window.orderBy(day))  # distinct days only: a few thousand rows at most
    k = days.select(day).distinct().withColumn("_n", n)
    return k.select(day, F.when(F.col("_n") > train, F.floor((F.col("_n") - 1 - train) / test)).cast("bigint").alias("fold"))


def information_coefficient(rows: DataFrame, keys: Sequence[str], x: str, y: str, least: int = 10) -> DataFrame:
    """Spearman's correlation per key, NULL below ``least`` pairs or for a constant column."""
    from .windows import average_rank, correlation

    pairs = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = pairs.withColumns({"_x": average_rank(F.col(x), keys), "_y": average_rank(F.col(y), keys)})
    usable = (F.count(F.lit(1)) >= least) & (F.stddev_samp("_x") > 0) & (F.stddev_samp("_y") > 0)
    return ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.when(usable, correlation(F.col("_x"), F.col("_y"))).alias("ic"))


def welch_t(mean_a: Column, var_a: Column, n_a: Column, mean_b: Column, var_b: Column, n_b: Column) -> Column:
    se = F.sqrt(var_a / n_a + var_b / n_b)
    return F.when((n_a >= 2) & (n_b >= 2) & (se > 1e-12), (mean_a - mean_b) / se)


def verdict(folds: Column, n: Column, mean: Column, t: Column, consistency: Column, t_critical: Column, least_folds: int = 4, least: float = 0.7, power: float | None = 0.85) -> Column:
    """``segue`` if the mean coefficient exceeds 2/√n, |t| over folds the critical value, and enough folds have one sign; without
    enough folds or a t, or (with ``power``) if only stability is missing while that share of folds agrees: ``inconclusivo``; else ``descarta``."""
    large, stable = F.abs(mean) >= 2 / F.sqrt(F.greatest(n, F.lit(1))), F.abs(t) >= t_critical
    open_ = large & ~stable & (consistency >= power) if power is not None else F.lit(False)
    return F.when((folds < least_folds) | t.isNull(), "inconclusivo").when(large & stable & (consistency >= least), "segue").when(open_, "inconclusivo").otherwise("descarta")


def quantile_bucket(rows: DataFrame, keys: Sequence[str], x: str, n: int, name: str = "quintil") -> DataFrame:
    """Bins of equal count by the keys' own quantiles (linear interpolation), closed on the right, repeated edges dropped. NULLs have none."""
    shares = F.array(*(F.lit(i / n) for i in range(1, n)))
    edges = rows.groupBy(*keys).agg(F.percentile(x, shares).alias("_e"))
    bin_ = 1 + F.size(F.filter(F.array_distinct("_e"), lambda e: F.col(x) > e))
    return rows.join(edges, list(keys)).withColumn(name, F.when(F.col(x).isNotNull(), bin_).cast("bigint")).drop("_e")


def day_bootstrap(days: DataFrame, day: str, total: str, count: str, replicas: int, seed: int = 7) -> DataFrame:
    """Block bootstrap of a mean by whole days: per replica the mean over days drawn with replacement.

    Only Σ and n of each day travel. Every day is drawn Poisson(1) times in each replica by a hash of (day, replica, seed), which
    needs no shared index of days and gives the same draws on every run.
    """
    u = F.pmod(F.xxhash64(F.col(day).cast("string"), "replica", F.lit(seed)), F.lit(1 << 40)).cast("double") / float(1 << 40)
    cdf, p, cuts = 0.0, 0.36787944117144233, []
    for k in range(8):
        cdf += p
        p /= k + 1
        cuts.append(cdf)
    draws = sum(((u >= c).cast("bigint") for c in cuts), F.lit(0))
    rows = days.withColumn("replica", F.explode(F.sequence(F.lit(1), F.lit(replicas)))).withColumn("_k", draws)
    return rows.groupBy("replica").agg((F.sum(F.col(total) * F.col("_k")) / F.nullif(F.sum(F.col(count) * F.col("_k")), F.lit(0))).alias("media"))


def value_at_risk(rows: DataFrame, keys: Sequence[str], pnl: str, level: float = 0.05) -> DataFrame:
    """Realised VaR (percentile) and expected shortfall (mean at or below it)."""
    q = rows.groupBy(*keys).agg(F.percentile(pnl, F.lit(level)).alias("var"))
    return rows.join(q, list(keys)).groupBy(*keys).agg(F.first("var").alias("var"), F.avg(F.when(F.col(pnl) <= F.col("var"), F.col(pnl))).alias("es"), F.count(F.lit(1)).alias("n"))


def combine_samples(parts: Sequence[tuple[dict, DataFrame]]) -> DataFrame:
    """The union of samples made by one and the same specification: each part brings its own (any JSON-like dict), and different
    hashes refuse the union. Adds ``amostra`` (from 1, in order) and ``especificacao`` (the hash). No parts: an error."""
    hashes = [hashlib.sha256(json.dumps(spec, sort_keys=True, default=str).encode()).hexdigest() for spec, _ in parts]
    if len(set(hashes)) != 1:
        raise ValueError(f"{len(set(hashes))} specifications in {len(parts)} samples: {sorted(set(hashes))}")
    out = None
    for i, (_, df) in enumerate(parts, 1):
        one = df.withColumns({"amostra": F.lit(i), "especificacao": F.lit(hashes[0])})
        out = one if out is None else out.unionByName(one)
    return out
