"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def exponential_key(doc_id: Column, weight: Column, seed: int) -> Column:
    """Efraimidis-Spirakis key −ln(u)/weight, u in (0, 1) from the id and the seed: the smallest keys are a weighted sample without replacement."""
    u = (F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def mix_plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target source: what it has, its budget, whole epochs and the rest to draw.

    ``sizes``: ``source``, ``tokens`` (rows of NULL source count in the total only); ``targets``: ``source``,
    ``target_share``, ``max_repeats``. ``capped`` is true where ``target_share * total`` exceeds ``max_repeats`` times the
    source's tokens; such a source gives its ``max_repeats`` epochs and nothing more. A source without documents has 0
    tokens. NULL shares or repeats count as 0.
    """
    by = sizes.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    total = by.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"))
    t = targets.select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce(F.col("max_repeats").cast("bigint"), F.lit(0)).alias("max_repeats"))
    joined = t.join(by, "source", "left").crossJoin(F.broadcast(total))  # one row
    joined = joined.withColumns({"tokens": F.coalesce("tokens", F.lit(0)), "docs": F.coalesce("docs", F.lit(0))})
    budget = F.col("target_share") * F.col("total")
    capped = budget > F.col("max_repeats") * F.col("tokens")
    whole = F.when(capped, F.col("max_repeats")).when(F.col("tokens") > 0, F.floor(budget / F.greatest(F.col("tokens"), F.lit(1)))).otherwise(0)
    out = joined.withColumns({"budget": budget, "capped": capped, "epochs": whole.cast("bigint")})
    return out.withColumn("rest", F.when(F.col("capped"), F.lit(0.0)).otherwise(F.col("budget") - F.col("epochs") * F.col("tokens")))


#: The fullest of n slices of a source's keys holds at most about CROWDED / n of its documents.
CROWDED = 12


def keyed_documents(docs: DataFrame, seed: int) -> DataFrame:
    """Documents of named sources with ``key`` and its logarithm ``_lk``.

    −ln(u)/weight spans many sizes when weights do; its logarithm only shifts by a weight's logarithm and never has more
    than 1/e of its mass in one unit, so even steps of it are slices of bounded share whatever the weights are.
    """
    weight = F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(1e-6))
    keyed = docs.select("doc_id", "source", "tokens", "weight").where("source is not null").withColumn("key", exponential_key(F.col("doc_id"), weight, seed))
    return keyed.withColumn("_lk", F.log("key"))


def mix_sources(docs: DataFrame, targets: DataFrame, seed: int = 17, rows_per_slice: int = 100_000, plan: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``source``, ``tokens`` and ``copies`` (≥ 1) of every document in the mixture.

    ``docs``: ``doc_id``, ``source``, ``tokens``, ``weight`` (quality; NULL or not positive: the smallest positive
    weight). Complete epochs take every document; then documents are drawn in the order of their exponential keys,
    a prefix whose sum of tokens stays within the rest of the source's budget. Equal keys are ordered by id and size, so
    repeated rows are drawn one by one. Documents of a NULL or untargeted source aren't in the mixture. Empty tables
    give an empty mixture.

    Scale: the prefix sum runs over slices of the key's range, whose sums are added up first; only the one slice
    a source in which the budget ends is ordered row by row. Slices are even steps of the key's logarithm, CROWDED times
    as many as ``rows_per_slice`` asks for, so that even the fullest holds about that many rows at most, whatever the weights.
    ``plan`` is a plan made before (None: made here).
    """
    plan = mix_plan(docs, targets) if plan is None else plan
    keyed = keyed_documents(docs, seed)
    span = keyed.groupBy("source").agg(F.min("_lk").alias("_lo"), F.max("_lk").alias("_hi"))
    slices = F.ceil(CROWDED * F.col("docs") / F.lit(rows_per_slice)).cast("bigint")
    rows = keyed.join(plan.where("docs > 0").select("source", "epochs", "rest", slices.alias("slices")).join(span, "source"), "source")
    reach = F.when(F.col("_hi") > F.col("_lo"), (F.col("_lk") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(0.0)
    rows = rows.withColumn("slice", F.least(F.floor(reach * F.col("slices")), F.col("slices") - 1)).drop("_lk", "_lo", "_hi")

    sums = rows.groupBy("source", "slice").agg(F.sum("tokens").alias("in_slice"), F.first("rest").alias("rest"))
    w = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("upto", F.sum("in_slice").over(w))
    full = F.col("upto") <= F.col("rest")
    last = (~full) & (F.col("upto") - F.col("in_slice") < F.col("rest"))
    fate = sums.select("source", "slice", (F.col("upto") - F.col("in_slice")).alias("earlier"), F.when(full, "all").when(last, "some").otherwise("none").alias("fate"))
    placed = rows.join(fate, ["source", "slice"])
    by_key = Window.partitionBy("source", "slice").orderBy("key", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    some = placed.where("fate = 'some'").withColumn("drawn", (F.col("earlier") + F.sum("tokens").over(by_key) <= F.col("rest")).cast("bigint"))
    rest = placed.where("fate <> 'some'").withColumn("drawn", (F.col("fate") == "all").cast("bigint"))
    out = some.select(*rest.columns).unionByName(rest).withColumn("copies", F.col("epochs") + F.col("drawn"))
    return out.where("copies > 0").select("doc_id", "source", "tokens", "copies")


def mix_report(docs: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """Per target source: its tokens and budget, ``capped``, ``epochs``, the tokens it really gives and the share reached.

    ``limited`` is read off the mixture itself: every document was given ``max_repeats`` times and the budget wasn't met.
    """
    made = stored(mix_plan(docs, targets), "plano-mistura")
    mixture = mix_sources(docs, targets, seed, plan=made).groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("given"))
    plan = made.join(mixture, "source", "left").withColumn("given", F.coalesce("given", F.lit(0)))
    all_given = plan.agg(F.sum("given").alias("all_given"))
    reached = F.when(F.col("all_given") > 0, F.col("given") / F.col("all_given")).otherwise(0.0)
    limited = (F.col("given") == F.col("max_repeats") * F.col("tokens")) & (F.col("given") < F.col("budget"))
    return plan.crossJoin(F.broadcast(all_given)).select("source", "target_share", "max_repeats", "tokens", "docs", "budget", "capped", "epochs", "given", limited.alias("limited"), reached.alias("reached_share"))
