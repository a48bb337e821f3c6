"""Planted effects are found and noise is not; forests keep their gate."""

import pytest
from pyspark.sql import functions as F

from loomtick.operators.learn import artefact_hash, fit_gated, gated, score
from loomtick.operators.resample import matched_control, permuted, persistence, random_walk_tape, sign_flip_test, uniform
from loomtick.plans.research_queries import iceberg_runs


def flows(spark, keep):
    rows = [(f"d{k}", a, int((1 if (a + (0 if keep else k * 7 + a * k * k)) % 2 else -1) * (50 + a))) for k in range(6) for a in range(60)]
    return spark.createDataFrame(rows, "dt string, agente bigint, v bigint")


def test_sign_flip_finds_persistence_only_where_it_is(spark):
    real = sign_flip_test(persistence(flows(spark, True), [], "agente", "dt", "v"), [], "agente", 200).first()
    assert real.p < 0.01 and real.z > 5
    noise = spark.createDataFrame([(f"d{k}", a) for k in range(6) for a in range(60)], "dt string, agente bigint").withColumn("v", F.when(uniform(F.col("dt"), F.col("agente")) < 0.5, -70).otherwise(70).cast("bigint"))
    assert sign_flip_test(persistence(noise, [], "agente", "dt", "v"), [], "agente", 200).first().p > 0.02


def test_planted_icebergs_beat_the_permuted_baseline(spark):
    noise = random_walk_tape(spark, 1, 4000)
    planted = spark.range(300).select(
        (F.lit(1515412800000000000) + F.col("id") * 12_000_000_000 + 1).alias("ts_ns"), F.lit(0).cast("bigint").alias("ts_recv_ns"), F.lit("RUIDO").alias("symbol"), F.lit("2018-01-08").alias("dt"), (F.col("id") + 10_000).alias("trade_id"),
        F.lit(139_990.0).alias("price"), F.lit(37).cast("bigint").alias("quantidade"), F.lit(99).cast("bigint").alias("agente_comprador"), F.lit(5).cast("bigint").alias("agente_vendedor"), F.lit(3).cast("bigint").alias("trade_type"),
    )
    tape = noise.unionByName(planted)
    base = permuted(tape, ["symbol", "dt"], ["ts_ns", "trade_id"], ["quantidade", "agente_comprador", "agente_vendedor"])
    assert base.count() == tape.count() and base.agg(F.sum("quantidade")).first() == tape.agg(F.sum("quantidade")).first()
    assert iceberg_runs(tape, least=30).count() >= 1 and iceberg_runs(base, least=30).count() == 0


def test_control_matches_strata(spark):
    rows = spark.range(500).select("id", F.pmod("id", F.lit(5)).alias("hora"), (F.col("id") < 50).alias("sinal"))
    got = {(r.hora, r.grupo): r["count"] for r in matched_control(rows, ["hora"], "sinal", ["id"]).groupBy("hora", "grupo").count().collect()}
    assert set(got.values()) == {10} and len(got) == 10


def test_forest_with_gate(spark):
    rows = spark.range(1200).select("id", uniform(F.col("id"), F.lit("a")).alias("a"), uniform(F.col("id"), F.lit("b")).alias("b"))
    rows = rows.withColumn("y", F.when(F.col("a") > 0.7, 1).when(F.col("a") < 0.3, -1).otherwise(0))
    rows = rows.unionByName(spark.createDataFrame([(9999, None, 0.5, 1)], "id bigint, a double, b double, y int"))
    model, limit = fit_gated(rows, ["a", "b"], "y", trees=10)
    picked = gated(score(model, rows, ["a", "b"]), limit)
    assert 0 < picked.count() < 800 and picked.where("classe = y").count() >= 0.95 * picked.count()
    assert artefact_hash({"b": 1, "a": 2}) == artefact_hash({"a": 2, "b": 1})


@pytest.mark.parametrize("days", [3])
def test_noise_tape_is_deterministic(spark, days):
    a, b = random_walk_tape(spark, days, 100), random_walk_tape(spark, days, 100).repartition(3)
    assert a.exceptAll(b).count() == 0 and a.count() == days * 100
