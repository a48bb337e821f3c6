"""Hand-computed cases of bars, flow, windows and folds."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomtick.functions.scalars import brazilian_number, chart_date, checked_expression, content_hash, normal_cdf, normal_quantile, t_critical
from loomtick.operators import bars as B
from loomtick.operators.fold import by_series, greedy_keep, wilder
from loomtick.operators.labels import triple_barrier
from loomtick.operators.windows import strict_past_z

BASE = 1704193200000000000
TAPE = "ts_ns bigint, ts_recv_ns bigint, symbol string, trade_id bigint, price double, quantidade bigint, agente_comprador bigint, agente_vendedor bigint, trade_type bigint, dt string"


def tape(spark, rows, dt="2024-01-02", start=0):
    out = []
    for i, (kind, q, p, *ag) in enumerate(rows):
        b, s = ag or (1, 2)
        out.append((BASE + (start + i) * 10**9, BASE + (start + i) * 10**9, "A", start + i + 1, float(p), q, b, s, kind, dt))
    return spark.createDataFrame(out, TAPE)


def ids(df):
    return [r.bar_id for r in df.orderBy("dt", "ts_ns").collect()]


def test_retail_does_not_advance_the_clock(spark):
    t = tape(spark, [(2, 60, 10.0), (13, 3000, 10.0), (3, 40, 10.1), (2, 100, 10.2)])
    assert ids(B.volume_bars(t, 100)) == [0, 0, 0, 1]


def test_crossing_and_partial(spark):
    assert ids(B.volume_bars(tape(spark, [(2, 95, 10), (2, 10, 10), (2, 100, 10)]), 100)) == [0, 0, 1]
    assert ids(B.volume_bars(tape(spark, [(2, 100, 10), (3, 30, 10)]), 100)) == [0]


def test_days_do_not_share_bars(spark):
    day = [(2, 60, 10), (2, 60, 10), (2, 30, 10)]
    t = tape(spark, day).unionByName(tape(spark, day, "2024-01-03", 100))
    assert ids(B.volume_bars(t, 100)) == [0, 0, 1, 1]


def test_flow_by_hand(spark):
    t = tape(spark, [(2, 70, 10.00, 1, 9), (3, 30, 10.05, 9, 1), (13, 50, 10.05, 7, 8), (3, 100, 10.10, 9, 1)])
    rows = B.volume_bars(t, 100)
    got = B.flow_features(rows, ["symbol", "bar_id"], 0.05).orderBy("bar_id").collect()
    assert [round(r.imbalance, 9) for r in got] == [0.4, -1.0] and got[0].absorcao == pytest.approx(100)
    assert got[1].rlp_frac == pytest.approx(1 / 3)
    agf = {(r.bar_id, r.agente): r.fluxo for r in B.broker_flow(rows, ["bar_id"]).collect()}
    assert agf[0, 1] == 40 and agf[1, 1] == -100 and agf[0, 9] == -40


def test_strict_past_z(spark):
    x = spark.createDataFrame([(0, i, float(v)) for i, v in enumerate([1, 2, 1, 2, 1, 2, 10])] + [(1, i, v) for i, v in enumerate([1.0] * 10 + [5.0])], "k int, i int, v double")
    w = Window.partitionBy("k").orderBy("i")
    z = {(r.k, r.i): r.z for r in x.withColumn("z", strict_past_z(F.col("v"), w, 4)).collect()}
    assert z[0, 6] == pytest.approx((10 - 1.5) / math.sqrt(1 / 3)) and z[1, 10] is None


def test_barrier_finds_a_rise(spark):
    closes = [100 * (1 + 0.0001 * (i % 3)) for i in range(40)] + [101.0, 102.0]
    b = spark.createDataFrame([("A", i, c, c * 1.001, c * 0.999) for i, c in enumerate(closes)], "symbol string, i int, close double, high double, low double")
    got = {r.i: r.rotulo for r in triple_barrier(b, ["symbol"], "i", 20.0, 5, 50, 25).collect()}
    assert got[38] == 1 and got[0] is None


def test_greedy_keeps_from_the_last_kept(spark):
    e = spark.createDataFrame([("A", t, t * 1.0) for t in (0, 4, 8, 11, 19, 20)], "k string, t bigint, v double")
    assert sorted(r.t for r in greedy_keep(e, ["k"], "t", 10).collect()) == [0, 11]
    assert greedy_keep(e.where("false"), ["k"], "t", 10).count() == 0


def test_wilder(spark):
    x = spark.createDataFrame([("A", i, v) for i, v in enumerate([1.0, 0.0, 1.0, 0.0])], "k string, i int, v double")
    got = [r.w for r in by_series(x, ["k"], "i", "v", {"w": wilder(2)}).orderBy("i").collect()]
    assert got == [None, 0.5, 0.75, 0.375]


def test_value_area_passes_empty_bins(spark):
    p = spark.createDataFrame([("A", b * 0.5, v) for b, v in ((0, 10), (1, 5), (2_000_000, 40), (2_000_001, 5))], "s string, faixa double, volume bigint")
    r = B.value_area(p, ["s"], 0.5, 0.8).collect()[0]
    assert (r.de, r.ate, r.dentro) == (0.5, 1_000_001.0, 50.0)  # outer edges


def test_volume_nodes(spark):
    p = spark.createDataFrame([("A", float(b), v) for b, v in ((0, 5), (1, 5), (2, 9), (3, 5), (4, 5), (5, 1), (6, 5), (7, 6))], "s string, faixa double, volume bigint")
    assert {(r.faixa, r.no) for r in B.volume_nodes(p, ["s"], 1.0).collect()} == {(0.0, "hvn"), (2.0, "hvn"), (4.0, "hvn"), (5.0, "lvn"), (7.0, "hvn")}


def test_scalars(spark):
    df = spark.createDataFrame([("1.234,5", 1180108), ("12.5", 1180230), ("x", None)], "t string, d bigint")
    got = df.select(brazilian_number(F.col("t")).alias("n"), chart_date(F.col("d")).cast("string").alias("d")).collect()
    assert [r.n for r in got] == [1234.5, 12.5, None] and got[0].d == "2018-01-08" and got[1].d is None
    assert normal_cdf(normal_quantile(0.975)) == pytest.approx(0.975) and t_critical(0.975, 10) == pytest.approx(2.228, abs=2e-3)


def test_user_expressions(spark):
    df = spark.createDataFrame([(1, 2.0), (3, None)], "a int, b double")
    assert [r.a for r in df.where(checked_expression("a >= 1 and (b * 2 > 3 or b is null and a = 9)", df.columns)).collect()] == [1]
    for bad in ("", "c > 1", "exec(a)", "a; drop", "a = 'x'", "java_method(a)"):
        with pytest.raises(ValueError):
            checked_expression(bad, df.columns)
    assert df.select(content_hash("a", "b").alias("h")).distinct().count() == 2
