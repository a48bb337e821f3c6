"""Orders on the tape, book events, refills, pairs and verdicts on planted cases."""

import pytest
from pyspark.sql import functions as F

from loomtick.operators.book import level_events, refill_chains
from loomtick.operators.fold import by_series, ema, seeded_ema
from loomtick.operators.replay import leg_exits, limit_fills, one_to_one, passive_fill, remaining_after_touch
from loomtick.operators.series import fold_series
from loomtick.operators.stats import combine_samples, verdict

S = 10**9
ORDERS = "s string, i bigint, lado bigint, limite double, em bigint, price string"
LEG = {"stop": 60.0, "targets": (60.0, 100.0, 150.0), "trail_from": 40.0, "trail_to": 30.0, "trail_step": 10.0, "flat_ns": 3600 * S}


def tape(spark, rows):
    return spark.createDataFrame([("A", t * S, t * S, i, float(p)) for i, (t, p) in enumerate(rows)], "s string, ts_ns bigint, ts_recv_ns bigint, trade_id bigint, price double")


def replay(spark, side, rows, valid=15):
    orders = spark.createDataFrame([("A", 1, side, 2000.0, 100 * S, "x")], ORDERS)
    t = tape(spark, rows)
    filled = limit_fills(orders.drop("price"), t, ["s"], ["i"], valid * S)
    return leg_exits(filled, t, ["s"], ["i"], **LEG).first()


@pytest.mark.parametrize("side", [1, -1])
def test_retreat_target_and_trailing_by_hand(spark, side):
    rows = [(100, 2012), (103, 2000), (104, 1993), (120, 2025), (126, 2044), (131, 2060), (142, 2038), (150, 2055)]
    r = replay(spark, side, [(t, p if side > 0 else 4000 - p) for t, p in rows])
    assert (r.execucao, r.entrada, r.entrada_ns) == ("recuo", 2000.0, 104 * S)
    assert [(r.p1, r.m1), (r.p2, r.m2), (r.p3, r.m3)] == [(60.0, 1), (46.0, 2), (46.0, 2)] and r.saida_ns == 142 * S


def test_opening_beyond_the_limit_fills_there_and_stops_in_full(spark):
    r = replay(spark, 1, [(100, 1985), (105, 1950), (110, 1920), (120, 2100)])
    assert (r.execucao, r.entrada, r.p1, r.p2, r.p3, r.m3) == ("abertura", 1985.0, -60.0, -60.0, -60.0, 2)


def test_a_touch_is_no_fill_and_open_legs_leave_by_time(spark):
    r = replay(spark, 1, [(100, 2010), (106, 2000), (113, 2000), (120, 1900)])
    assert r.execucao is None and r.entrada is None and r.p1 is None
    r = replay(spark, 1, [(100, 1985), (200, 1990), (300, 2001), (100 + 3700, 3000)])
    assert (r.p1, r.m1, r.saida_ns) == (16.0, 0, 300 * S)  # the last trade within the hour
    assert replay(spark, 1, []).execucao is None


def test_passive_fill_assumes_the_end_of_the_queue(spark):
    tops = spark.createDataFrame([("A", 5, 1, 10.0, 10.5), ("A", 6, 2, 9.9, 10.5), ("A", 7, 3, 10.0, 10.0), ("A", 30, 4, 1.0, 1.0)], "s string, ts_recv_ns bigint, topo_id bigint, bid double, ask double")
    orders = spark.createDataFrame([("A", 1, 1, 10.0, 4), ("A", 2, 1, 9.9, 4), ("A", 3, -1, 10.5, 4), ("A", 4, 1, 9.0, 4), ("B", 5, 1, 10.0, 4)], "s string, i bigint, lado bigint, preco double, em bigint")
    assert {r.i: r.execucao_ns for r in passive_fill(orders, tops, ["s"], ["i"], 10).collect()} == {1: 6, 2: None, 3: None, 4: None, 5: None}


def test_remaining_after_a_touch(spark):
    bars = spark.createDataFrame([("A", i, h, lo, c, 1 if i == 0 else 0) for i, (h, lo, c) in enumerate([(10.0, 10.0, 10.0), (10.5, 9.8, 10.0), (10.0, 9.0, 9.5), (11.0, 9.5, 11.0)])], "s string, m bigint, high double, low double, close double, lado bigint")
    r = remaining_after_touch(bars, ["s"], "m", "lado", 0.5, 3).collect()
    assert [(x.m, x.barra, x.rem_pessimista, x.rem_otimista) for x in r] == [(0, 2, 2.0, 1.5)]
    assert remaining_after_touch(bars, ["s"], "m", "lado", 0.5, 4).count() == 0  # the horizon isn't whole
    assert remaining_after_touch(bars, ["s"], "m", "lado", 5.0, 3).count() == 0


BOOK = "s string, d string, seq bigint, ts_recv_ns bigint, action bigint, side bigint, position bigint, offer_id bigint, quantidade bigint, price double, agente bigint"


def test_book_events_and_refills(spark):
    rows = [
        ("A", "d", 1, 1, 0, 0, 0, 7, 5, 10.0, 3), ("A", "d", 2, 2, 3, 0, 2, None, None, None, None), ("A", "d", 3, 3, 0, 0, 0, 8, 5, 10.0, 3),
        ("A", "d", 4, 4, 2, 0, 0, None, None, None, None), ("A", "d", 5, 6, 0, 0, 0, 9, 5, 10.0, 3), ("A", "d", 6, 40, 1, 0, 0, None, 4, None, None),
        ("A", "d", 7, 41, 2, 0, 0, None, None, None, None), ("A", "d", 8, 42, 2, 0, 3, None, None, None, None), ("A", "d", 9, 43, 0, 0, 0, 1, 5, 10.0, None),
    ]
    ev = level_events(spark.createDataFrame(rows + rows[:3], BOOK), ["s", "d"])
    got = [(r.seq, r.tipo, r.quantidade, r.agente) for r in ev.orderBy("seq").collect()]
    assert got == [(1, "entrada", 5, 3), (2, "saida_varredura", 5, 3), (3, "entrada", 5, 3), (4, "saida_avulsa", 5, 3), (5, "entrada", 5, 3), (7, "saida_avulsa", 4, 3), (9, "entrada", 5, None)]
    chains = refill_chains(ev, ["s", "d"], 5).collect()
    assert [(r.recargas, r.apos_varredura, r.de, r.ate) for r in chains] == [(2, 1, 3, 6)]
    assert refill_chains(ev, ["s", "d"], 1).agg(F.sum("recargas")).first()[0] == 1
    assert level_events(spark.createDataFrame([], BOOK), ["s", "d"]).count() == 0


def test_one_to_one_is_greedy_and_takes_nobody_twice(spark):
    ev = lambda r: spark.createDataFrame(r, "k string, m bigint")
    got = one_to_one(ev([("a", 10), ("a", 11), ("a", 20), ("b", 1)]), ev([("a", 11), ("a", 12), ("a", 25)]), ["k"], "m", 2)
    assert sorted((r.a, r.b) for r in got.collect()) == [(10, 11), (11, 12)]


def test_verdicts(spark):
    rows = [(3, 100, 0.9, 9.0, 1.0), (5, 100, 0.3, 9.0, 0.8), (5, 100, 0.1, 9.0, 1.0), (5, 100, 0.3, 1.0, 0.9), (5, 100, 0.3, 1.0, 0.8), (5, 100, 0.3, 9.0, 0.6), (9, 100, 0.9, None, 1.0)]
    df = spark.createDataFrame(rows, "k bigint, n bigint, m double, t double, c double")
    out = [r.v for r in df.select(verdict(F.col("k"), F.col("n"), F.col("m"), F.col("t"), F.col("c"), F.lit(4.0)).alias("v")).collect()]
    assert out == ["inconclusivo", "segue", "descarta", "inconclusivo", "descarta", "descarta", "inconclusivo"]


def test_samples_of_one_specification_are_combined(spark):
    df = lambda n: spark.range(n).toDF("x")
    out = combine_samples([({"a": 1, "b": [2]}, df(2)), ({"b": [2], "a": 1}, df(3))])
    assert {r.amostra: r["count"] for r in out.groupBy("amostra").count().collect()} == {1: 2, 2: 3} and out.select("especificacao").distinct().count() == 1
    for parts in ([({"a": 1}, df(1)), ({"a": 2}, df(1))], []):
        with pytest.raises(ValueError):
            combine_samples(parts)


def test_folds_keep_other_columns_and_span_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = [(None if k == 2 else str(k), i, float(i), {"x": i}, [i]) for k in range(3) for i in range(40)]
        df = spark.createDataFrame(rows, "k string, i bigint, v double, m map<string, bigint>, a array<bigint>")
        out = fold_series(df, ["k"], ["i"], ["v"], lambda v: {"soma": v.cumsum(), "fica": v % 2 == 0}, "soma double", keep="fica").collect()
        assert len(out) == 60 and all(r.soma == r.i * (r.i + 1) / 2 and r.m == {"x": r.i} and r.a == [r.i] for r in out)
        assert fold_series(df.where("false"), ["k"], ["i"], ["v"], lambda v: {"soma": v}, "soma double").count() == 0
        with pytest.raises(ValueError):
            fold_series(df, ["k"], ["i"], ["v"], lambda v: {"a": v}, "a double")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_averages_by_seed(spark):
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate([1.0, 3.0, 5.0, 9.0])], "k string, i bigint, v double")
    out = by_series(df, ["k"], "i", "v", {"m": seeded_ema(3), "x": ema(0.5, 9.0)}).orderBy("i").collect()
    assert [r.m for r in out] == [None, None, 3.0, 6.0] and [r.x for r in out] == [5.0, 4.0, 4.5, 6.75]
