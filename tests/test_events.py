"""Event detectors on planted tapes."""

import pytest
from pyspark.sql import functions as F

from loomtick.plans.research_queries import carried_ema, ignitions, reversals_123
from loomtick.plans.study_queries import band_scalp, followers, leader_moves

S = 1_000_000_000


def _tape(spark, rows, dt="2026-01-05"):
    """(symbol, seconds, price) in order; every second trade is an aggressor's sale."""
    rows = [(s, dt, i + 1, int(at * S), int(at * S), float(p), 1, 2 + i % 2) for i, (s, at, p) in enumerate(rows)]
    return spark.createDataFrame(rows, "symbol string, dt string, trade_id long, ts_ns long, ts_recv_ns long, price double, quantidade long, trade_type long")


def test_ignitions_see_moves_inside_a_minute_and_not_across_gaps(spark):
    t = _tape(spark, [("A", 0, 100), ("A", 70, 100.1), ("A", 80, 100), ("A", 130, 100), ("A", 3000, 101), ("A", 3059, 101.5), ("A", 3061, 101.5)])
    got = sorted((r.ts_ns // S, r.movimento) for r in ignitions(t).collect())
    # the move at 70 s is taken back within its minute; the price before 3000 s is as of 130 s
    assert got == [(70, 0.1), (3000, 1.0)]


def test_ignitions_rest_from_the_last_kept(spark):
    t = _tape(spark, [("A", 0, 100)] + [("A", 60 + 300 * i, 100 + i + 1) for i in range(5)])
    assert sorted(r.ts_ns // S for r in ignitions(t).collect()) == [60, 660, 1260]


def _bars(spark, rows, dt="2026-01-05"):
    """(high, low, close[, day]) by minute."""
    rows = [("A", r[3] if len(r) > 3 else dt, i, *map(float, (r[2], r[0], r[1], r[2]))) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "symbol string, dt string, minuto long, open double, high double, low double, close double")


def test_reversals_on_both_sides_with_regime_and_last_bar(spark):
    rows = [(12, 10, 11), (11, 9, 10), (12, 10, 12), (13, 11, 12), (12, 8, 8), (11, 7, 8), (12, 8, 12)]
    got = sorted(tuple(r)[2:5] + tuple(r)[6:] for r in reversals_123(_bars(spark, rows)).collect())
    # the last bar closes a pattern that nothing can trigger any more
    assert got == [(2, "compra", 12.0, True, True), (4, "venda", 8.0, True, True), (6, "compra", 12.0, True, False)]


def test_ema_goes_on_over_days(spark):
    closes = [10.0, 11, 9, 14, 15, 13, 20]
    days = ["2026-01-05"] * 3 + ["2026-01-06"] * 2 + ["2026-01-07"] * 2
    got = [r.ema for r in carried_ema(_bars(spark, [(c, c, c, d) for c, d in zip(closes, days, strict=True)]), 4).orderBy("minuto").collect()]
    want = [closes[0]]
    for c in closes[1:]:
        want.append(0.4 * c + 0.6 * want[-1])
    assert got == pytest.approx(want)


def test_leader_moves_rest_by_side(spark):
    rows = [("L", 0, 100), ("L", 1.0, 102), ("L", 1.2, 100), ("L", 1.4, 102), ("L", 3.5, 104), ("L", 9, 104)]
    t = _tape(spark, rows).withColumn("tick", F.lit(1.0))
    # at 1.2 s the price as of 0.7 s is 100 still; 1.4 s goes up again within the rest
    assert sorted((r.ts_ns / S, r.lado) for r in leader_moves(t, 2, 500, 2000).collect()) == [(1.0, 1), (3.5, 1)]
    down = [("L", 0, 100), ("L", 1.0, 102), ("L", 1.6, 100), ("L", 2.2, 102)]
    t = _tape(spark, down).withColumn("tick", F.lit(1.0))
    assert sorted((r.ts_ns / S, r.lado) for r in leader_moves(t, 2, 500, 2000).collect()) == [(1.0, 1), (1.6, -1)]


def test_followers_are_read_as_of_and_still_ones_apart(spark):
    events = spark.createDataFrame([("2026-01-05", 1, 100 * S), ("2026-01-05", -1, 200 * S)], "dt string, lado long, ts_ns long")
    # A has no trade in the events' minutes; B moves before the first and after the second; C opens too late for the first
    rows = [("A", 1, 10), ("B", 1, 20), ("B", 99.8, 22), ("B", 200.9, 21), ("C", 150, 5)]
    ticks = spark.createDataFrame([("A", 1.0), ("B", 1.0), ("C", 1.0)], "symbol string, tick double")
    got = {(r.symbol, r.subconjunto): tuple(r)[3:] for r in followers(events, _tape(spark, rows), ticks, 500, [1000]).collect()}
    assert got == {
        ("A", "todos"): (2, 0.0, 0.0, 0.0, 0.0), ("A", "parado"): (2, 0.0, 0.0, 0.0, 0.0), ("B", "todos"): (2, 1.0, 0.5, 50.0, 0.0),
        ("B", "parado"): (1, 0.0, 1.0, 100.0, 0.0), ("C", "todos"): (1, 0.0, 0.0, 0.0, 0.0), ("C", "parado"): (1, 0.0, 0.0, 0.0, 0.0),
    }


@pytest.mark.parametrize("side", ["compra", "venda"])
def test_band_scalp_on_both_sides_with_both_limits(spark, side):
    flat = [(100.0, 101.0, 99.0, 100.0)] * 25
    # open, high, low, close: red and white above the band, then the entry bar
    up = [(112.0, 113.0, 109.0, 110.0), (112.0, 116.0, 111.0, 115.0), (115.0, 117.0, 114.0, 116.0)]
    bars = flat + (up if side == "compra" else [(200 - o, 200 - low, 200 - h, 200 - c) for o, h, low, c in up])
    df = spark.createDataFrame([("A", "2026-01-05", i, *b) for i, b in enumerate(bars)], "symbol string, dt string, minuto long, open double, high double, low double, close double")
    price = (lambda p: p) if side == "compra" else (lambda p: 200 - p)
    got = sorted(tuple(r)[2:] for r in band_scalp(df).collect())
    assert got == [(27, side, "retorno", price(113.0), False, None), (27, side, "rompimento", price(116.0), True, "abertura")]


def test_band_scalp_goes_on_over_days_after_a_warm_up(spark):
    up = [(112.0, 113.0, 109.0, 110.0), (112.0, 116.0, 111.0, 115.0), (115.0, 117.0, 114.0, 116.0)]
    kinds = "symbol string, dt string, minuto long, open double, high double, low double, close double"
    for before, entries in ((18, 0), (19, 2)):
        bars = [("A", "2026-01-05", i, 100.0, 101.0, 99.0, 100.0) for i in range(9)]
        bars += [("A", "2026-01-06", i, *b) for i, b in enumerate([(100.0, 101.0, 99.0, 100.0)] * before + up)]
        assert band_scalp(spark.createDataFrame(bars, kinds)).count() == entries


def test_footers_of_readable_and_broken_files(spark, tmp_path):
    from loomtick.operators.quality import footers, parquet_ends

    spark.createDataFrame([(i if i else None, "x") for i in range(5)], "v bigint, s string").coalesce(1).write.parquet(f"{tmp_path}/t")
    spark.createDataFrame([], "v bigint, s string").coalesce(1).write.parquet(f"{tmp_path}/empty")
    (tmp_path / "t" / "broken.parquet").write_bytes(b"PAR1 no footer PAR1")
    (tmp_path / "t" / "cut.parquet").write_bytes(b"PAR1 cut off")
    rows = footers(spark, [f"{tmp_path}/t", f"{tmp_path}/empty"], ["v", "w"]).collect()
    good = [r for r in rows if r.linhas]
    assert [(r.linhas, r.coluna, r.menor, r.maior, r.nulos) for r in good] == [(5, "v", 1, 4, 1)]
    assert sorted(r.path.rsplit("/", 1)[1] for r in rows if r.linhas is None) == ["broken.parquet", "cut.parquet"]
    ends = {r.path.rsplit("/", 1)[1]: r.valid for r in parquet_ends(spark, f"{tmp_path}/t", "*.parquet").collect()}
    assert ends["broken.parquet"] and not ends["cut.parquet"] and sum(ends.values()) == 2


def test_derived_tables_are_cached_by_their_signature(spark, tmp_path):
    from loomtick.session import cached

    spark.range(3).write.parquet(f"{tmp_path}/in")
    made = lambda version="1", k=2: cached(spark.read.parquet(f"{tmp_path}/in").selectExpr(f"id * {k} AS x"), "dobro", version, f"file://{tmp_path}")
    first = made().inputFiles()
    assert made().inputFiles() == first and sorted(r.x for r in made().collect()) == [0, 2, 4]
    assert made("2").inputFiles() != first and made(k=3).inputFiles() != first
    spark.range(3, 4).write.mode("append").parquet(f"{tmp_path}/in")
    assert made().inputFiles() != first and made().count() == 4


def test_a_guarded_overwrite_does_not_mistake_a_broken_table_for_none(spark, tmp_path):
    from loomtick.operators.quality import guarded_overwrite

    df = spark.createDataFrame([("a", i) for i in range(4)], "p string, v bigint")
    guarded_overwrite(df, f"{tmp_path}/t", ["p"])
    with pytest.raises(ValueError):
        guarded_overwrite(df.limit(1), f"{tmp_path}/t", ["p"])
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_bytes(b"nothing")
    with pytest.raises(Exception):  # noqa: B017
        guarded_overwrite(df, f"{tmp_path}/bad", ["p"])
    assert (tmp_path / "bad" / "x.parquet").exists()


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from loomtick.session import shared_root

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        shared_root(far)


@pytest.mark.parametrize("step", [1, 7, 10, 1000])
def test_extremes_of_a_path_equal_brute_force(spark, step):
    import random

    from loomtick.operators.asof import path_extremes

    rnd = random.Random(step)
    path = [(rnd.choice("AB"), rnd.randrange(200), rnd.choice([None, 1.0, 2.5, -3.0, 7.0])) for _ in range(300)]
    events = [(rnd.choice("ABC"), i, rnd.choice([rnd.randrange(200), 10 * rnd.randrange(20)])) for i in range(60)]
    got = path_extremes(spark.createDataFrame(events, "k string, i bigint, t bigint"), spark.createDataFrame(path, "k string, at bigint, v double"), ["k"], ["i"], "t", "at", 25, "v", step).collect()
    want = {}
    for k, i, t in events:
        seen = [v for s, at, v in path if s == k and t < at <= t + 25]
        if seen:
            v = [x for x in seen if x is not None]
            want[i] = (max(v, default=None), min(v, default=None), len(v))
    assert {r.i: (r.maior, r.menor, r.n) for r in got} == want
