"""Streams against their batch forms; sources, sinks and simulations."""

import pytest
from pyspark.sql import functions as F

from loomtick.operators import bars as B
from loomtick.operators.quality import compare, guarded_overwrite, parquet_ends, replace_days, tolerant_scan
from loomtick.operators.simulate import Limits, looks_ahead, run_day, simulate
from loomtick.operators.stats import day_bootstrap, walk_forward
from loomtick.plans.registry import tape
from loomtick.session import work_folder
from loomtick.sources.text import dump_lines, read_candles, read_dump, read_event_log, read_operations
from loomtick.streaming import live


@pytest.fixture(scope="module")
def stored_tape(spark, data):
    """The tape in three files, by time, as a feed would deliver it."""
    path = work_folder(spark, "t")
    rows = tape(spark, data)
    ordered = rows.orderBy("ts_ns", "ts_recv_ns", "trade_id").toPandas()
    for i in range(3):
        part = ordered.iloc[len(ordered) * i // 3 : len(ordered) * (i + 1) // 3]
        spark.createDataFrame(part, rows.schema).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def test_live_volume_bars_equal_batch(spark, stored_tape, rocks):
    out = live.run_once(live.live_volume_bars(live.tape_stream(spark, stored_tape, 1), 500), work_folder(spark, "t"))
    got = spark.read.parquet(out)
    batch = B.ohlc(B.volume_bars(spark.read.parquet(stored_tape), 500, None), ["symbol", "dt", "bar_id"])
    bad = compare(got.where("bar_id is not null"), batch, ["symbol", "dt", "bar_id"], ["open", "high", "low", "close", "volume", "n_trades"]).where("lado <> 'ambos' or size(diferentes) > 0")
    assert got.count() > 5 and bad.count() == 0


def test_live_momentum_rests(spark, stored_tape, rocks):
    out = live.run_once(live.live_momentum(live.tape_stream(spark, stored_tape, 1), 60 * 10**9, 0.0003, 600 * 10**9), work_folder(spark, "t"))
    whole = live.run_once(live.live_momentum(live.tape_stream(spark, stored_tape), 60 * 10**9, 0.0003, 600 * 10**9), work_folder(spark, "t"))
    rows = lambda p: sorted((r.symbol, r.dt, r.ts_ns) for r in spark.read.parquet(p).collect())
    got = rows(out)
    assert got == rows(whole)  # micro-batches don't matter
    for (s, d, a), (t, e, b) in zip(got, got[1:]):
        assert (s, d) != (t, e) or b - a >= 600 * 10**9


def test_lasting_condition_fires_once_per_run(spark, rocks):
    marks = [(0, 1), (5, 1), (11, 1), (20, 1), (21, 0), (30, 1), (35, None), (40, 1), (49, 1), (50, 1)]
    whole = spark.createDataFrame([("A", t, i, v) for i, (t, v) in enumerate(marks)], "symbol string, t bigint, seq bigint, v int")
    one = work_folder(spark, "t")
    whole.coalesce(1).write.parquet(one)
    out = spark.read.parquet(live.run_once(live.live_lasting(live.tape_stream(spark, one), "t", "seq", "v = 1", 10), work_folder(spark, "t")))
    assert sorted(map(tuple, out.collect())) == [("A", 0, 11), ("A", 40, 50)]


def test_declarative_streams_equal_batch(spark, stored_tape):
    batch = spark.read.parquet(stored_tape)
    out = spark.read.parquet(live.run_once(live.live_time_bars(live.tape_stream(spark, stored_tape, 1), lateness="2 days"), work_folder(spark, "t"), "complete"))
    want = B.ohlc(batch.withColumn("inicio_us", F.expr("ts_ns div 300000000000 * 300000000")), ["symbol", "inicio_us"])
    assert compare(out, want, ["symbol", "inicio_us"], ["open", "high", "low", "close", "volume"]).where("lado <> 'ambos' or size(diferentes) > 0").count() == 0
    vwap = spark.read.parquet(live.run_once(live.live_vwap(live.tape_stream(spark, stored_tape, 1)), work_folder(spark, "t"), "complete"))
    want = batch.groupBy("symbol", "dt").agg((F.sum(F.col("price") * F.col("quantidade")) / F.sum("quantidade")).alias("vwap"))
    assert compare(vwap, want, ["symbol", "dt"], ["vwap"], 1e-6).where("lado <> 'ambos' or size(diferentes) > 0").count() == 0
    lag = spark.read.parquet(live.run_once(live.live_lag(live.tape_stream(spark, stored_tape)), work_folder(spark, "t"), "complete"))
    assert lag.agg(F.sum("n")).first()[0] == batch.count()


def test_single_delivery_and_ingest_lose_nothing(spark, data, stored_tape):
    twice = work_folder(spark, "t")
    batch = spark.read.parquet(stored_tape)
    batch.unionByName(batch).write.parquet(twice)
    once = spark.read.parquet(live.run_once(live.single_delivery(live.tape_stream(spark, twice), "2 days"), work_folder(spark, "t")))
    assert once.count() == batch.count()
    raw = work_folder(spark, "t")
    source = spark.read.parquet(f"{data}/trades.parquet")
    source.write.parquet(raw)
    out = work_folder(spark, "t")
    live.partitioned_ingest(live.tape_stream(spark, raw), out)
    kept = spark.read.parquet(f"{out}/bruto")
    late = spark.read.parquet(f"{out}/quarentena").count() if spark._jvm.java.io.File(f"{out}/quarentena".replace("file://", "")).list() else 0
    assert kept.count() + late == source.count() and {"dt", "sym"} <= set(kept.columns)


def test_text_sources(spark, tmp_path):
    dump = tmp_path / "dump.log"
    dump.write_text("noise\n10:00 PRCBARRA|1180108|900|900|1|140.000,5|140100|139900|140050|1200|50|1|2|3|4\r\nPRCBARRA|1180108|915\n")
    lines = dump_lines(spark, str(dump), "PRCBARRA")
    assert [r.ok for r in lines.collect()] == [True, False]
    r = read_dump(spark, str(dump), "PRCBARRA", strict=False).collect()[0]
    assert str(r.data) == "2018-01-08" and r.open == 140000.5 and r.tr == 4
    with pytest.raises(Exception, match="number of fields"):
        read_dump(spark, str(dump), "PRCBARRA").collect()
    csv = tmp_path / "m1.csv"
    csv.write_text("data_hora,abertura,maxima,minima,fechamento,volume,volume_ticks\n2018-01-08 09:00:00,1,2,0.5,1.5,10,3\n")
    assert read_candles(spark, str(csv)).first().fechamento == 1.5
    csv.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        read_candles(spark, str(csv))
    log = tmp_path / "log.jsonl"
    log.write_text('{"timestamp": "2018-01-08T10:00:00Z", "event": "x"}\n{"timestamp": "2018-01-09T10:00:00Z", "event": "y"}\n{bad\nplain\n')
    good, bad = read_event_log(spark, str(log), ["2018-01-08"])
    assert [r.evento for r in good.collect()] == ["x"] and bad.count() == 1
    ops = tmp_path / "ops"
    ops.mkdir()
    (ops / "sinais_2018-01-08.jsonl").write_text('{"lado": 1}\n{oops\n')
    got = read_operations(spark, str(ops), "lado bigint").collect()
    assert {r.dia for r in got} == {"2018-01-08"} and sum(r._corrupt_record is not None for r in got) == 1


def test_files_and_ledgers(spark, tmp_path):
    good = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "p string, v bigint")
    guarded_overwrite(df, good, ["p"])
    with pytest.raises(ValueError, match="shrink"):
        guarded_overwrite(spark.createDataFrame([("a", 1)], "p string, v bigint").where("v > 0").union(df.where("false")).limit(0).union(spark.createDataFrame([("a", 9)], "p string, v bigint")), good, ["p"], 0.9)
    guarded_overwrite(spark.createDataFrame([("a", 9)], "p string, v bigint"), good, ["p"], reason="known")
    assert sorted((r.p, r.v) for r in spark.read.parquet(good).collect()) == [("a", 9), ("b", 1)]
    (tmp_path / "t" / "p=b" / "broken.parquet").write_bytes(b"PAR1 nothing")
    ends = {r.path.rsplit("/", 1)[1]: r.valid for r in parquet_ends(spark, good, "*.parquet").collect()}
    assert ends["broken.parquet"] is False and sum(ends.values()) == len(ends) - 1
    rows, broken = tolerant_scan(spark, good, "v bigint")
    assert rows.count() == 2 and [r.path.rsplit("/", 1)[1] for r in broken.collect()] == ["broken.parquet"]
    old = spark.createDataFrame([("d1", 1, 5), ("d2", 1, 6)], "dia string, k int, v int")
    new = spark.createDataFrame([("d2", 2, 7), ("d2", 2, 7)], "dia string, k int, v int")
    assert sorted(map(tuple, replace_days(old, new, "dia", ["k"]).collect())) == [("d1", 1, 5), ("d2", 2, 7)]


def test_policy_simulator(spark):
    closes = [10, 11, 12, 9, 8, 8, 9]
    bars = spark.createDataFrame([("A", "d", i, float(c), 1) for i, c in enumerate(closes)], "symbol string, dt string, i bigint, close double, rotulo int")

    def follow(bar, i, side):
        assert "rotulo" not in bar
        return 1 if bar["close"] >= 11 else None

    got = simulate(bars, ["symbol", "dt"], "i", follow, Limits(stop=1.5, cost=0.5), hide=["rotulo"]).collect()
    assert [(r.entrada, r.saida, r.resultado, r.motivo) for r in got] == [(1, 3, -2.5, "stop")]
    pdf = bars.toPandas()
    assert run_day(pdf, "i", lambda b, i, s: 1, Limits(bars=2))[0][:3] == (0, 2, 1)
    last = lambda: lambda b, i, s: int(b["close"] > 10)
    assert looks_ahead(pdf, "i", last, [2, 5]) == []


def test_folds_and_bootstrap(spark):
    days = spark.createDataFrame([(f"d{i:02d}",) for i in range(10)], "dt string")
    folds = {r.dt: r.fold for r in walk_forward(days, "dt", 3, 2).collect()}
    assert [folds[f"d{i:02d}"] for i in range(10)] == [None, None, None, 0, 0, 1, 1, 2, 2, 3]
    sums = spark.createDataFrame([(f"d{i}", float(i), 1) for i in range(40)], "dt string, total double, n bigint")
    means = [r.media for r in day_bootstrap(sums, "dt", "total", "n", 200).collect()]
    assert len(means) == 200 and abs(sum(means) / 200 - 19.5) < 0.6 and 1.2 < (sum((m - 19.5) ** 2 for m in means) / 200) ** 0.5 < 2.6
