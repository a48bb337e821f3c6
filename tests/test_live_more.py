"""Fan-out, day profile, bars that close by the clock, conservation."""

import pytest

from loomtick.operators import bars as B
from loomtick.session import work_folder
from loomtick.streaming import live

from .test_live import rocks, stored_tape  # noqa: F401


def test_every_consumer_gets_the_feed_while_it_is_there(spark, stored_tape):  # noqa: F811
    out, seen = work_folder(spark, "t"), []

    def consumers():
        seen.append(1)
        all_ = {"tudo": lambda df: df.select("symbol", "trade_id"), "compras": lambda df: df.where("trade_type = 2").select("symbol", "trade_id")}
        return all_ if len(seen) < 3 else {"tudo": all_["tudo"]}  # one is removed before the last micro-batch

    live.fan_out(live.tape_stream(spark, stored_tape, 1), out, consumers)
    whole = spark.read.parquet(stored_tape)
    assert live.conserved(whole, spark.read.parquet(f"{out}/tudo")).first().conservado
    buys = spark.read.parquet(f"{out}/compras")
    assert 0 < buys.count() < whole.where("trade_type = 2").count() and buys.select("lote").distinct().count() == 2
    assert not live.conserved(whole, buys).first().conservado


def test_live_profile_equals_batch(spark, stored_tape):  # noqa: F811
    out = live.run_once(live.live_profile(live.tape_stream(spark, stored_tape, 1), 0.5), work_folder(spark, "t"), "complete")
    want = B.price_profile(spark.read.parquet(stored_tape), ["symbol", "dt"], 0.5).select("symbol", "dt", "faixa", "volume", "compra", "venda")
    got = spark.read.parquet(out).select(*want.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and want.count() > 5


def test_bars_close_by_a_trade_or_by_the_clock(spark, rocks):  # noqa: F811
    path = work_folder(spark, "t")
    minute = 60 * 10**9
    feed = [[("A", 1, 10.0), ("A", 2, 12.0), ("B", 3, 5.0)], [("A", 7, 11.0)], [("A", 30, 9.0)], [("A", 31, 9.0)]]
    for k, rows in enumerate(feed):
        df = spark.createDataFrame([(s, m * minute, m * minute, 10 * k + i, p, 1, 2) for i, (s, m, p) in enumerate(rows)], "symbol string, ts_ns bigint, ts_recv_ns bigint, trade_id bigint, price double, quantidade bigint, trade_type bigint")
        df.coalesce(1).write.mode("append").parquet(path)
    out = spark.read.parquet(live.run_once(live.live_clock_bars(live.tape_stream(spark, path, 1)), work_folder(spark, "t")))
    got = sorted((r.symbol, r.bucket, r.open, r.high, r.low, r.close, r.volume, r.pelo_relogio) for r in out.collect())
    assert ("A", 0, 10.0, 12.0, 10.0, 12.0, 2, False) in got
    assert ("B", 0, 5.0, 5.0, 5.0, 5.0, 1, True) in got  # B has no later trade; the feed's clock closes it
    assert len({(r[0], r[1]) for r in got}) == len(got)


def test_a_slot_has_one_owner():
    board = live.SlotBoard()
    assert board.take("A", "x") and board.take("A", "x") and not board.take("A", "y")
    assert not board.release("A", "y") and board.release("A", "x") and board.take("A", "y")


@pytest.mark.parametrize("ttl", [None, live.TTL_MS])
def test_state_may_expire(spark, stored_tape, rocks, ttl):  # noqa: F811
    stream = live.live_volume_bars(live.tape_stream(spark, stored_tape), 500, ttl)
    assert stream.isStreaming and "bar_id" in stream.columns


