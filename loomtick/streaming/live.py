"""The batch operators' live forms: the same results, trade by trade, from a stream."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_ORDER = ["ts_ns", "ts_recv_ns", "trade_id"]

#: A fit ``ttl_ms`` for streams that never end: state that nothing has touched for two days belongs to a day that is over. Without
#: it (None) state stays, as a replay that ends with its input needs no clock, and a clock would keep it from ending.
TTL_MS = 2 * 86_400_000


def _clock(ttl_ms: int | None) -> str:
    return "none" if ttl_ms is None else "processingTime"


def tape_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over stored tape files, with the schema they have."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def run_once(stream: DataFrame, out: str, mode: str = "append", name: str = "part") -> str:
    """Runs a stream over all that is available and ends; returns the folder of its rows. In ``complete`` mode the last result stays."""
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", f"{out}/{name}").option("checkpointLocation", f"{out}/checkpoint").outputMode("append")
    else:
        write = lambda df, batch: df.write.mode("overwrite").parquet(f"{out}/{name}")
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").outputMode(mode)
    query.trigger(availableNow=True).start().awaitTermination()
    return f"{out}/{name}"


# ---- stateful: volume bars -------------------------------------------------------------------------------------------


class _VolumeBars(StatefulProcessor):
    """One symbol and day: volume so far and the bar in formation; a bar leaves when the trade that completes it has come."""

    def __init__(self, threshold: int, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("bar", "cum bigint, open double, high double, low double, close double, volume bigint, n bigint, late bigint, last_ns bigint", self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows))
        batch = batch.sort_values(_ORDER, kind="stable")
        held = self.state.get() if self.state.exists() else (0, None, None, None, None, 0, 0, 0, 0)
        cum, o, h, lo, c, v, n, late, last = held
        out = []
        for ts, price, quantity, kind in zip(batch.ts_ns.tolist(), batch.price.tolist(), batch.quantidade.tolist(), batch.trade_type.tolist()):
            if ts < last:
                late += 1  # out of order: it counts in the bar in formation, and is reported
            last = max(last, ts)
            if kind not in (2, 3):
                continue
            bar = cum // self.threshold
            o, h, lo, c = (price if o is None else o), (price if h is None else max(h, price)), (price if lo is None else min(lo, price)), price
            v, n, cum = v + quantity, n + 1, cum + quantity
            if cum // self.threshold > bar:
                out.append((*key, bar, o, h, lo, c, v, n, late))
                o = h = lo = c = None
                v = n = late = 0
        self.state.update((cum, o, h, lo, c, v, n, late, last))
        yield pd.DataFrame(out, columns=["symbol", "dt", "bar_id", "open", "high", "low", "close", "volume", "n_trades", "atrasadas"])

    def close(self) -> None:
        pass


def live_volume_bars(stream: DataFrame, threshold: int, ttl_ms: int | None = None) -> DataFrame:
    """Closed volume bars as they complete, equal to the batch bars of an ordered feed. State: one row per symbol and day."""
    rows = stream.select("symbol", "dt", *_ORDER, "price", "quantidade", "trade_type")
    ddl = "symbol string, dt string, bar_id bigint, open double, high double, low double, close double, volume bigint, n_trades bigint, atrasadas bigint"
    return rows.groupBy("symbol", "dt").transformWithStateInPandas(_VolumeBars(threshold, ttl_ms), ddl, "append", _clock(ttl_ms))


# ---- stateful: momentum with rest ------------------------------------------------------------------------------------


class _Momentum(StatefulProcessor):
    """One symbol and day: the prices of the last ``span`` ns and the last event kept."""

    def __init__(self, span: int, limit: float, rest: int, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms
        self.span, self.limit, self.rest = span, limit, rest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.prices = handle.getListState("prices", "ts bigint, price double", self.ttl_ms)
        self.kept = handle.getValueState("kept", "ts bigint", self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows)).sort_values(_ORDER, kind="stable")
        line = list(self.prices.get()) if self.prices.exists() else []
        last = self.kept.get()[0] if self.kept.exists() else None
        out, head = [], 0
        for ts, price in zip(batch.ts_ns.tolist(), batch.price.tolist()):
            while head + 1 < len(line) and line[head + 1][0] <= ts - self.span:
                head += 1  # keeps the last price at or before the window's start
            line.append((ts, price))
            then = line[head]
            if then[0] <= ts - self.span and abs(price / then[1] - 1) >= self.limit and (last is None or ts - last >= self.rest):
                out.append((*key, ts, price, price - then[1]))
                last = ts
        self.prices.put(line[head:])
        if last is not None:
            self.kept.update((last,))
        yield pd.DataFrame(out, columns=["symbol", "dt", "ts_ns", "price", "movimento"])

    def close(self) -> None:
        pass


def live_momentum(stream: DataFrame, span_ns: int = 60_000_000_000, limit: float = 0.0005, rest_ns: int = 600_000_000_000, ttl_ms: int | None = None) -> DataFrame:
    """Events where the price moved by at least ``limit`` against the last one a span ago, with a rest after each kept event."""
    rows = stream.select("symbol", "dt", *_ORDER, "price")
    return rows.groupBy("symbol", "dt").transformWithStateInPandas(_Momentum(span_ns, limit, rest_ns, ttl_ms), "symbol string, dt string, ts_ns bigint, price double, movimento double", "append", _clock(ttl_ms))


# ---- stateful: a condition that lasts --------------------------------------------------------------------------------


class _Lasting(StatefulProcessor):
    """One key: since when the condition has held, and whether this run has fired."""

    def __init__(self, at_least: int, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms
        self.at_least = at_least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "since bigint, fired boolean", self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows)).sort_values(["at", "seq"], kind="stable")
        since, fired = self.run.get() if self.run.exists() else (None, False)
        out = []
        for at, holds in zip(batch["at"].tolist(), batch["holds"].tolist()):
            if not holds:
                since, fired = None, False
                continue
            since = at if since is None else since
            if not fired and at - since >= self.at_least:
                out.append((*key, since, at))
                fired = True
        self.run.update((since, fired))
        yield pd.DataFrame(out, columns=["symbol", "desde", "disparo"])

    def close(self) -> None:
        pass


def live_lasting(stream: DataFrame, at: str, seq: str, condition: str, at_least_ns: int, ttl_ms: int | None = None) -> DataFrame:
    """Fires once per run of rows on which ``condition`` (SQL; NULL is false) has held for at least ``at_least_ns``, at the first row that shows it."""
    rows = stream.select("symbol", F.col(at).alias("at"), F.col(seq).alias("seq"), F.coalesce(F.expr(condition), F.lit(False)).alias("holds"))
    return rows.groupBy("symbol").transformWithStateInPandas(_Lasting(at_least_ns, ttl_ms), "symbol string, desde bigint, disparo bigint", "append", _clock(ttl_ms))


# ---- declarative ------------------------------------------------------------------------------------------------------


def with_event_time(stream: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Adds ``evento`` (microseconds of ``ts_ns``) and its watermark. Unlike a strictly ordered feed, rows later than ``lateness`` are dropped by aggregates."""
    return stream.withColumn("evento", F.timestamp_micros(F.expr("ts_ns div 1000"))).withWatermark("evento", lateness)


def live_time_bars(stream: DataFrame, period: str = "5 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Open, high, low, close and volume per window of event time; in append mode a window leaves when the watermark passes it."""
    at = F.struct(*_ORDER)
    rows = with_event_time(stream, lateness).where("trade_type in (2, 3)")
    bars = rows.groupBy("symbol", F.window("evento", period)).agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum("quantidade").alias("volume"), F.count(F.lit(1)).alias("n_trades"))
    return bars.select("symbol", F.unix_micros("window.start").alias("inicio_us"), "open", "high", "low", "close", "volume", "n_trades")


def live_vwap(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Each symbol and day's VWAP so far (update mode; in append mode once the day is over). A day's sums leave the state when the watermark passes it."""
    rows = with_event_time(stream, lateness)
    sums = rows.groupBy("symbol", "dt", F.window("evento", "1 day")).agg(F.sum(F.col("price") * F.col("quantidade")).alias("_pq"), F.sum("quantidade").alias("volume"))
    return sums.select("symbol", "dt", (F.col("_pq") / F.col("volume")).alias("vwap"), "volume")


def live_lag(stream: DataFrame, period: str = "5 minutes") -> DataFrame:
    """Receive minus event time per period of arrival."""
    rows = stream.withColumn("chegada", F.timestamp_micros(F.expr("ts_recv_ns div 1000"))).withWatermark("chegada", "1 hour")
    lag = F.col("ts_recv_ns") - F.col("ts_ns")
    return rows.groupBy("symbol", F.window("chegada", period)).agg(F.count(F.lit(1)).alias("n"), F.max(lag).alias("pior"), F.avg(lag).alias("media")).select("symbol", F.unix_micros("window.start").alias("inicio_us"), "n", "pior", "media")


def single_delivery(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Drops copies of a message that come again within ``lateness``; state is bounded by the watermark."""
    return with_event_time(stream, lateness).dropDuplicatesWithinWatermark(["symbol", "dt", "trade_id"]).drop("evento")


def fan_out(stream: DataFrame, out: str, consumers: Callable[[], Mapping[str, Callable[[DataFrame], DataFrame]]]) -> None:
    """One feed to several consumers: each micro-batch is read once and every consumer's rows are written to ``out/<name>``.

    ``consumers`` is asked at every micro-batch, so one that is added sees the feed from then on and one that is removed
    sees no more. A consumer's files are named by the micro-batch, so a retry replaces them; an error of one stops the query,
    as dropping its rows without a word would be worse.
    """

    def write(df: DataFrame, batch: int) -> None:
        held = df.persist()
        try:
            for name, consume in sorted(consumers().items()):
                consume(held).write.mode("overwrite").parquet(f"{out}/{name}/lote={batch:08d}")
        finally:
            held.unpersist()

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()


class SlotBoard:
    """One owner per key at a time: who asks first holds a key until it is released; asking again by the owner is fine."""

    def __init__(self) -> None:
        self._held: dict[str, str] = {}
        self._lock = threading.Lock()

    def take(self, key: str, owner: str) -> bool:
        with self._lock:
            return self._held.setdefault(key, owner) == owner

    def release(self, key: str, owner: str) -> bool:
        with self._lock:
            mine = self._held.get(key) == owner
            if mine:
                del self._held[key]
            return mine


def conserved(received: DataFrame, *parts: DataFrame) -> DataFrame:
    """Whether what was received is what was written: rows on one side and the sum over the parts, and ``conservado``."""
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    total = reduce(DataFrame.unionByName, [n(p, "escritas") for p in parts]).agg(F.sum("escritas").alias("escritas"))
    both = n(received, "recebidas").crossJoin(F.broadcast(total))  # one row each
    return both.withColumn("conservado", F.col("recebidas") == F.col("escritas"))


# ---- stateful: day profile and bars that close by the clock -------------------------------------------------------------


def live_profile(stream: DataFrame, bin_size: float, lateness: str = "1 hour") -> DataFrame:
    """Volume by price bin of each symbol and day so far: total, aggressor buys and sells. A day leaves the state with the watermark."""
    rows = with_event_time(stream, lateness).withColumn("faixa", F.floor(F.col("price") / bin_size) * bin_size)
    side = lambda k: F.sum(F.when(F.col("trade_type") == k, F.col("quantidade")).otherwise(0))
    p = rows.groupBy("symbol", "dt", F.window("evento", "1 day"), "faixa").agg(F.sum("quantidade").alias("volume"), side(2).alias("compra"), side(3).alias("venda"))
    return p.drop("window")


class _ClockBars(StatefulProcessor):
    """One symbol: the bar in formation; it leaves with the first trade of a later bucket, or when event time passes its end."""

    def __init__(self, period_ms: int) -> None:
        self.period = period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bar = handle.getValueState("bar", "bucket bigint, open double, high double, low double, close double, volume bigint")

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["symbol", "bucket", "open", "high", "low", "close", "volume", "pelo_relogio"])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows)).sort_values(_ORDER, kind="stable")
        bar = self.bar.get() if self.bar.exists() else None
        out = []
        for ts, price, quantity in zip(batch.ts_ns.tolist(), batch.price.tolist(), batch.quantidade.tolist()):
            bucket = ts // 1_000_000 // self.period
            if bar is not None and bucket > bar[0]:
                out.append((*key, *bar, False))
                bar = None
            if bar is None:
                bar = (bucket, price, price, price, price, quantity)
            else:
                bar = (bar[0], bar[1], max(bar[2], price), min(bar[3], price), price, bar[5] + quantity)
        self.bar.update(bar)
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer((bar[0] + 1) * self.period)
        yield self._frame(out)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.bar.exists():
            bar = self.bar.get()
            self.bar.clear()
            yield self._frame([(*key, *bar, True)])

    def close(self) -> None:
        pass


def live_clock_bars(stream: DataFrame, period_ms: int = 300_000, lateness: str = "0 seconds") -> DataFrame:
    """Bars that close by a later trade of their symbol, or by the clock of the whole feed when the symbol is silent (``pelo_relogio``): a
    timer fires once the watermark passes the bar's end. A trade that comes after its bar left starts a bar of its own."""
    rows = with_event_time(stream, lateness).where("trade_type in (2, 3)").select("symbol", *_ORDER, "price", "quantidade", "evento")
    ddl = "symbol string, bucket bigint, open double, high double, low double, close double, volume bigint, pelo_relogio boolean"
    return rows.groupBy("symbol").transformWithStateInPandas(_ClockBars(period_ms), ddl, "append", "eventTime")


def partitioned_ingest(stream: DataFrame, out: str) -> None:
    """Writes raw rows to ``bruto/dt=/sym=``, and rows of earlier days than their arrival's to ``quarentena``; none is dropped.

    The day is that of the event, or of the arrival where the event has no instant. A micro-batch's files are named by its
    number, so a retry replaces them.
    """

    def write(df: DataFrame, batch: int) -> None:
        at = F.when(F.col("ts_ns") > 0, F.col("ts_ns")).otherwise(F.col("ts_recv_ns"))
        day = lambda c: F.date_format(F.timestamp_micros(F.expr(f"{c} div 1000") if isinstance(c, str) else F.floor(c / 1000).cast("bigint")), "yyyy-MM-dd")
        rows = df.drop("dt").withColumns({"dt": day(at), "sym": F.regexp_replace("symbol", "[^A-Za-z0-9._-]", "_"), "_late": day(at) < day(F.col("ts_recv_ns"))})
        for late, folder in ((False, "bruto"), (True, "quarentena")):
            part = rows.where(F.col("_late") == late).drop("_late")
            part.repartition("dt", "sym").sortWithinPartitions("dt", "sym", "ts_ns").write.mode("overwrite").option("maxRecordsPerFile", 5_000_000).option("compression", "zstd").partitionBy("dt", "sym").parquet(f"{out}/{folder}/lote={batch:08d}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
