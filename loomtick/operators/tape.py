"""The curated tape and its row-level expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import valid_ts

BUY, SELL, AUCTION, RETAIL = 2, 3, 4, 13
TAPE_COLUMNS = ("ts_ns", "ts_recv_ns", "symbol", "dt", "trade_id", "price", "quantidade", "agente_comprador", "agente_vendedor", "trade_type")
#: The tape's total order inside a symbol and day.
TAPE_ORDER = ("ts_ns", "ts_recv_ns", "trade_id")


def curate(raw: DataFrame) -> DataFrame:
    """Usable trades, each once: valid instant, price, quantity and id; of copies that received last (ties: larger values)."""
    rows = raw.where(valid_ts(F.col("ts_ns"), F.col("dt")) & (F.col("trade_id") > 0) & (F.col("price") > 0) & (F.col("quantidade") > 0))
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("agente_comprador", "agente_vendedor", "trade_type")})
    rest = [c for c in TAPE_COLUMNS if c not in ("symbol", "dt", "trade_id", "ts_recv_ns")]
    last = F.max(F.struct("ts_recv_ns", *rest)).alias("w")
    return rows.groupBy("symbol", "dt", "trade_id").agg(last).select("symbol", "dt", "trade_id", "w.*")


def is_aggressor(kind: Column) -> Column:
    return kind.isin(BUY, SELL)


def aggressor_sign(kind: Column) -> Column:
    return F.when(kind == BUY, 1).when(kind == SELL, -1).otherwise(0).cast("bigint")


def passive_broker(kind: Column, buyer: Column, seller: Column) -> Column:
    """The counter-party of the aggressor; 0 where there is none."""
    return F.when(kind == BUY, seller).when(kind == SELL, buyer).otherwise(F.lit(0))


def local_hhmm(ts_ns: Column, offset_hours: int = -3) -> Column:
    """Local clock as an integer hhmm at a fixed offset, by arithmetic on the instant."""
    minutes = F.pmod(F.floor(ts_ns / F.lit(60_000_000_000)) + F.lit(60 * offset_hours), F.lit(1440))
    return (F.floor(minutes / 60) * 100 + F.pmod(minutes, F.lit(60))).cast("bigint")


def in_session(ts_ns: Column, start: int, end: int) -> Column:
    """Whether the local hhmm is in [start, end)."""
    h = local_hhmm(ts_ns)
    return (h >= start) & (h < end)


def plausible(ts_ns: Column, ts_recv_ns: Column, years: int = 5) -> Column:
    """At most ``years`` before it was received, and not after."""
    return (ts_ns > ts_recv_ns - F.lit(years * 365 * 86_400_000_000_000)) & (ts_ns <= ts_recv_ns)
