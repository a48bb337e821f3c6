"""Top-of-book reconstruction and its quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import carried, islands


def top_of_book(quotes: DataFrame, order: tuple[str, ...] = ("ts_recv_ns", "topo_id")) -> DataFrame:
    """Adds ``bid``, ``ask`` and their sizes, each side carried forward; a price of 0 clears its side. Every ``dia`` starts empty."""
    w = Window.partitionBy("symbol", "dia").orderBy(*order)
    side = lambda p, q, out: {out: F.nullif(carried(F.col(p), w), F.lit(0.0)), f"{out}_qtd": carried(F.when(F.col(p).isNotNull(), F.col(q)), w)}
    return quotes.withColumns(side("preco_bid", "qtd_bid", "bid") | side("preco_ask", "qtd_ask", "ask"))


def usability(bid: Column, ask: Column, bid_size: Column, ask_size: Column, age_ns: Column, tick: Column, stale_ns: int = 5_000_000_000, wide: int = 5, thin: int = 1) -> Column:
    """Why a quote can't be used, the first reason that holds; ``ok`` otherwise."""
    return (
        F.when(bid.isNull() | ask.isNull(), "sem_livro").when(bid >= ask, "cruzado").when(age_ns > stale_ns, "velho")
        .when(ask - bid > wide * tick + 1e-9, "largo").when(F.least(bid_size, ask_size) < thin, "fino").otherwise("ok")
    )


def crossed_episodes(top: DataFrame) -> DataFrame:
    """Runs of crossed quotes by symbol: how many quotes and how long until the first uncrossed one."""
    w = Window.partitionBy("symbol", "dia").orderBy("ts_recv_ns", "topo_id")
    rows = top.withColumns({"_c": F.coalesce(F.col("bid") >= F.col("ask"), F.lit(False)), "_next": F.lead("ts_recv_ns").over(w)})
    runs = islands(rows, ["symbol", "dia"], ["ts_recv_ns", "topo_id"], F.lag("_c").over(w) != F.col("_c")).where("_c")
    return runs.groupBy("symbol", "dia", "ilha").agg(F.min("ts_recv_ns").alias("de"), F.count(F.lit(1)).alias("n"), (F.max(F.coalesce("_next", "ts_recv_ns")) - F.min("ts_recv_ns")).alias("duracao_ns"))
