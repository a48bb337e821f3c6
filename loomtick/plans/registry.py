"""Queries by name, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tape import TAPE_COLUMNS, curate
from ..session import stored
from ..sources.tables import table

SQL_SYMBOL = "upper(trim(symbol))"
SQL_VALID = "(ts_ns >= epoch_ns(try_cast(dt AS timestamp)) AND ts_ns < epoch_ns(try_cast(dt AS timestamp)) + 86400000000000)"

#: The curated tape in SQL; every query over it starts with this.
SQL_TAPE = f"""tape AS (
  SELECT symbol, dt, trade_id, w.* FROM (
    SELECT {SQL_SYMBOL} AS symbol, dt, trade_id,
      max({{'ts_recv_ns': ts_recv_ns, 'ts_ns': ts_ns, 'price': price, 'quantidade': quantidade, 'agente_comprador': coalesce(agente_comprador, 0)::bigint,
            'agente_vendedor': coalesce(agente_vendedor, 0)::bigint, 'trade_type': coalesce(trade_type, 0)::bigint}}) AS w
    FROM trades WHERE {SQL_VALID} AND trade_id > 0 AND price > 0 AND quantidade > 0 GROUP BY 1, 2, 3))"""


def tape(spark: SparkSession, d: str) -> DataFrame:
    return curate(table(spark, d, "trades", *TAPE_COLUMNS))


def tape_once(spark: SparkSession, d: str) -> DataFrame:
    """The tape for plans that need it several times: curated once, written to the shared folder, read from there."""
    return stored(tape(spark, d), "fita")


def quotes(spark: SparkSession, d: str) -> DataFrame:
    """Quotes with their day (days since 1970): books start empty each day, so windows are bounded by it."""
    return table(spark, d, "topo_livro").where("ts_recv_ns > 0").withColumn("dia", F.expr("ts_recv_ns div 86400000000000"))


SQL_QUOTES = f"quotes AS (SELECT topo_id, {SQL_SYMBOL} AS symbol, preco_bid, qtd_bid, preco_ask, qtd_ask, ts_recv_ns, ts_recv_ns // 86400000000000 AS dia FROM topo_livro WHERE ts_recv_ns > 0)"


def r6(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


class Registry:
    """Collects queries and SQL under one name."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable:
        def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
            self.queries[f.__name__] = f
            if sql is not None:
                self.sql[f.__name__] = sql
            return f

        return keep
