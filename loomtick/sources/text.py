"""Text sources: chart dumps, candles, event logs, operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import brazilian_number, chart_date

# fixed values: the dumps' prefixes and their fields in order
DUMP_FIELDS = {
    "PRCBARRA": "data hora hora_bolsa current_bar open high low close vol_total rsi mme8 mme80 atr tr",
    "BBSBARRA": "data hora hora_bolsa current_bar open high low close vol_total bb_sup bb_inf est atr tr",
    "ABSBARRA": "data hora hora_bolsa open high low close vol_total vol_agr desloc_norm z_amplitude z_vol_agr mov_contexto lado",
    "VWAPVP": "data hora hora_bolsa open high low close vol_total vol_so_agr agr_compra agr_venda vwap_bar sd_bar z_bar imbalance desloc_norm absorcao_comp absorcao_vend z_comp z_vend estimador",
}

M1_SCHEMA = "data_hora timestamp_ntz, abertura double, maxima double, minima double, fechamento double, volume double, volume_ticks double"


def dump_lines(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Every line with the prefix: its parts and ``ok``, whether their number is right. Text before the prefix is dropped."""
    text = F.rtrim(F.regexp_replace("value", r"\r", ""))
    lines = spark.read.text(path).where(F.col("value").contains(f"{kind}|"))
    parts = F.split(F.substring_index(text, f"{kind}|", -1), r"\|")
    return lines.select(parts.alias("partes")).withColumn("ok", F.size("partes") == len(DUMP_FIELDS[kind].split()))


def read_dump(spark: SparkSession, path: str, kind: str, strict: bool = True) -> DataFrame:
    """A chart dump as typed columns: ``data`` a date (from ``1YYMMDD``), the rest doubles in either number format.

    With ``strict`` a line of another width fails the read; otherwise it is left out (count them in :func:`dump_lines`).
    """
    lines = dump_lines(spark, path, kind)
    if strict:
        lines = lines.where(F.when(F.col("ok"), True).otherwise(F.raise_error(F.lit(f"a {kind} line has another number of fields")).cast("boolean")))
    else:
        lines = lines.where("ok")
    names = DUMP_FIELDS[kind].split()
    numbers = [brazilian_number(F.col("partes")[i]).alias(n) for i, n in enumerate(names) if n != "data"]
    return lines.select(chart_date(F.col("partes")[0].try_cast("bigint")).alias("data"), *numbers)


def read_candles(spark: SparkSession, path: str) -> DataFrame:
    """One-minute candles from CSV; the header must name the seven fields."""
    names = [f.name for f in T._parse_datatype_string(M1_SCHEMA).fields]
    first = [c.strip().lower() for c in (spark.read.text(path).first() or [""])[0].lstrip("﻿").split(",")]
    if first != names:
        raise ValueError(f"the header has {first}, wanted {names}")
    return spark.read.schema(M1_SCHEMA).option("header", True).option("enforceSchema", True).csv(path)


def read_event_log(spark: SparkSession, path: str, days: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """A JSON-lines log: its events (``momento``, ``evento``, ``linha``) of the wanted days, and the lines that aren't events."""
    raw = spark.read.text(path).where(F.trim("value").startswith("{"))
    parsed = raw.select(F.col("value").alias("linha"), F.from_json("value", "timestamp string, event string").alias("j"))
    moment = F.try_to_timestamp(F.col("j.timestamp"))
    rows = parsed.select("linha", moment.alias("momento"), F.col("j.event").alias("evento"))
    good = rows.where("momento is not null")
    if days is not None:
        good = good.where(F.date_format("momento", "yyyy-MM-dd").isin(days))
    return good, rows.where("momento is null").select("linha")


def read_operations(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """JSON-lines operations of many days; ``dia`` from the file's name, unreadable lines in ``_corrupt_record``."""
    full = T.StructType([*T._parse_datatype_string(schema).fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.schema(full).option("mode", "PERMISSIVE").json(folder)
    return rows.withColumn("dia", F.regexp_extract(F.col("_metadata.file_name"), r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1))
