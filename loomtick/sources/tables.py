"""The market tape's tables, read with only the wanted columns, symbols in one spelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_NS = 86_400_000_000_000
MINUTE_NS = 60_000_000_000


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A stored table; with ``columns`` only these reach the scan. Integers come out as bigint, ``symbol`` trimmed in upper case."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    df = df.select(*columns) if columns else df
    ints = {c: F.col(c).cast("bigint") for c, kind in df.dtypes if kind in ("int", "smallint", "tinyint")}
    names = {c: plain_symbol(F.col(c)) for c in ("symbol", "ticker") if c in df.columns}
    return df.withColumns(ints | names)


def plain_symbol(c: Column) -> Column:
    """Trimmed, upper case; NULL stays NULL."""
    return F.upper(F.trim(c))


def day_number(dt: Column) -> Column:
    """Days since 1970 of a ``YYYY-MM-DD`` string; NULL if it is no date."""
    return F.unix_date(dt.try_cast("date")).cast("bigint")


def valid_ts(ts_ns: Column, dt: Column) -> Column:
    """Whether the UTC date of ``ts_ns`` is ``dt``; never NULL."""
    first = day_number(dt) * F.lit(DAY_NS)
    return F.coalesce((ts_ns >= first) & (ts_ns < first + F.lit(DAY_NS)), F.lit(False))
