"""Files and tables: corruption, overwrite guards, ledgers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet_ends(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Every file below a folder with ``valid``: whether it begins and ends with the Parquet mark, and ``in_progress`` by its suffix.

    The listing is Spark's; of each file only the first and last four bytes are read, however large it is. A file that
    can't be opened is not valid.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder).select("path", "length", "modificationTime")

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as fs

        def whole(path: str, length: int) -> bool:
            if length < 12:
                return False
            try:
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as f:
                    return f.read_at(4, 0) == b"PAR1" == f.read_at(4, length - 4)
            except OSError:
                return False

        for pdf in batches:
            yield pdf.assign(valid=[whole(p, n) for p, n in zip(pdf.path, pdf.length)])

    seen = files.mapInPandas(ends, "path string, length bigint, modificationTime timestamp, valid boolean")
    return seen.select("path", "length", "modificationTime", "valid", F.col("path").rlike(r"\.(inprogress|compacting|tmp)$").alias("in_progress"))


def footers(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """What the footers of Parquet files say, read file by file on the executors, no rows: one row per file and column.

    ``path``, ``bytes``, ``linhas``, ``grupos`` and, for each integer column of ``columns`` that the file has, ``coluna``, ``menor``,
    ``maior`` and ``nulos`` over its row groups (NULL where a group has no statistics); without such a column one row of
    NULLs. A file whose footer can't be read has NULL ``linhas``.
    """
    listed = None
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        glob = at.getName() if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile() else "*.parquet"
        one = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", "length")
        listed = one if listed is None else listed.unionByName(one)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        def of(path: str, length: int) -> Iterator[tuple]:
            try:
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as f:
                    meta = pq.read_metadata(f)
            except (OSError, pa.ArrowInvalid):
                yield path, length, None, None, None, None, None, None
                return
            groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
            place = {meta.schema.column(i).path: i for i in range(len(meta.schema.names))}
            mine = [c for c in columns if c in place]
            for c in mine or [None]:
                stats = [g.column(place[c]).statistics for g in groups] if c else []
                full = bool(stats) and all(x is not None and (x.has_min_max or x.null_count == g.num_rows) and x.has_null_count for x, g in zip(stats, groups))
                ends = [x for x in stats if x is not None and x.has_min_max]
                yield path, length, meta.num_rows, meta.num_row_groups, c, min(x.min for x in ends) if full and ends else None, max(x.max for x in ends) if full and ends else None, sum(x.null_count for x in stats) if full else None

        for pdf in batches:
            rows = [r for p, n in zip(pdf.path, pdf.length) for r in of(p, n)]
            out = pd.DataFrame(rows, columns=["path", "bytes", "linhas", "grupos", "coluna", "menor", "maior", "nulos"])
            yield out.astype({c: "Int64" for c in ("bytes", "linhas", "grupos", "menor", "maior", "nulos")})

    return listed.mapInPandas(read, "path string, bytes bigint, linhas bigint, grupos bigint, coluna string, menor bigint, maior bigint, nulos bigint")


def tolerant_scan(spark: SparkSession, folder: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The readable rows below a folder, and the files of which no row came (corrupt or empty)."""
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(folder)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(folder).select("path")
    seen = rows.select(F.col("_metadata.file_path").alias("path")).distinct()
    return rows, listed.join(seen, "path", "left_anti")


def guarded_overwrite(new: DataFrame, path: str, partition: Sequence[str], least_share: float = 0.5, reason: str | None = None) -> None:
    """Overwrites the partitions that ``new`` holds, unless one would keep fewer than ``least_share`` of its rows; ``reason`` forces it."""
    spark = new.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)  # a table that can't be read is an error, not an empty one
    if there and reason is None:
        old = spark.read.parquet(path)
        count = lambda df, name: df.groupBy(*partition).agg(F.count(F.lit(1)).alias(name))
        text = [F.col(p).cast("string").alias(p) for p in partition]
        both = count(new, "_new").select(*text, "_new").join(count(old, "_old").select(*text, "_old"), list(partition))
        shrunk = both.where(F.col("_new") < least_share * F.col("_old")).limit(5).collect()
        if shrunk:
            raise ValueError(f"these partitions would shrink too much: {[tuple(r) for r in shrunk]}")
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def replace_days(ledger: DataFrame, scored: DataFrame, day: str, key: Sequence[str]) -> DataFrame:
    """A forward ledger after days were scored again: a scored day's rows replace the old ones; other days stay."""
    days = scored.select(day).distinct()
    return ledger.join(days, day, "left_anti").unionByName(scored.dropDuplicates([day, *key]))


def compare(left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """Full-outer parity of two tables: ``lado`` (``esquerda``, ``direita``, ``ambos``) and the fields that differ."""
    a = left.select(*keys, F.struct(*fields).alias("_a"))
    b = right.select(*keys, F.struct(*fields).alias("_b"))
    both = a.join(b, list(keys), "full_outer")
    differs = [F.when(~(F.col(f"_a.{f}").eqNullSafe(F.col(f"_b.{f}")) | F.coalesce(F.abs(F.col(f"_a.{f}") - F.col(f"_b.{f}")) <= tolerance, F.lit(False))), F.lit(f)) for f in fields]
    side = F.when(F.col("_b").isNull(), "esquerda").when(F.col("_a").isNull(), "direita").otherwise("ambos")
    return both.select(*keys, side.alias("lado"), F.when(side == "ambos", F.array_compact(F.array(*differs))).otherwise(F.array().cast("array<string>")).alias("diferentes"))


def rows_by_hour(lines: DataFrame, text: str = "value", pattern: str = r"(\d{2}):\d{2}:\d{2}") -> DataFrame:
    """Lines of a platform log per hour, by the first clock in each."""
    return lines.select(F.regexp_extract(text, pattern, 1).alias("hora")).where("hora <> ''").groupBy("hora").agg(F.count(F.lit(1)).alias("linhas"))
