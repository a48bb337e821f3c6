"""Far too many small files: a checkpointed streaming compactor."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.store import PartitionStore, part_name

_LISTING = T.StructType([T.StructField("file_id", T.LongType()), T.StructField("path", T.StringType()), T.StructField("scan_ts", T.TimestampNTZType())])
_COUNTS = "fluxo string, symbol string, dt string, file_id bigint, n bigint"
_PLAN = "fluxo string, symbol string, dt string, file_id bigint, linhas bigint"


class StreamingCompactor:
    """Merges the closed, small capture files of a partition into well-sized ones.

    A file stream over the listing (Structured Streaming keeps in its checkpoint which parts of the listing it has seen)
    hands each new part over once. A micro-batch stores its part of the listing, counts the rows of files that it is the
    first to show closed, plans from the stored listings and counts the files that are closed, small, in a partition with
    enough such files, and not merged yet, writes their rows, and publishes rows and manifest under the micro-batch's id.
    A retried micro-batch writes the same folders again and publishes once, so no row is lost or doubled.

    ``streams``: table name → its rows with ``file_id`` and the partition columns ``symbol`` and ``dt``. A file is closed
    if the path of its latest listing ends in ``.parquet`` (equal ``scan_ts``: the larger path); a closed file's rows don't
    change. It is small if its stream holds at least 1 and fewer than ``small`` rows of it. A listed file without rows, a
    row without a listed file, and NULL ids are left alone. An empty listing plans nothing.

    Output partitions are (micro-batch, symbol and dt, slice): a reader of one symbol and day opens that day's files only,
    and one of more than ``target_rows`` is cut into slices of whole files, so that it is written by several tasks.

    Scale: what a micro-batch plans with is one row per file, never the rows; it reads three columns of the rows for the new
    files' counts (map-side aggregation), and moves only rows of planned files.
    """

    def __init__(self, spark: SparkSession, root: str, streams: Mapping[str, DataFrame], small: int = 40, least_files: int = 4, target_rows: int = 1_000_000) -> None:
        self.spark, self.root, self.streams = spark, root, dict(streams)
        self.small, self.least, self.target = small, least_files, target_rows
        self.listing = PartitionStore(spark, f"{root}/listagem", _LISTING)
        self.counts = PartitionStore(spark, f"{root}/contagem", T._parse_datatype_string(_COUNTS))
        self.plan = PartitionStore(spark, f"{root}/plano", T._parse_datatype_string(_PLAN))
        self.output = {n: PartitionStore(spark, f"{root}/{n}", T.StructType(df.schema.fields)) for n, df in self.streams.items()}

    def _count(self, part: DataFrame, batch: str) -> None:
        """Rows per file and partition of the files that this part shows closed for the first time."""
        closed = part.where(F.col("file_id").isNotNull() & F.col("path").endswith(".parquet")).select("file_id").distinct()
        if self.counts.manifest()["parts"]:
            closed = closed.join(self.counts.read().select("file_id").distinct(), "file_id", "left_anti")
        counted = None
        for name, rows in self.streams.items():
            n = rows.where(F.col("file_id").isNotNull()).groupBy("file_id", "symbol", "dt").agg(F.count(F.lit(1)).alias("n"))
            n = n.join(closed, "file_id", "left_semi").select(F.lit(name).alias("fluxo"), "symbol", "dt", "file_id", "n")
            counted = n if counted is None else counted.unionByName(n)
        self.counts.commit(batch, counted.withColumn("parte", part_name(self.counts.number(batch), ["fluxo"], F.lit(0))))

    def candidates(self) -> DataFrame:
        """Every closed, small file of the listings so far, with its partition and ``na_particao``, the partition's number of such files."""
        latest = self.listing.read().where(F.col("file_id").isNotNull()).groupBy("file_id").agg(F.max(F.struct("scan_ts", "path")).alias("u"))
        closed = latest.where(F.col("u.path").endswith(".parquet")).select("file_id")
        small = self.counts.read().withColumn("linhas", F.sum("n").over(Window.partitionBy("fluxo", "file_id"))).where(F.col("linhas") < self.small)
        files = small.join(closed, "file_id").select("fluxo", "symbol", "dt", "file_id", "linhas")
        sizes = files.groupBy("fluxo", "symbol", "dt").agg(F.count(F.lit(1)).alias("na_particao"))
        return files.join(sizes, ["fluxo", "symbol", "dt"])

    def _batch(self, part: DataFrame, batch_id: int) -> None:
        batch = f"{batch_id:08d}"
        self.listing.commit(batch, part.select(*_LISTING.names).withColumn("parte", part_name(self.listing.number(batch), [F.lit("")], F.lit(0))))
        if not self.counts.applied(batch):
            self._count(part, batch)
        if not self.plan.applied(batch):
            due = self.candidates().where(F.col("na_particao") >= self.least)
            if self.plan.manifest()["parts"]:
                due = due.join(self.plan.read().select("fluxo", "file_id").distinct(), ["fluxo", "file_id"], "left_anti")
            self.plan.commit(batch, due.select("fluxo", "symbol", "dt", "file_id", "linhas").withColumn("parte", part_name(self.plan.number(batch), [F.lit("")], F.lit(0))))
        mine = self.plan.read(self.plan.parts_of(batch))
        for name, rows in self.streams.items():
            store = self.output[name]
            if store.applied(batch):
                continue
            planned = mine.where(F.col("fluxo") == name)
            slices = planned.groupBy("symbol", "dt").agg(F.ceil(F.sum("linhas") / F.lit(self.target)).cast("bigint").alias("_slices"))
            files = planned.join(slices, ["symbol", "dt"]).groupBy("file_id").agg(F.max("_slices").alias("_slices"))
            moved = rows.join(files, "file_id").withColumn("parte", part_name(store.number(batch), ["symbol", "dt"], F.pmod(F.xxhash64("file_id"), F.col("_slices"))))
            store.commit(batch, moved.select(*rows.columns, "parte").repartition("parte").sortWithinPartitions("parte", "file_id"))

    def run(self, listing_path: str, files_per_batch: int | None = None) -> StreamingCompactor:
        """Processes all available listings and ends; a later call goes on from the checkpoint."""
        schema = self.spark.read.parquet(listing_path).schema
        reader = self.spark.readStream.schema(schema)
        reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader
        at = self.listing._path(listing_path)
        if self.listing._fs.getFileStatus(at).isFile():  # a file source watches folders
            reader, listing_path = reader.option("pathGlobFilter", at.getName()), at.getParent().toString()
        stream = reader.parquet(listing_path).select("file_id", "path", "scan_ts")
        query = stream.writeStream.foreachBatch(self._batch).option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        return self

    def merged_files(self) -> DataFrame:
        """The files merged so far: stream, partition, file and rows."""
        return self.plan.read().select("fluxo", "symbol", "dt", "file_id", "linhas")

    def compacted(self, name: str) -> DataFrame:
        """The merged rows of a stream, each exactly once."""
        return self.output[name].read().drop("parte")

    def current(self, name: str) -> DataFrame:
        """The whole stream for readers: merged rows from the new files, all others from where they are, each exactly once."""
        rest = rest_of(self.streams[name], self.merged_files().where(F.col("fluxo") == name))
        return self.compacted(name).unionByName(rest)


def rest_of(rows: DataFrame, merged: DataFrame, keep: Column | None = None) -> DataFrame:
    """The rows of a stream that stay where they are: those of files that weren't merged, and those without a file. ``merged`` holds that stream's files only."""
    left = rows.join(merged.select("file_id").distinct(), "file_id", "left_anti").select(*rows.columns)
    return left if keep is None else left.where(keep)
