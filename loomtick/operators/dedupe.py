"""Messages delivered more than once: exactly one copy of each stays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import PartitionStore, group_code, part_name


def single_winners(rows: DataFrame, ident: Sequence[str], rank: Sequence[str], keep: Sequence[str], copies: Column | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """One row per identifier: that with the largest ``rank``, ties broken by the kept values, so the order of rows never matters.

    ``copies`` counts what a row stands for (None: 1); of each ``carry`` column the largest value stays. A map-side aggregate: a hot identifier shrinks before the shuffle.
    """
    best = F.max(F.struct(*rank, *(c for c in keep if c not in rank)))
    out = rows.groupBy(*ident).agg(best.alias("_w"), F.sum(copies if copies is not None else F.lit(1)).cast("bigint").alias("copias"), *(F.max(c).alias(c) for c in carry))
    return out.select(*ident, *(F.col(f"_w.{c}").alias(c) for c in dict.fromkeys([*rank, *keep])), "copias", *carry)


#: Groups of one batch whose numbers of rows are broadcast; beyond it they are joined.
BROADCAST_GROUPS = 10_000


class DeliveryStore:
    """A de-duplicated table fed by batches of at-least-once deliveries.

    Physical partitions are (batch of first delivery, group, slice of identifiers), so a copy that comes again in a later
    batch belongs to an older partition. An identifier index (identifier → partition), itself kept by batch and group, is
    looked up with the batch's identifiers, reading only the groups the batch has; only the partitions found are read,
    combined with the incoming messages, reduced to single winners and atomically overwritten together with the batch's
    new partitions. A group's number of slices follows from its rows in the batch, ``rows_per_slice`` at most each, so
    partitions stay of one size however large a group grows; one that is overwritten gets no new identifiers.

    Defined cases: rows with a NULL in any identifier column name no message and are refused (:meth:`merge` ignores them,
    callers keep them apart); batch ids and group values may be any text, as folders are named by numbers and hashes; of
    equal ranks the larger kept values win; a batch id that was applied is a no-op, so a retry changes nothing; a retry
    after half a batch (messages published, index not) completes it; an empty batch changes nothing; columns that aren't
    named are dropped.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, ident: Sequence[str], group: str, rank: Sequence[str], keep: Sequence[str], rows_per_slice: int = 250_000) -> None:
        if group not in ident:
            raise ValueError("the group must be one of the identifier's columns")
        self.spark, self.ident, self.group, self.rank = spark, list(ident), group, list(rank)
        self.keep, self.rows_per_slice = [c for c in keep if c not in rank], rows_per_slice
        kind = {f.name: f.dataType for f in schema.fields}
        own = [T.StructField(c, kind[c]) for c in [*self.ident, *self.rank, *self.keep]]
        self.data = PartitionStore(spark, f"{root}/mensagens", T.StructType([*own, T.StructField("copias", T.LongType())]))
        self.index = PartitionStore(spark, f"{root}/indice", T.StructType([*own[: len(self.ident)], T.StructField("casa", T.StringType())]))

    def merge(self, batch: str, incoming: DataFrame) -> int:
        """Applies one batch; returns how many historical partitions were overwritten."""
        if self.index.applied(batch):
            return 0
        known = F.lit(True)
        for c in self.ident:
            known = known & F.col(c).isNotNull()
        rows = incoming.where(known)
        number, affected = self.data.number(batch), 0
        if not self.data.applied(batch):
            counted = rows.groupBy(self.group).agg(F.count(F.lit(1)).alias("n")).select(self.group, group_code(self.group).alias("code"), "n").collect()  # groups, not rows
            index = self.index.read(self.index.in_groups(r["code"] for r in counted))
            hit = [r[0] for r in index.join(rows.select(*self.ident), self.ident, "left_semi").select("casa").distinct().collect()]  # names of partitions, not rows
            both = rows.select(*self.ident, *self.rank, *self.keep, F.lit(1).cast("bigint").alias("copias"), F.lit(None).cast("string").alias("casa"))
            both = both.unionByName(self.data.read(hit).withColumnRenamed("parte", "casa")) if hit else both
            single = single_winners(both, self.ident, self.rank, self.keep, F.col("copias"), ["casa"])
            self.data.commit(batch, self._housed(single, number, [(r[0], r["n"]) for r in counted]))
            affected = len(hit)
        added = self.data.read(self.data.parts_of(batch)).select(*self.ident, F.col("parte").alias("casa"))
        self.index.commit(batch, added.withColumn("parte", part_name(number, [self.group], F.lit(0))))
        return affected

    def _housed(self, single: DataFrame, number: int, counted: list[tuple]) -> DataFrame:
        """Adds ``parte``: a known message's own partition, a new one's slice of its group in this batch.

        Slices are ranges of the very hash that spread the aggregation, so each is written by one task or a few neighbours
        and no further exchange is needed.
        """
        spread = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        pieces = [(g, min(spread, -(-n // self.rows_per_slice))) for g, n in counted]
        slices = self.spark.createDataFrame(pieces, T.StructType([self.data.schema[self.group], T.StructField("_slices", T.LongType())]))
        slices = F.broadcast(slices) if len(pieces) <= BROADCAST_GROUPS else slices
        piece = F.expr(f"pmod(hash({', '.join(f'`{c}`' for c in self.ident)}), {spread}) * _slices div {spread}")
        return single.join(slices, self.group, "left").withColumn("parte", F.coalesce("casa", part_name(number, [self.group], piece)))

    def read(self) -> DataFrame:
        """Every message once, with ``copias``, the number of rows it came in."""
        return self.data.read().drop("parte")
