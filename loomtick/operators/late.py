"""Per-period aggregates by event time, corrected by late rows up to a cut-off."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import PartitionStore, group_code, part_name


def first_received(rows: DataFrame, ident: Sequence[str], received: str, keep: Sequence[str], names_one: Column) -> DataFrame:
    """Of rows with the same identifier only the first received stays (equal instants: the smaller kept values). Rows for which ``names_one`` isn't true are all kept."""
    keep = [c for c in keep if c not in ident and c != received]
    named = rows.where(F.coalesce(names_one, F.lit(False)))
    first = F.min(F.struct(received, *keep)).alias("_w")
    single = named.groupBy(*ident).agg(first).select(*ident, *(F.col(f"_w.{c}").alias(c) for c in [received, *keep]))
    return single.unionByName(rows.where(~F.coalesce(names_one, F.lit(False))).select(*ident, received, *keep))


def arrival_partials(
    rows: DataFrame, keys: Sequence[str], event: str, received: str, period: int, correct_after: int, cut_off: int, sums: Mapping[str, Column], batch: int | None = None, sign: str | None = None
) -> DataFrame:
    """Mergeable partial aggregates: one row per key, period of ``event`` and, with ``batch``, arrival batch ``lote`` (``received`` div ``batch``).

    ``n`` and the sums hold the rows that came before their period was closed (``cut_off`` after its end); of these
    ``n_corrigida`` came more than ``correct_after`` after its end. Rows for a closed period are refused: they are in
    ``n_cortada`` only. A NULL ``received`` counts as in time, a NULL ``event`` gives no row. ``sign`` names a column of ±1:
    a row of −1 takes back what it once brought. All columns are sums, so partials of any split of the rows merge by addition.
    """
    e, r = F.col(event), F.col(received)
    start = e - F.pmod(e, F.lit(period))
    late = F.coalesce(r - (start + F.lit(period)), F.lit(0))
    open_ = late <= F.lit(cut_off)
    one = F.col(sign) if sign else F.lit(1)
    count = lambda c: F.sum(F.when(c, one).otherwise(0)).cast("bigint")
    lote = [] if batch is None else [F.expr(f"coalesce(`{received}`, 0) div {batch}").alias("lote")]
    return (
        rows.where(e.isNotNull())
        .groupBy(*keys, start.alias("janela"), *lote)
        .agg(
            count(open_).alias("n"),
            count(open_ & (late > F.lit(correct_after))).alias("n_corrigida"),
            count(~open_).alias("n_cortada"),
            *(F.sum(F.when(open_, c * one)).alias(name) for name, c in sums.items()),
        )
    )


def merge_partials(partials: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Partials combined on read to one row per key and period. Partials of partials merge the same way."""
    added = ["n", "n_corrigida", "n_cortada", *sums]
    return partials.groupBy(*keys, "janela").agg(*(F.sum(c).alias(c) for c in added), F.count(F.lit(1)).alias("lotes"))


class LateAggregates:
    """Per-period aggregates that take arrival batches one by one and never read an earlier batch's rows again.

    Kept are the partials of each batch and the identifiers counted so far, with what each brought. A batch is compared with
    the identifiers of its own groups (``group``, one of the identifier's columns: a day): one that was counted already
    changes nothing unless its new copy was received earlier, and then the partials take back the old copy and bring the
    new one. So batches may come in any order, and reading is a sum over partials. Rows that come for a closed period are
    refused in every batch alike.

    Defined cases: rows for which ``names_one`` isn't true have no identity and all count; equal copies count once; a batch
    that was applied is a no-op, a retry writes the same folders; empty batches change nothing; NULL groups are a group.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], ident: Sequence[str], group: str, event: str, received: str,
        period: int, correct_after: int, cut_off: int, sums: Sequence[str],
    ) -> None:
        self.keys, self.ident, self.group, self.event, self.received = list(keys), list(ident), group, event, received
        self.period, self.correct_after, self.cut_off, self.sums = period, correct_after, cut_off, list(sums)
        self.content = [c for c in dict.fromkeys([received, event, *sums]) if c not in ident]
        kind = {f.name: f.dataType for f in schema.fields}
        content = [T.StructField(c, kind[c]) for c in self.content]
        whole = [T.StructField(c, kind[c]) for c in dict.fromkeys([*ident, *keys])] + content
        self.seen = PartitionStore(spark, f"{root}/vistos", T.StructType([*whole, T.StructField("_named", T.BooleanType()), T.StructField("_antes", T.StructType(content))]))
        added = [T.StructField(c, T.LongType()) for c in ("janela", "n", "n_corrigida", "n_cortada", *sums)]
        self.partials = PartitionStore(spark, f"{root}/parciais", T.StructType([*(T.StructField(c, kind[c]) for c in keys), *added]))

    def merge(self, batch: str, rows: DataFrame, names_one: Column) -> None:
        if self.partials.applied(batch):
            return
        if not self.seen.applied(batch):
            codes = [r[0] for r in rows.select(group_code(self.group)).distinct().collect()]  # groups, not rows
            who = list(dict.fromkeys([*self.ident, *self.keys]))
            fresh = rows.select(*who, *self.content, F.coalesce(names_one, F.lit(False)).alias("_named"))
            both = fresh.where("_named").select(*who, *self.content, F.lit(True).alias("_new"))
            known = self.seen.in_groups(codes)
            if known:
                both = both.unionByName(self.seen.read(known).where("_named").select(*who, *self.content, F.lit(False).alias("_new")))
            held = F.struct(*self.content)
            first = both.groupBy(*who).agg(F.min(F.struct(*self.content, "_new")).alias("_w"), F.min(F.when(~F.col("_new"), held)).alias("_antes"))
            new = first.where("_w._new").select(*who, *(F.col(f"_w.{c}").alias(c) for c in self.content), F.lit(True).alias("_named"), "_antes")
            loose = fresh.where("not _named").withColumn("_antes", F.lit(None).cast(dict(new.dtypes)["_antes"]))
            self.seen.commit(batch, new.unionByName(loose).withColumn("parte", part_name(self.seen.number(batch), [self.group], F.lit(0))))
        own = self.seen.read(self.seen.parts_of(batch))
        change = F.array_compact(F.array(F.struct(F.struct(*self.content).alias("x"), F.lit(1).alias("_sign")), F.when(F.col("_antes").isNotNull(), F.struct(F.col("_antes").alias("x"), F.lit(-1).alias("_sign")))))
        signed = own.select(*self.keys, F.explode(change).alias("c")).select(*self.keys, "c.x.*", "c._sign")
        part = arrival_partials(signed, self.keys, self.event, self.received, self.period, self.correct_after, self.cut_off, {c: F.col(c) for c in self.sums}, sign="_sign")
        self.partials.commit(batch, part.withColumn("parte", part_name(self.partials.number(batch), [F.lit("")], F.lit(0))))

    def read(self) -> DataFrame:
        return merge_partials(self.partials.read(), self.keys, self.sums)
