"""Order-book feeds: doubled days, entries and exits of offers, refills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .changes import ADD, DELETE, EDIT, latest_copies, positional_changes
from .windows import islands


def undouble(rows: DataFrame, day: Sequence[str], order: Sequence[str], content: Sequence[str], least: float = 0.9) -> DataFrame:
    """Adds ``fracao_par``, ``dobrado`` and ``mantida`` to rows of days that may have been stored twice.

    A run is a series of neighbouring rows (by ``order``) that agree in all of ``content``, NULLs included. A day is
    doubled if at least ``least`` of its rows are in runs of even length; then the first half of every run (rounded up)
    is kept, else every row. Empty input gives no rows.
    """
    w = Window.partitionBy(*day).orderBy(*order)
    differs = F.lit(False)
    for c in content:
        differs = differs | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    runs = islands(rows, day, order, differs | (F.row_number().over(w) == 1), "_run")
    run, whole = Window.partitionBy(*day, "_run"), Window.partitionBy(*day)
    out = runs.withColumns({"_n": F.count(F.lit(1)).over(run), "_i": F.row_number().over(run.orderBy(*order))})
    out = out.withColumn("fracao_par", F.avg(F.when(F.col("_n") % 2 == 0, 1.0).otherwise(0.0)).over(whole))
    out = out.withColumn("dobrado", F.col("fracao_par") >= least)
    return out.withColumn("mantida", ~F.col("dobrado") | (F.col("_i") * 2 <= F.col("_n") + 1)).drop("_run", "_n", "_i")


def level_events(changes: DataFrame, day: Sequence[str], side: str = "side", seq: str = "seq", received: str = "ts_recv_ns") -> DataFrame:
    """Entries and exits of offers at their levels, from the signed images of a positional feed.

    One row per insert (``tipo`` entrada) and per offer removed (``saida_avulsa`` by a delete, ``saida_varredura`` by one that
    clears the best places), at the instant the change was received: price, quantity at that moment, broker. An edit is
    neither. Changes that meet no offer have no row.
    """
    single = latest_copies(changes, [*day, seq], received, ["action", side, "position", "offer_id", "quantidade", "price", "agente", received])
    images = positional_changes(single, [*day, side], seq, "action", "position", "quantidade", "offer_id").where("mult <> 0")
    by = single.select(*day, F.col(seq).alias("mudanca"), F.col("action").alias("_a"), F.col(received).alias("em"))
    added = single.select(*day, F.col(seq).alias("oferta_seq"), "price", "agente")
    rows = images.join(by, [*day, "mudanca"]).where((F.col("_a") != EDIT) & ((F.col("mult") == 1) == (F.col("_a") == ADD))).join(added, [*day, "oferta_seq"])
    kind = F.when(F.col("mult") == 1, "entrada").when(F.col("_a") == DELETE, "saida_avulsa").otherwise("saida_varredura")
    return rows.select(*day, side, F.col("mudanca").alias(seq), "em", kind.alias("tipo"), "price", "quantidade", "agente")


def refill_chains(events: DataFrame, day: Sequence[str], gap: int, order: str = "seq", at: str = "em") -> DataFrame:
    """Chains of refills: an exit followed by an entry of the same price, side, quantity and broker within ``gap``.

    Refills of one level no more than ``gap`` apart are one chain. Columns: the level, ``cadeia``, ``recargas`` and how many of
    them came after a sweep. A level is one small key, so a hot symbol spreads over its levels.
    """
    level = [*day, "side", "price", "quantidade", "agente"]
    w = Window.partitionBy(*level).orderBy(at, order)
    before = F.lag(F.struct("tipo", at)).over(w)
    rows = events.withColumn("_b", before)
    refill = rows.where((F.col("tipo") == "entrada") & (F.col("_b.tipo") != "entrada") & (F.col(at) - F.col(f"_b.{at}") <= gap))
    fresh = ~F.coalesce(F.col(at) - F.lag(at).over(w) <= gap, F.lit(False))
    chains = islands(refill, level, [at, order], fresh, "cadeia")
    return chains.groupBy(*level, "cadeia").agg(F.count(F.lit(1)).alias("recargas"), F.count_if(F.col("_b.tipo") == "saida_varredura").alias("apos_varredura"), F.min(at).alias("de"), F.max(at).alias("ate"))
