"""Applying a feed of inserts, updates and deletes, keyed or by position in an ordered book."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

ADD, EDIT, DELETE, DELETE_FROM = 0, 1, 2, 3

#: Changes that one task replays at a time. Longer feeds are cut here and the pieces composed.
SEGMENT = 65_536


def latest_copies(changes: DataFrame, ident: Sequence[str], rank: str, fields: Sequence[str]) -> DataFrame:
    """Of several copies of a change the one with the largest ``rank`` holds in all its fields; equal ranks: the larger fields. NULL ranks lose."""
    best = F.max(F.struct(F.col(rank).alias("_rank"), *fields)).alias("_w")
    return changes.groupBy(*ident).agg(best).select(*ident, *(F.col(f"_w.{c}").alias(c) for c in fields))


def merge_signed(base: DataFrame | None, signed: DataFrame, image: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """The signed multiset's sum: rows of ``base`` count +1, changes bring ``mult`` (−1 their before-image, +1 their
    after-image), and rows of positive multiplicity remain, each with ``mult`` and the largest of each ``carry`` column.

    NULLs in the image compare as equal, repeated rows add up, the order of rows is irrelevant, empty inputs are fine.
    """
    rows = signed.select(*image, "mult", *carry)
    if base is not None:
        nothing = [F.lit(None).cast(dict(rows.dtypes)[c]).alias(c) for c in carry]
        rows = base.select(*image, F.lit(1).cast("bigint").alias("mult"), *nothing).unionByName(rows)
    out = rows.groupBy(*image).agg(F.sum("mult").alias("mult"), *(F.max(c).alias(c) for c in carry))
    return out.where(F.col("mult") > 0)


def apply_changes(base: DataFrame | None, changes: DataFrame, change_id: Sequence[str], rank: str, before: str, after: str, image: Sequence[str]) -> DataFrame:
    """The table after a feed whose changes carry both images as structs (NULL ``before``: insert, NULL ``after``: delete).

    Repeated deliveries of a change are reduced to the copy of the largest ``rank``; as multiplicities only add up, no
    order is needed and out-of-order changes give the same table. Returns ``image`` and ``mult``. A change of two NULL
    images changes nothing.
    """
    single = latest_copies(changes, change_id, rank, [before, after])
    sides = F.array(F.struct(F.col(before).alias("i"), F.lit(-1).cast("bigint").alias("mult")), F.struct(F.col(after).alias("i"), F.lit(1).cast("bigint").alias("mult")))
    signed = single.select(F.explode(sides).alias("s")).where("s.i is not null").select(*(F.col(f"s.i.{c}").alias(c) for c in image), "s.mult")
    return merge_signed(base, signed, image)


# ---- positional books -------------------------------------------------------------------------------------------------


class Lengths:
    """The length of a book after some changes as a function of its length before: rising by steps of 0 or 1, held as its
    value at 0 and the steps that rise by 0, which are all below ``cleared`` and those in ``flat`` (sorted). Closed under
    composition, so pieces of a feed are independent."""

    def __init__(self, base: int = 0, cleared: int = 0, flat: Sequence[int] = ()) -> None:
        self.base, self.cleared, self.flat = base, cleared, list(flat)

    def _rising(self, k: int) -> tuple[int, int]:
        """The k-th step (from 0) that still rises, and how many steps of ``flat`` lie before it."""
        lo, hi = 0, len(self.flat)
        while lo < hi:
            mid = (lo + hi) // 2
            if self.flat[mid] - self.cleared - mid <= k:
                lo = mid + 1
            else:
                hi = mid
        return self.cleared + k + lo, lo

    def delete(self, position: int) -> None:
        if position < self.base:
            self.base -= 1
        else:
            insort(self.flat, self._rising(position - self.base)[0])

    def delete_from(self, position: int) -> None:
        """Removes 0 to ``position`` in one step, however far beyond the end it lies."""
        own = min(position + 1, self.base)
        self.base -= own
        if position + 1 > own:
            last, before = self._rising(position - own)
            self.cleared, self.flat = last + 1, self.flat[before:]

    def replay(self, actions: Sequence[int], positions: Sequence[int]) -> Lengths:
        for a, p in zip(actions, positions):
            if a == ADD:
                self.base += 1
            elif a == DELETE:
                self.delete(p)
            elif a == DELETE_FROM:
                self.delete_from(p)
        return self

    def after(self, before: int) -> int:
        return self.base + before - min(before, self.cleared) - bisect_left(self.flat, before)


#: The quantity that an offer of the book before a segment has there, not known inside it; and a NULL among integers.
KEPT, NULL = -(2**61), -(2**62)


def replay_segment(length: int, actions: Sequence[int], positions: Sequence[int], quantities: Sequence[int]) -> tuple[list[int], list[tuple[int, int, int, int]], dict[int, int]]:
    """A segment's replay from ``length`` unknown offers: the book after it, the images of every effective change in order, and
    the quantities set.

    Offers are named −1−i (offer i of the book before) or j (added by the segment's change j). An image is (name, quantity
    or KEPT, −1 before or +1 after, number of its change): an insert has the one after, a removal the one before, an edit both.
    """
    book, images, now = list(range(-1, -length - 1, -1)), [], {}
    for j, (a, p, q) in enumerate(zip(actions, positions, quantities)):
        if a == ADD:
            book.insert(p, j)
            now[j] = q
            images.append((j, q, 1, j))
        elif a == DELETE_FROM:
            images.extend((n, now.get(n, KEPT), -1, j) for n in book[: p + 1])
            del book[: p + 1]
        elif p < len(book) and a == EDIT:
            n = book[p]
            images += ((n, now.get(n, KEPT), -1, j), (n, q, 1, j))
            now[n] = q
        elif p < len(book) and a == DELETE:
            n = book.pop(p)
            images.append((n, now.get(n, KEPT), -1, j))
    return book, images, now


Columns = dict[str, np.ndarray]


def _runs(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[tuple[tuple, Columns]]:
    """Whole groups of a partition that is sorted by ``keys``, as arrays; a group may span batches."""
    held: list[Columns] = []
    key: tuple | None = None
    joined = lambda: held[0] if len(held) == 1 else {c: np.concatenate([h[c] for h in held]) for c in held[0]}
    for pdf in batches:
        if pdf.empty:
            continue
        cols = {c: pdf[c].to_numpy() for c in pdf.columns}
        new = np.zeros(len(pdf), bool)
        new[0] = True
        for k in keys:
            v, gap = cols[k], pd.isna(cols[k])
            new[1:] |= (v[1:] != v[:-1]) & ~(gap[1:] & gap[:-1])
        cut = [*np.flatnonzero(new).tolist(), len(pdf)]
        for lo, hi in zip(cut, cut[1:]):
            now = tuple(None if pd.isna(v) else v for v in (cols[k][lo] for k in keys))
            if held and now != key:
                yield key, joined()
                held = []
            key = now
            held.append({c: v[lo:hi] for c, v in cols.items()})
    if held:
        yield key, joined()


def _grouped(df: DataFrame, keys: Sequence[str], order: Sequence[str], each: Callable[[tuple, Columns], dict], schema: str) -> DataFrame:
    """``each`` for every group, streamed through sorted partitions: many small groups share a task and its Arrow batches.

    It answers with equally long columns beside the key's; a key column it names itself is taken from it.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def frame(parts: dict[str, list]) -> pd.DataFrame:
        return pd.DataFrame({c: np.concatenate(v) for c, v in parts.items()})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, rows = {c: [] for c in names}, 0
        for key, cols in _runs(batches, keys):
            got = each(key, cols)
            n = len(next(iter(got.values())))
            for c in names:
                if c in got:
                    v = got[c]
                    out[c].append(v if isinstance(v, np.ndarray) else np.array(v, dtype=object))
                else:
                    v = np.empty(n, object)
                    v[:] = key[keys.index(c)]
                    out[c].append(v)
            rows += n
            if rows > 50_000:
                yield frame(out)
                out, rows = {c: [] for c in names}, 0
        if rows:
            yield frame(out)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def positional_changes(changes: DataFrame, book: Sequence[str], seq: str, action: str, position: str, quantity: str, offer: str, segment: int = SEGMENT) -> DataFrame:
    """Resolves changes by position into the signed before- and after-images of the offers they meet.

    ``changes`` holds each change once; ``seq`` orders those of a ``book`` (its columns: strings or integers) and is
    near gapless from 1. Every book starts empty; position 0 is the best. ADD inserts (beyond the end: at the end), EDIT
    sets the quantity, DELETE removes, DELETE_FROM removes 0 to position. Other actions, NULL or negative positions, a
    NULL ``seq``, and edits and deletes beyond the last offer change nothing.

    Columns out: the book's, ``oferta_seq`` (the change that added the offer: its identity), ``offer_id``, ``quantidade``,
    ``mult``, ``mudanca`` (the change an image comes from) and ``place``. Every effective change gives its images: −1 the offer as it was, +1 as it is after; the sum
    over a feed leaves the offers that stay. Beside them, with ``mult`` 0, the offers of the last book tell their
    ``place``, which follows from the order of a book and not from any one change.

    Scale: a feed is cut every ``segment`` changes. Segments are replayed in parallel, each from a book of known length
    but unknown offers; the lengths come from composing step functions that the segments yield without knowing where they
    start. Images name unknown offers by their place in the book before the segment, and a join with that book resolves
    them. Composed book by book are the books between segments, each at most the book's depth, never the feed. So a book
    with a third of all changes costs one task only its books at the cuts.
    """
    keys = [f"k{i}" for i in range(len(book))]
    kinds = dict(changes.dtypes)
    key_ddl = ", ".join(f"{k} {kinds[b]}" for k, b in zip(keys, book))
    rows = (
        changes.where(F.col(seq).isNotNull() & F.col(action).isin(ADD, EDIT, DELETE, DELETE_FROM) & (F.col(position) >= 0))
        .select(
            *(F.col(b).alias(k) for b, k in zip(book, keys)),
            F.expr(f"`{seq}` div {segment}").alias("seg"),
            F.col(seq).cast("bigint").alias("seq"),
            F.col(action).cast("bigint").alias("a"),
            F.col(position).cast("bigint").alias("p"),
            F.coalesce(F.col(quantity).cast("bigint"), F.lit(NULL)).alias("q"),
            F.coalesce(F.col(offer).cast("bigint"), F.lit(NULL)).alias("o"),
        )
    )

    rows = stored(rows, "mudancas")  # three stages read them; reducing copies is done once

    def same(left: str, right: str, *more: str) -> Column:
        on = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys] + [F.col(f"{left}.{c}") == F.col(f"{right}.{c}") for c in more]
        return reduce(Column.__and__, on)

    # the length of a book at each cut: only segments that another one follows are asked
    cuts = rows.select(*keys, "seg").distinct().withColumn("nxt", F.lead("seg").over(Window.partitionBy(*keys).orderBy("seg"))).where("nxt is not null")
    followed = rows.alias("r").join(cuts.alias("c"), same("r", "c", "seg")).select("r.*", "c.nxt")

    def lengths(_: tuple, c: Columns) -> dict:
        f = Lengths().replay(c["a"].tolist(), c["p"].tolist())
        return {"nxt": c["nxt"][:1], "base": [f.base], "cleared": [f.cleared], "flat": [np.asarray(f.flat, np.int64).tobytes()]}

    def starts(_: tuple, c: Columns) -> dict:
        at, out = 0, []
        for base, cleared, flat in zip(c["base"].tolist(), c["cleared"].tolist(), c["flat"]):
            at = Lengths(base, cleared, np.frombuffer(flat, np.int64)).after(at)
            out.append(at)
        n = len(out)
        return {"seg": c["nxt"], "seq": np.full(n, -1), "a": np.full(n, -1), "p": np.array(out, np.int64), "q": np.zeros(n, np.int64), "o": np.zeros(n, np.int64)}

    effects = _grouped(followed, [*keys, "seg"], ["seq"], lengths, f"{key_ddl}, seg bigint, nxt bigint, base bigint, cleared bigint, flat binary")
    markers = _grouped(effects, keys, ["seg"], starts, f"{key_ddl}, seg bigint, seq bigint, a bigint, p bigint, q bigint, o bigint")

    def replay(_: tuple, c: Columns) -> dict:
        """Images (mult ±1), then the book at the segment's end (mult 0 with its places), then one row that says the segment is there."""
        marked = int(c["a"][0]) == -1
        seqs, offers = c["seq"][marked:], c["o"][marked:]
        left, images, now = replay_segment(int(c["p"][0]) if marked else 0, c["a"][marked:].tolist(), c["p"][marked:].tolist(), c["q"][marked:].tolist())
        images += [(n, now.get(n, KEPT), 0, -1) for n in left]
        names, quantities, mult, change = (np.array(x, np.int64) for x in (zip(*images) if images else ((),) * 4))
        own = names >= 0
        mine = lambda x: np.where(own, x[np.where(own, names, 0)] if len(x) else 0, 0)
        place = np.concatenate([np.full(len(names) - len(left), -1), np.arange(len(left))])
        out = {"ref": np.where(own, -1, -1 - names), "s": mine(seqs), "o": mine(offers), "q": quantities, "mult": mult, "by": np.where(change >= 0, seqs[np.where(change >= 0, change, 0)] if len(seqs) else 0, -1), "place": place}
        return {k: np.append(v, -1 if k in ("ref", "by", "place") else 0) for k, v in out.items()}

    image_ddl = f"{key_ddl}, seg bigint, ref bigint, s bigint, o bigint, q bigint, mult bigint, by bigint, place bigint"
    replayed = stored(_grouped(rows.unionByName(markers), [*keys, "seg"], ["seq"], replay, image_ddl), "imagens")

    def compose(_: tuple, c: Columns) -> dict:
        """The book before each later segment (mult 2, ``ref`` its places) and the last one (mult 0, ``place``)."""
        now: Columns = {k: np.empty(0, np.int64) for k in ("s", "o", "q")}
        out: list[np.ndarray] = []
        cut = np.flatnonzero(np.diff(c["seg"])) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(c["seg"])]):
            if lo:
                n = len(now["s"])
                out.append(np.stack([np.full(n, c["seg"][lo]), np.arange(n), now["s"], now["o"], now["q"], np.full(n, 2), np.full(n, -1), np.full(n, -1)]))
            lo += 1  # the row without a place, which sorts first
            ref, own = c["ref"][lo:hi], {k: c[k][lo:hi] for k in now}
            old = ref >= 0
            before = {k: v[np.where(old, ref, 0)] if len(v) else np.zeros(len(ref), np.int64) for k, v in now.items()}
            now = {k: np.where(old if k != "q" else old & (own["q"] == KEPT), before[k], own[k]) for k in now}
        n = len(now["s"])
        out.append(np.stack([np.full(n, c["seg"][-1]), np.full(n, -1), now["s"], now["o"], now["q"], np.zeros(n, np.int64), np.full(n, -1), np.arange(n)]))
        return dict(zip(("seg", "ref", "s", "o", "q", "mult", "by", "place"), np.concatenate(out, axis=1)))

    books = _grouped(replayed.where("mult = 0"), keys, ["seg", "place"], compose, image_ddl)
    images = replayed.where("mult <> 0")
    resolved = images.where("ref >= 0").alias("i").join(books.where("mult = 2").alias("b"), same("i", "b", "seg", "ref"))
    resolved = resolved.select(*(F.col(f"i.{k}").alias(k) for k in keys), "i.seg", "i.ref", "b.s", "b.o", F.when(F.col("i.q") == KEPT, F.col("b.q")).otherwise(F.col("i.q")).alias("q"), "i.mult", "i.by", "i.place")
    signed = images.where("ref < 0").unionByName(resolved).unionByName(books.where("mult = 0"))
    known = lambda c, name: F.when(F.col(c) != NULL, F.col(c)).alias(name)
    return signed.select(*(F.col(k).alias(b) for b, k in zip(book, keys)), F.col("s").alias("oferta_seq"), known("o", "offer_id"), known("q", "quantidade"), "mult", F.when(F.col("by") >= 0, F.col("by")).alias("mudanca"), F.when(F.col("place") >= 0, F.col("place")).alias("place"))


def book_at_close(changes: DataFrame, day: Sequence[str], side: str = "side", seq: str = "seq", received: str = "ts_recv_ns", segment: int = SEGMENT) -> DataFrame:
    """The offers left in each ``day``'s book: copies reduced, positions resolved, images summed. Columns: the day's, ``side``, ``position``, ``offer_id``, ``quantidade``."""
    single = latest_copies(changes, [*day, seq], received, ["action", side, "position", "offer_id", "quantidade"])
    book = [*day, side]
    signed = positional_changes(single, book, seq, "action", "position", "quantidade", "offer_id", segment)
    left = merge_signed(None, signed, [*book, "oferta_seq", "offer_id", "quantidade"], carry=["place"])
    return left.select(*day, side, F.col("place").alias("position"), "offer_id", "quantidade")
