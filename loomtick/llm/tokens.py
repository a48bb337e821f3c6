"""Encoding a whole corpus with a public tokenizer, each shared chunk once."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed value: where the vocabulary lies, and the pre-token pattern that its ranks were made with
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A cut falls where the rolling hash of this many bytes is below the limit: once in ``MEAN`` bytes, never twice within ``LEAST``.
WINDOW, MEAN, LEAST = 48, 1024, 256

#: Documents and bytes that share one dictionary of chunks.
BLOCK_DOCS, BLOCK_BYTES = 2_000, 8 << 20

_TABLE = np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=4).digest() for b in range(256)), dtype=np.uint32).astype(np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=4)
def encoder(path: str = VOCABULARY, pattern: str = PATTERN):  # noqa: ANN201
    """The byte-level BPE of a rank file, without special tokens; kept for the life of a worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_bytes(utf8: bytes, path: str = VOCABULARY, pattern: str = PATTERN) -> np.ndarray:
    """Ids of a text; bytes that aren't UTF-8 count as U+FFFD."""
    return np.asarray(encoder(path, pattern).encode_to_numpy(utf8.decode("utf-8", "replace")), dtype=np.int32)


def hash_cuts(data: np.ndarray, mean: int = MEAN, window: int = WINDOW) -> np.ndarray:
    """Positions after which content asks for a cut: those where the rolling hash of the last ``window`` bytes is small."""
    if len(data) <= window:
        return np.empty(0, np.int64)
    total = np.cumsum(_TABLE[data])
    rolled = (total[window:] - total[:-window]) * _MIX
    return np.flatnonzero(rolled < np.uint64(2**64 // mean)) + window + 1


def agreed_bounds(data: np.ndarray) -> np.ndarray:
    """Positions where every tokenization of a text around them has a pre-token boundary: white space after a printable ASCII character.

    No pre-token of the pattern holds white space after anything else, a match that ends here looks no further, and a
    scan that starts here doesn't look back. So the ids of a text are those of its part before such a position followed
    by those of the part after it.
    """
    solid = (data > 32) & (data < 127)
    space = (data == 32) | (data == 10) | (data == 13) | (data == 9)
    return np.flatnonzero(solid[:-1] & space[1:]) + 1 if len(data) > 1 else np.empty(0, np.int64)


def split_document(length: int, cuts: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> list[tuple[int, int, bool]]:
    """A document as (start, end, is_join) pieces in order.

    Each cut opens a join: it starts as the cut itself and is widened on both sides until it meets positions on which all
    tokenizations agree (or the document's ends); joins that meet become one. What lies between joins are the chunks. So a
    chunk's ids are the same wherever it stands, and re-encoding the joins gives exactly the document's ids.
    """
    pieces: list[tuple[int, int, bool]] = []
    at, last = 0, -least
    joins: list[list[int]] = []
    for c in cuts.tolist():
        if c - last < least or c >= length:
            continue
        last = c
        k = int(np.searchsorted(bounds, c, "right"))
        lo = int(bounds[k - 1]) if k else 0
        hi = lo if lo == c else int(bounds[k]) if k < len(bounds) else length
        if joins and lo < joins[-1][1]:
            joins[-1][1] = max(joins[-1][1], hi)
        else:
            joins.append([lo, hi])
    for lo, hi in joins:
        if lo > at:
            pieces.append((at, lo, False))
        if hi > lo:
            pieces.append((lo, hi, True))
        at = hi
    if at < length:
        pieces.append((at, length, False))
    return pieces


def _utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, bytes and validity of a string column, without copies."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), column.is_valid().to_numpy(zero_copy_only=False)


# Rows of the stream between the stages: a chunk (``doc`` NULL: hash, body) or a document's plan (``doc`` set).
_STREAM = pa.schema([("block", pa.int64()), ("key", pa.binary()), ("plan", pa.bool_()), ("doc", pa.int64()), ("body", pa.binary()), ("joins", pa.binary())])
_STREAM_DDL = "block bigint, key binary, plan boolean, doc bigint, body binary, joins binary"
_DIGEST = 16


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _STREAM]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _STREAM.types)], schema=_STREAM)


def encode_corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = VOCABULARY, pattern: str = PATTERN, mean: int = MEAN) -> DataFrame:
    """``doc_id`` and ``ids`` of every row, equal to encoding its whole text; empty and NULL texts give an empty list.

    Content-defined chunk reuse in three stages. (1) Each block of documents is cut where a rolling hash of the content
    says so; joins between chunks are widened until both sides must agree and re-encoded there; each distinct chunk of
    the block leaves it once, with a 128-bit digest. (2) Chunks meet by digest and are encoded once for the corpus; the
    ids go back once per block. (3) The block's documents are put together from chunk and join ids.

    Rows with equal or NULL ids are kept as they are, one result each. Other columns are dropped, whatever their names.
    ``docs`` should be a stored table, so that a lost task finds the same blocks again.

    Scale: texts are shuffled once and ids once. A chunk that stands in a third of all documents is one row per block,
    so neither its encoding nor its way back grows with its copies. A text is held whole only by the task that reads it
    and the one that writes its ids.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = (TaskContext.get().partitionId() << 32) - 1
        for batch in batches:
            ids, (at, data, valid) = batch.column(0).to_pylist(), _utf8(batch.column(1))
            lo = 0
            while lo < len(ids):
                hi = min(max(int(np.searchsorted(at, at[lo] + BLOCK_BYTES)), lo + 1), lo + BLOCK_DOCS, len(ids))
                block += 1
                yield _emit(_block(block, ids, at, data, valid, lo, hi))
                lo = hi

    def _block(block: int, ids: list, at: np.ndarray, data: np.ndarray, valid: np.ndarray, lo: int, hi: int) -> list[tuple]:
        base = int(at[lo])
        own = data[base : int(at[hi])]
        cuts, bounds, rows, seen, glued = hash_cuts(own, mean), agreed_bounds(own), [], set(), {}
        raw = own.tobytes()
        starts = at[lo : hi + 1] - base
        cut_of, bound_of = np.searchsorted(cuts, starts + WINDOW, "right"), np.searchsorted(bounds, starts, "right")
        cut_to, bound_to = np.searchsorted(cuts, starts, "left"), np.searchsorted(bounds, starts, "left")
        for i in range(hi - lo):
            s, e = int(starts[i]), int(starts[i + 1])
            order, joins = [], []
            if e > s and valid[lo + i]:
                for a, b, is_join in split_document(e - s, cuts[cut_of[i] : cut_to[i + 1]] - s, bounds[bound_of[i] : bound_to[i + 1]] - s):
                    piece = raw[s + a : s + b]
                    if is_join:
                        got = glued.get(piece)
                        if got is None:
                            got = glued[piece] = encode_bytes(piece, path, pattern)
                        order.append(b"\0" * (_DIGEST - 4) + len(got).to_bytes(4, "little"))
                        joins.append(got.tobytes())
                        continue
                    key = hashlib.blake2b(piece, digest_size=_DIGEST, person=b"chunk").digest()
                    order.append(key)
                    if key not in seen:
                        seen.add(key)
                        rows.append((block, key, False, None, piece, None))
            rows.append((block, block.to_bytes(8, "little", signed=True), True, ids[lo + i], b"".join(order), b"".join(joins)))
        return rows

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids = None, b""
        for batch in batches:
            keys, plans, bodies = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(4)
            out = []
            for i, (key, plan) in enumerate(zip(keys, plans)):
                if plan:
                    out.append(bodies[i].as_py())
                    continue
                if key != last:
                    last, ids = key, _pack(encode_bytes(bodies[i].as_py(), path, pattern))
                out.append(ids)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.binary()), batch.column(5)], schema=_STREAM)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chunks = None, {}
        for batch in batches:
            blocks, keys, plans, docs_, bodies, joins = (c.to_pylist() for c in batch.columns)
            ids, lengths, parts = [], [], []
            for block, key, plan, doc, body, glue in zip(blocks, keys, plans, docs_, bodies, joins):
                if block != at:
                    at, chunks = block, {}
                if not plan:
                    chunks[key] = body
                    continue
                n, g = 0, 0
                for k in range(0, len(body), _DIGEST):
                    if body[k : k + _DIGEST - 4] == b"\0" * (_DIGEST - 4):
                        size = int.from_bytes(body[k + _DIGEST - 4 : k + _DIGEST], "little")
                        part = np.frombuffer(glue, np.int32, size, g)
                        g += 4 * size
                    else:
                        part = _unpack(chunks[body[k : k + _DIGEST]])
                    n += len(part)
                    parts.append(part)
                ids.append(doc)
                lengths.append(n)
            values = np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], names=["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, _STREAM_DDL)
    coded = rows.repartition("key").sortWithinPartitions("key").mapInArrow(encode, _STREAM_DDL)
    return coded.repartition("block").sortWithinPartitions("block", "plan").mapInArrow(join, "doc_id bigint, ids array<int>")


def _pack(ids: np.ndarray) -> bytes:
    """Two bytes an id where they suffice, with a mark at the end."""
    return ids.astype(np.uint16).tobytes() + b"\2" if not len(ids) or int(ids.max()) < 1 << 16 else ids.tobytes() + b"\4"


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint16 if packed[-1] == 2 else np.int32, (len(packed) - 1) // packed[-1])


def count_tokens(docs: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """The columns of ``keep`` with ``tokens`` and ``chars`` of the text; NULL and empty texts have 0. No shuffle."""
    kinds = dict(docs.dtypes)
    ddl = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", tokens bigint, chars bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path, pattern)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            tokens = [len(code.encode_to_numpy(t)) if t else 0 for t in texts]
            chars = [len(t) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(tokens, pa.int64()), pa.array(chars, pa.int64())], names=[*keep, "tokens", "chars"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(count, ddl)
