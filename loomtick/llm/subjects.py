"""Subject areas of documents: classifier chains over term, source and structure features."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: The label of a document without an area.
NONE = "none"

#: At most so many labelled documents are used to learn terms and fit the chain.
MAX_LABELLED = 20_000

#: A word may hint at an area if the share of labelled documents with it that have the area is at least HINT_SHARE and more
#: than the area's size gives by Z standard deviations.
HINT_SHARE, Z = 0.3, 4.0

#: A word is a term of an area if at least LEAST_DOCS documents of the corpus, SHARE of all with it, odds LIFT times those
#: that the area's size gives, and Z deviations more, hold OTHERS other hints of that area; a further area must explain REST of the documents
#: that the first one doesn't. Where VOICES labelled documents hold it, HINT_SHARE of them must have the area.
LEAST_DOCS, SHARE, LIFT, OTHERS, REST, VOICES = 3, 0.25, 3.0, 2, 0.5, 4

#: Shorter words are no terms: in keys, hashes and encoded data every pair of letters stands many times and hints at anything.
LEAST_LETTERS = 3

#: How many wrong areas one missed area outweighs when combinations are decoded.
MISS_COST = 4.0

_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def words_of(text: str) -> list[str]:
    """The words of names, comments and strings in lower case; identifiers are split at case changes and other characters."""
    return [w.lower() for w in _WORD.findall(text)]


@dataclass
class Chain:
    """A fitted chain: the terms and their areas, the weights of term features, per area (in chain order) the others, and the calibration."""

    areas: list[str] = field(default_factory=list)
    sources: list[str] = field(default_factory=list)
    terms: dict[str, list[int]] = field(default_factory=dict)
    order: list[int] = field(default_factory=list)
    common: np.ndarray | None = None
    weights: list[np.ndarray] = field(default_factory=list)
    calibration: tuple[float, float] = (1.0, 0.0)


# ---- features --------------------------------------------------------------------------------------------------------


def _automaton(terms: dict[str, list[int]]):  # noqa: ANN202
    import ahocorasick

    auto = ahocorasick.Automaton()
    for i, w in enumerate(terms):
        auto.add_word(w, (i, len(w)))
    auto.make_automaton()
    return auto


def _is_word(text: bytes, lo: int, hi: int) -> bool:
    """Whether ``text[lo:hi]`` (ASCII letters) is one of :func:`words_of` the text."""
    first, second = text[lo], text[lo + 1] if hi - lo > 1 else 0
    before, after = text[lo - 1] if lo else 0, text[hi] if hi < len(text) else 0
    lower, upper = (lambda c: 97 <= c <= 122), (lambda c: 65 <= c <= 90)
    body = text[lo + 1 : hi]
    if lower(second) or hi - lo == 1 and lower(first):
        if body != body.lower() or lower(after):
            return False
        return upper(first) or not (lower(before) or upper(before))
    return upper(first) and body == body.upper() and not (upper(before) or upper(after) or lower(after))


def mentions(text: str, auto, n_terms: int) -> np.ndarray:  # noqa: ANN001
    """How often each term stands in the text as a word. Whole text, one pass."""
    count = np.zeros(n_terms, np.int64)
    raw = text.encode("utf-8", "replace")
    for end, (i, size) in auto.iter(raw.lower().decode("latin-1")):
        if _is_word(raw, end - size + 1, end + 1):
            count[i] += 1
    return count


#: Steps at which the numbers of different terms and of mentions are laid out for the chain; which of them matter it learns.
_KINDS, _MENTIONS = (1, 2, 3, 4, 5, 6, 8), (1, 2, 3, 4, 5, 6, 8, 12, 20)


def own_features(kinds: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Term features of (document, area) pairs: how many different terms and mentions, in steps, and the mentions' logarithm."""
    steps = [kinds >= k for k in _KINDS] + [total >= m for m in _MENTIONS]
    return np.stack([*steps, np.log1p(total), np.ones(kinds.shape)], axis=-1).astype(np.float64)


def shared_features(model: Chain, texts: Sequence[str | None], sources: Sequence[str | None]) -> np.ndarray:
    """Source and structure features of documents, and a constant."""
    x = np.zeros((len(texts), len(model.sources) + 6))
    place = {s: i for i, s in enumerate(model.sources)}
    for i, (t, s) in enumerate(zip(texts, sources)):
        t = t or ""
        if s in place:
            x[i, place[s]] = 1
        lines, size = t.count("\n") + 1, len(t)
        x[i, -6:] = (1, math.log1p(size) / 10, math.log1p(size / lines) / 5, math.log1p(lines) / 7, (t.count("{") + t.count("(")) / (size + 1), (t.count("_") + t.count('"')) / (size + 1))
    return x


def counted(model: Chain, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By document and area: different terms, and all mentions."""
    member = np.zeros((len(model.terms), len(model.areas)), np.int64)
    for i, areas in enumerate(model.terms.values()):
        member[i, areas] = 1
    return (counts > 0).astype(np.int64) @ member, counts @ member


# ---- fitting ---------------------------------------------------------------------------------------------------------


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25, offset: np.ndarray | float = 0.0) -> np.ndarray:
    """Weights by Newton's method with a ridge; ``offset`` is added to the scores as it is."""
    w = np.zeros(x.shape[1])
    eye = ridge * np.eye(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ w + offset)
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + eye
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _weights(order: Sequence[int], own: np.ndarray, shared: np.ndarray, y: np.ndarray, chained: bool) -> tuple[np.ndarray, list[np.ndarray]]:
    """Term weights, which all areas share, so that small areas learn from large ones; then per area, in chain order, weights of
    source, structure and the earlier areas on top of them."""
    common = _logistic(own.reshape(-1, own.shape[-1]), y.reshape(-1), ridge=0.3)
    base = own @ common
    return common, [_logistic(np.hstack([shared, y[:, order[:k]] * chained]), y[:, a], ridge=5.0, offset=base[:, a]) for k, a in enumerate(order)]


def _scores(order: Sequence[int], common: np.ndarray, weights: Sequence[np.ndarray], own: np.ndarray, shared: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = own @ common
    for k, a in enumerate(order):
        out[:, a] += np.hstack([shared, y[:, order[:k]]]) @ weights[k]
    return out


def fit_chain(model: Chain, own: np.ndarray, shared: np.ndarray, y: np.ndarray, chained: bool = True) -> Chain:
    """The chain's weights from all documents, most frequent area first, and Platt scaling of scores that each third of the
    documents got from weights of the other two. ``chained`` false leaves the areas independent, for comparison."""
    model.order = [int(a) for a in np.argsort(-y.sum(axis=0), kind="stable")]
    fold, z = np.arange(len(y)) % 3, np.zeros(y.shape)
    for f in range(3):
        rest, held = fold != f, fold == f
        if rest.any() and held.any():
            z[held] = _scores(model.order, *_weights(model.order, own[rest], shared[rest], y[rest], chained), own[held], shared[held], y[held])
    slope, shift = _logistic(np.stack([z.reshape(-1), np.ones(z.size)], axis=1), y.reshape(-1), ridge=0.1)
    model.calibration = (float(max(slope, 0.05)), float(shift))
    model.common, model.weights = _weights(model.order, own, shared, y, chained)
    return model


def decode(model: Chain, own: np.ndarray, shared: np.ndarray, width: int = 6, miss_cost: float = MISS_COST) -> tuple[np.ndarray, np.ndarray]:
    """Beam search over label combinations: per document the one of least expected cost, a missed area costing ``miss_cost``
    times a wrong one, and each area's probability along it."""
    n, k = len(own), len(model.areas)
    beam, cost, prob = np.zeros((n, 1, k)), np.zeros((n, 1)), np.zeros((n, 1, k))
    slope, shift = model.calibration
    base, gain = own @ model.common, math.log(miss_cost)
    for step, a in enumerate(model.order):
        w = model.weights[step]
        z = (base[:, a] + shared @ w[: shared.shape[1]])[:, None] + beam[:, :, model.order[:step]] @ w[shared.shape[1] :]
        p = np.clip(_sigmoid(slope * z + shift), 1e-9, 1 - 1e-9)
        both = np.concatenate([cost + np.log(1 - p), cost + np.log(p) + gain], axis=1)
        yes, seen = beam.copy(), prob.copy()
        yes[:, :, a], seen[:, :, a] = 1, p
        states, probs = np.concatenate([beam, yes], axis=1), np.concatenate([seen, seen], axis=1)
        keep = np.argsort(-both, axis=1, kind="stable")[:, :width]
        cost, beam, prob = np.take_along_axis(both, keep, 1), np.take_along_axis(states, keep[:, :, None], 1), np.take_along_axis(probs, keep[:, :, None], 1)
    return beam[:, 0, :].astype(bool), prob[:, 0, :]


# ---- terms -----------------------------------------------------------------------------------------------------------


def _by_area(areas: Sequence[str]) -> list[Column]:
    """Per area the documents counted in rows (``mask``: areas as bits, ``n``: documents)."""
    return [F.sum(F.when(F.col("mask").bitwiseAND(1 << a) != 0, F.col("n")).otherwise(0)).alias(f"x{a}") for a in range(len(areas))]


def _deviations(x: Column, m: Column, base: float) -> Column:
    return (x - m * base) / F.sqrt(m * (base * (1 - base)) + 1e-9)


def _word_counts(docs: DataFrame, mask_of: Callable[[int, set[str]], Iterator[tuple[str, int]]]) -> DataFrame:
    """``word``, ``mask``, ``n``: in how many documents a word stands while ``mask_of`` gives that mask; the word "" counts documents.

    Whole texts, one pass; counts are summed per task before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        frame = lambda: pd.DataFrame([(w, m, n) for (w, m), n in found.items()], columns=["word", "mask", "n"])
        for pdf in batches:
            for i, t in zip(pdf.doc_id.tolist(), pdf.text.tolist()):
                found.update(mask_of(i, {w for w in words_of(t) if len(w) >= LEAST_LETTERS}))
            if len(found) > 500_000:
                yield frame()
                found.clear()
        yield frame()

    counts = docs.select("doc_id", "text").where("text is not null").mapInPandas(run, "word string, mask bigint, n bigint")
    return stored(counts.groupBy("word", "mask").agg(F.sum("n").alias("n")), "palavras")


def learn_terms(docs: DataFrame, chosen: DataFrame, given: dict[int, int], areas: Sequence[str]) -> dict[str, list[int]]:
    """The terms of each area: word → areas.

    Labelled documents (``chosen``, their areas as bits in ``given``) name hints: words that are far more frequent with an
    area than without it, be it in a single document. The whole corpus decides: a word is a term where the documents that
    hold it hold other hints of the area too. So an area of five labelled documents gets its whole vocabulary, and chance
    words of those five get nothing. A word belongs to the area it says most about, and to further ones that explain the
    documents which the first one doesn't. What comes to the driver is vocabulary, bounded by the labelled sample and by
    the words that pass; everything else stays in tables.
    """
    if len(areas) > 62:
        raise ValueError("areas are counted as bits of one integer")
    labelled = _word_counts(chosen, lambda i, words: [(w, given[i]) for w in words] + [("", given[i])])
    n_labelled = [0] * len(areas)
    for r in labelled.where("word = ''").collect():
        for a in range(len(areas)):
            n_labelled[a] += r.n * (r["mask"] >> a & 1)
    every = sum(r.n for r in labelled.where("word = ''").collect())
    spelt = labelled.where("word <> ''").groupBy("word").agg(F.sum("n").alias("m"), *_by_area(areas))
    x = lambda a: F.col(f"x{a}")
    hint = lambda a: (x(a) > 0) & (x(a) >= HINT_SHARE * F.col("m")) & (_deviations(x(a), F.col("m"), n_labelled[a] / every) >= Z) & F.lit(n_labelled[a] < every)
    bits = sum((F.when(hint(a), F.lit(1 << a)).otherwise(0) for a in range(len(areas))), F.lit(0))
    hints = {r.word: r.hints for r in spelt.select("word", bits.cast("bigint").alias("hints")).where("hints <> 0").collect()}
    if not hints:
        return {}

    def mask_of(_: int, words: set[str]) -> Iterator[tuple[str, int]]:
        many = Counter()
        mine = [(w, hints[w]) for w in words if w in hints]
        for _, h in mine:
            many.update(a for a in range(len(areas)) if h >> a & 1)
        over = lambda least: sum(1 << a for a, n in many.items() if n >= least)
        others, itself = over(OTHERS), over(OTHERS + 1)
        yield "", others
        for w in words:
            h = hints.get(w, 0)
            yield w, others & ~h | itself & h  # a hint needs OTHERS beside itself

    corpus = _word_counts(docs, mask_of)
    of_all = corpus.where("word = ''").collect()
    n_docs = sum(r.n for r in of_all)
    sizes = [sum(r.n for r in of_all if r["mask"] >> a & 1) for a in range(len(areas))]
    m = F.col("m")
    passes = lambda a: (x(a) >= LEAST_DOCS) & (x(a) >= SHARE * m) & (x(a) * (n_docs - sizes[a]) >= LIFT * (m - x(a)) * sizes[a]) & (_deviations(x(a), m, sizes[a] / n_docs) >= Z)
    some = reduce(Column.__or__, (passes(a) for a in range(len(areas))))
    survivors = corpus.where("word <> ''").groupBy("word").agg(F.sum("n").alias("m"), *_by_area(areas)).where(some).select("word")
    voices = spelt.join(survivors, "word", "left_semi").collect()
    heard = {r.word: (r.m, [r[f"x{a}"] for a in range(len(areas))]) for r in voices}
    masks: dict[str, list[tuple[int, int]]] = {}
    for r in corpus.join(survivors, "word", "left_semi").collect():
        masks.setdefault(r.word, []).append((r["mask"], r.n))
    terms = {w: _areas_of(v, sizes, n_docs, heard.get(w)) for w, v in sorted(masks.items())}
    return {w: a for w, a in terms.items() if a}


def _areas_of(masks: list[tuple[int, int]], sizes: Sequence[int], n_docs: int, heard: tuple[int, list[int]] | None) -> list[int]:
    """The areas a word is a term of, from the number of its documents by areas hinted at beside it."""
    m = sum(n for _, n in masks)
    x = [sum(n for mask, n in masks if mask >> a & 1) for a in range(len(sizes))]
    far = lambda a: (x[a] - m * sizes[a] / n_docs) / math.sqrt(m * sizes[a] / n_docs * (1 - sizes[a] / n_docs) + 1e-9)
    likely = [a for a in range(len(sizes)) if x[a] >= LEAST_DOCS and x[a] * (n_docs - sizes[a]) >= LIFT * (m - x[a]) * sizes[a] and far(a) >= Z]
    if not likely:
        return []
    best = max(likely, key=lambda a: (far(a), -a))
    spoken = heard is None or heard[0] < VOICES or heard[1][best] >= HINT_SHARE * heard[0]
    if x[best] < SHARE * m or not spoken:
        return []
    rest = m - x[best]
    alone = lambda a: sum(n for mask, n in masks if mask >> a & 1 and not mask >> best & 1)
    return [best, *(a for a in likely if a != best and rest >= LEAST_DOCS and alone(a) >= max(LEAST_DOCS, REST * rest))]


# ---- training and use ------------------------------------------------------------------------------------------------


def voted_areas(labels: DataFrame, areas: Sequence[str], max_labelled: int = MAX_LABELLED) -> dict[int, int]:
    """Areas as bits of at most ``max_labelled`` labelled documents (a hash of the id picks them): those that at least half of the raters give."""
    known = labels.select("doc_id", F.lower(F.trim("subject")).alias("subject"), "rater").where(F.col("doc_id").isNotNull() & F.col("subject").isin(NONE, *areas)).distinct()
    voted = known.groupBy("doc_id").agg(F.collect_list("subject").alias("subjects"), F.count_distinct("rater").alias("raters"))
    sample = voted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).collect()
    return {r.doc_id: sum(1 << areas.index(s) for s, n in Counter(r.subjects).items() if s != NONE and 2 * n >= max(r.raters, 1)) for r in sample}


def train(docs: DataFrame, labels: DataFrame, areas: Sequence[str], sources: Sequence[str], max_labelled: int = MAX_LABELLED) -> Chain:
    """Learns the areas' terms and fits the chain on at most ``max_labelled`` labelled documents.

    ``docs``: ``doc_id``, ``text``, ``source``; ``labels``: ``doc_id``, ``subject``, ``rater``. Labels of unknown areas, of NULL
    documents or subjects are ignored; without usable labels the chain is empty and assigns nothing. Terms come from
    counts over all documents (:func:`learn_terms`).
    """
    model = Chain(list(areas), list(sources))
    given = voted_areas(labels, model.areas, max_labelled)
    if not given:
        return model
    ids = docs.sparkSession.createDataFrame([(i,) for i in given], "doc_id bigint")
    chosen = docs.select("doc_id", "text", "source").where("text is not null").join(F.broadcast(ids), "doc_id")  # bounded by max_labelled
    model.terms = learn_terms(docs, chosen, given, model.areas)
    if not model.terms:
        return model
    return fit_chain(model, *labelled_features(model, chosen, given))


def labelled_features(model: Chain, chosen: DataFrame, given: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The labelled documents' term features, shared features and areas, in the order of their ids."""
    ddl = "doc_id bigint, kinds array<bigint>, total array<bigint>, shared array<double>"
    rows = sorted(chosen.mapInPandas(lambda batches: _read(model, batches), ddl).collect(), key=lambda r: r.doc_id)
    own = own_features(np.array([r.kinds for r in rows]), np.array([r.total for r in rows]))
    y = np.array([[given[r.doc_id] >> a & 1 for a in range(len(model.areas))] for r in rows], np.float64)
    return own, np.array([r.shared for r in rows]), y


def _read(model: Chain, batches: Iterator[pd.DataFrame], every: bool = True) -> Iterator[pd.DataFrame]:
    """Terms, mentions and shared features of documents; with ``every`` false only of those with a term."""
    auto = _automaton(model.terms)
    for pdf in batches:
        if pdf.empty:
            continue
        texts = pdf.text.tolist()
        counts = np.stack([mentions(t, auto, len(model.terms)) if t else np.zeros(len(model.terms), np.int64) for t in texts])
        keep = np.flatnonzero(counts.any(axis=1) | every)
        if len(keep):
            kinds, total = counted(model, counts[keep])
            shared = shared_features(model, [texts[i] for i in keep], pdf.source.iloc[keep].tolist())
            yield pd.DataFrame({"doc_id": pdf.doc_id.to_numpy()[keep], "kinds": list(kinds), "total": list(total), "shared": list(shared)})


def assign_subjects(docs: DataFrame, model: Chain, width: int = 6, miss_cost: float = MISS_COST) -> DataFrame:
    """``doc_id``, ``subject``, ``prob``, ``terms``, ``mentions``: the areas of each document's decoded label combination.

    ``docs``: ``doc_id``, ``text``, ``source``; whole texts are read, each once. NULL and empty texts, and texts without
    any term, get no row; a NULL source has no source feature; repeated rows give repeated results; other columns are
    ignored. No shuffle: the model, bounded by its vocabulary, goes to every task.
    """
    ddl = "doc_id bigint, subject string, prob double, terms bigint, mentions bigint"
    if not model.weights:
        return docs.sparkSession.createDataFrame([], ddl)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _read(model, batches, every=False):
            kinds, total = np.stack(pdf.kinds), np.stack(pdf.total)
            best, prob = decode(model, own_features(kinds, total), np.stack(pdf.shared), width, miss_cost)
            i, a = np.nonzero(best)
            yield pd.DataFrame({"doc_id": pdf.doc_id.to_numpy()[i], "subject": np.array(model.areas, object)[a], "prob": prob[i, a], "terms": kinds[i, a], "mentions": total[i, a]})

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "source").mapInPandas(run, ddl)


def spoken_of(assigned: DataFrame, terms: int = 3, times: int = 5) -> DataFrame:
    """The exact check: decoded areas of which the text has at least ``terms`` different terms and ``times`` mentions."""
    return assigned.where((F.col("terms") >= terms) & (F.col("mentions") >= times))
