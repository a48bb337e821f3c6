"""Training-data operators against brute force, exact round trips and held-out labels."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomtick.llm import subjects as S
from loomtick.llm.mixing import CROWDED, keyed_documents, mix_report, mix_sources
from loomtick.llm.nearest import nearest_by_ticks
from loomtick.llm.percentiles import code_of, digests, merge_digests, percentiles, value_of
from loomtick.llm.tokens import agreed_bounds, encode_bytes, encode_corpus, encoder, hash_cuts, split_document

# ---- percentiles ----


def test_codes_are_ordered_and_exact_for_small_integers(spark):
    xs = [-1e308, -1.5, -1.0, -1e-300, 0.0, 1e-310, 1e-300, 0.1, 1.0, 2.0, 3.0, 1048575.0, 2097151.0, 85.12, 1.7976931348623157e308, float("inf")]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", code_of(F.col("x")).alias("c")).collect()
    rows.sort(key=lambda r: r.x)
    codes = [r.c for r in rows]
    assert codes == sorted(codes) and 0 <= codes[0] and codes[-1] < 1 << 32
    back = dict(zip([r.x for r in rows], value_of(np.array(codes))))
    for x in (0.0, 1.0, 2.0, 3.0, 1048575.0, 2097151.0, -1.0, -1.5):
        assert back[x] == x
    assert abs(back[85.12] / 85.12 - 1) < 1e-6
    assert spark.createDataFrame([(None,), (float("nan"),)], "x double").select(code_of(F.col("x")).alias("c")).where("c is not null").count() == 0


@pytest.mark.parametrize("error", [0.02, 0.002])
def test_rank_error_is_bounded_and_days_join(spark, error):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "a", "a", None]), f"d{i % 3}", rnd.choice([rnd.lognormvariate(0, 2), float(rnd.randrange(5)), -rnd.random() * 9]) if i % 11 else None, "x") for i in range(20_000)]
    df = spark.createDataFrame(rows, "g string, dt string, v double, medida string").repartition(6)
    days = digests(df, ["g", "dt"], {"v": F.col("v")}, error, fan_in=2)
    out = percentiles(merge_digests(days, ["g"], error), ["g"], {"p10": 0.1, "p50": 0.5, "p99": 0.99}).collect()
    assert len(out) == 2
    for r in out:
        xs = np.sort([v for g, _, v, _ in rows if g == r.g and v is not None])
        assert r.n == len(xs)
        for share, got in ((0.1, r.p10), (0.5, r.p50), (0.99, r.p99)):
            lo, hi = np.searchsorted(xs, got - abs(got) * 2e-6 - 1e-12), np.searchsorted(xs, got + abs(got) * 2e-6 + 1e-12, "right")
            assert lo - error * r.n - 1 <= share * r.n <= hi + error * r.n + 1


def test_digests_of_nothing(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert percentiles(digests(df, ["g"], {"v": F.col("v")}), ["g"], {"p": 0.5}).count() == 0


# ---- nearest ----


def test_nearest_equals_brute_force(spark):
    rnd = random.Random(5)
    left = [(rnd.choice(["A", "B", "C"]), rnd.randrange(3000), i) for i in range(150)] + [(None, 5, 900), ("A", None, 901)]
    right = [(rnd.choice(["A", "A", "B"]), rnd.randrange(3000), rnd.randrange(10_000)) for _ in range(150)] + [("A", None, 1), (None, 5, 2), ("A", 7, None)]
    right += right[:10]
    want = {}
    for e, t, i in left:
        best = [(abs(a - t), r) for x, a, r in right if e is not None and t is not None and x == e and a is not None and r is not None and abs(a - t) <= 40]
        if best:
            want[i] = min(best)
    lf = spark.createDataFrame([(*x, "c") for x in left], "entity string, at bigint, left_id bigint, tick string")
    rt = spark.createDataFrame([(*x, "c") for x in right], "entity string, at bigint, right_id bigint, cell string")
    for tick in (1, 7, 40, 100):
        got = {r.left_id: (abs(r.distance), r.right_id) for r in nearest_by_ticks(lf, rt, 40, tick).collect()}
        assert got == want
    assert nearest_by_ticks(lf.where("false"), rt, 40, 7).count() == 0 and nearest_by_ticks(lf, rt.where("false"), 40, 7).count() == 0


# ---- tokens ----


def joined(text, mean, least):
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    pieces = split_document(len(raw), hash_cuts(data, mean, 8), agreed_bounds(data), least)
    assert b"".join(raw[a:b] for a, b, _ in pieces) == raw
    return [x for a, b, _ in pieces for x in encode_bytes(raw[a:b]).tolist()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "Zu", "'", "'ll", " ", "  ", "\n", "\r\n", "\t", "12", "(){}", "_", "é", "日本", " ", " ", "\x1c", "😀", "﻿", "<|endoftext|>"]), max_size=60))
def test_any_cut_gives_the_whole_texts_ids(parts):
    text = "".join(parts)
    assert joined(text, 3, 2) == encoder().encode_ordinary(text)


def test_corpus_equals_direct_encoding(spark):
    rnd = random.Random(2)
    header = "/* licence text that stands everywhere, word after word */\n" * 40
    texts = [None, "", " ", "\n", "x" * 5000, "日本語" * 700, header, header] + [header + "".join(rnd.choice(["for ", "x+=1;\n", "'s ", "café ", "\t\t"]) for _ in range(rnd.randrange(900))) for _ in range(40)]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "null id", "x", 1), (3, "same id", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, key string, block int").repartition(3)
    got = sorted(((r.doc_id if r.doc_id is not None else -1, r.ids) for r in encode_corpus(df, mean=64).collect()))
    want = sorted(((i if i is not None else -1, encoder().encode_ordinary(t) if t else []) for i, t, _, _ in rows))
    assert got == want
    assert encode_corpus(df.where("false")).count() == 0


# ---- mixing ----


def test_mixture_reaches_targets_and_caps(spark):
    rows = [(i, s, 1 + i % 50, 0.2 + (i % 5) / 5, "c") for i, s in enumerate(["big"] * 3000 + ["mid"] * 400 + ["tiny"] * 5 + [None] * 50)] + [(7, "big", 8, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint, weight double, rest string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 4), ("tiny", 0.2, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    total = sum(r[2] for r in rows)
    for per_slice in (100_000, 37):
        mix = mix_sources(docs, targets, rows_per_slice=per_slice).collect()
        given = {s: sum(r.tokens * r.copies for r in mix if r.source == s) for s in ("big", "mid", "tiny")}
        assert 0.5 * total - 50 <= given["big"] <= 0.5 * total and 0.3 * total - 50 <= given["mid"] <= 0.3 * total
        assert given["tiny"] == 3 * sum(r[2] for r in rows if r[1] == "tiny")
        assert max(r.copies for r in mix if r.source == "mid") - min(r.copies for r in mix if r.source == "mid") <= 1
    rep = {r.source: r for r in mix_report(docs, targets).collect()}
    assert [s for s in sorted(rep) if rep[s].capped] == [s for s in sorted(rep) if rep[s].limited] == ["none", "tiny"] and rep["none"].given == 0
    assert sum(r.reached_share for r in rep.values()) == pytest.approx(1)
    assert mix_sources(docs.where("false"), targets).count() == 0


@pytest.mark.parametrize("weight", ["1.0", "0.8", "0.5", "0.05", "null", "case when doc_id % 3 = 0 then 0.05 else 1.0 end"])
def test_slices_of_a_source_are_even_whatever_the_weights(spark, weight):
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(1).cast("bigint").alias("tokens")).withColumn("weight", F.expr(weight).cast("double"))
    lk = keyed_documents(docs, 17)
    lo, hi = lk.agg(F.min("_lk"), F.max("_lk")).first()
    fullest = lk.groupBy(F.floor((F.col("_lk") - lo) / (hi - lo) * 1000)).count().agg(F.max("count")).first()[0]
    assert fullest <= CROWDED / 1000 * 200_000


def test_heavier_documents_are_drawn_more_often(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(10).cast("bigint").alias("tokens"), F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.25).alias("weight"))
    targets = spark.createDataFrame([("s", 0.25, 1)], "source string, target_share double, max_repeats int")
    got = [r.doc_id % 2 for r in mix_sources(docs, targets).collect()]
    assert len(got) == 1000 and 0.65 < 1 - sum(got) / len(got) < 0.85


# ---- subjects ----


@given(st.text(alphabet="aBcdam DAM_Dam1é", max_size=30))
@settings(max_examples=200, deadline=None)
def test_mentions_are_words(text):
    terms = {"dam": [0], "bc": [0]}
    want = S.words_of(text)
    assert S.mentions(text, S._automaton(terms), 2).tolist() == [want.count("dam"), want.count("bc")]


def test_subjects_on_held_out_documents(spark):
    rnd = random.Random(4)
    vocabulary = {"energy": [f"volt{c}" for c in "abcdefghij"], "law": [f"tort{c}" for c in "abcdefghij"], "music": [f"tune{c}" for c in "abcdefghij"]}
    rows, labels, truth = [], [], {}
    for i in range(900):
        areas = rnd.choice([[], ["energy"], ["law"], ["music"], ["law", "music"]])
        words = [rnd.choice(["value", "get", "record", "field", "x"]) for _ in range(30)] + [w for a in areas for w in rnd.sample(vocabulary[a], 4) * 2]
        rnd.shuffle(words)
        rows.append((i, rnd.choice(["_", " ", "\n"]).join(w if rnd.random() < 0.5 else w.title() for w in words), rnd.choice(["s", None]), "clash"))
        truth[i] = set(areas)
        if i < 600:
            for rater in ("r1", "r2"):
                labels += [(i, s.upper() if rnd.random() < 0.3 else s, rater) for s in ([rnd.choice(list(vocabulary))] if rnd.random() < 0.03 else areas or ["none"])]
    rows += [(5000, None, "s", None), (5001, "", "s", None)]
    labels += [(None, "law", "r1"), (1, None, "r1"), (2, "astrology", "r1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, subject string")
    labels = spark.createDataFrame(labels, "doc_id bigint, subject string, rater string")
    model = S.train(docs, labels, sorted(vocabulary), ["s"])
    assert {w for w, a in model.terms.items()} == {w for v in vocabulary.values() for w in v}
    got = {(r.doc_id, r.subject) for r in S.spoken_of(S.assign_subjects(docs, model)).collect() if r.doc_id >= 600}
    want = {(i, s) for i, t in truth.items() if i >= 600 for s in t}
    assert len(got & want) >= 0.98 * len(want) and len(got - want) <= 0.02 * len(want)
    empty = S.train(docs, labels.where("false"), sorted(vocabulary), [])
    assert S.assign_subjects(docs, empty).count() == 0


def test_few_labels_reach_a_whole_vocabulary(spark):
    rnd = random.Random(9)
    vocabulary = {a: [f"{a}{c}{c}{d}" for c in "bcdfg" for d in "klmnp"] for a in ("art", "sea", "ore", "sky", "zoo", "wax", "tin", "fog")}
    rows, truth = [], {}
    for i in range(800):
        areas = rnd.sample(list(vocabulary), rnd.choice([0, 1, 1, 2]))
        words = rnd.sample([f"common{c}" for c in "abcdefghijklmno"], 10) + [w for a in areas for w in rnd.sample(vocabulary[a], 6)] + [f"own{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}"]
        rows.append((i, " ".join(words), None))
        truth[i] = set(areas)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    given = [i for i in range(800) if truth[i]][:60] + [i for i in range(800) if not truth[i]][:20]
    labels = spark.createDataFrame([(i, s, "r") for i in given for s in truth[i] or {"none"}], "doc_id bigint, subject string, rater string")
    model = S.train(docs, labels, sorted(vocabulary), [])
    want = {w for v in vocabulary.values() for w in v}
    assert len(want & set(model.terms)) >= 0.97 * len(want) and len(set(model.terms) - want) <= 2
    known = labels.select("doc_id").collect()
    seen = set(" ".join(rows[r.doc_id][1] for r in known).split())
    assert want - seen and (want - seen) & set(model.terms)  # terms that no labelled document holds
    got = {(r.doc_id, r.subject) for r in S.assign_subjects(docs, model).collect()}
    assert len(got & {(i, s) for i, t in truth.items() for s in t}) >= 0.97 * sum(map(len, truth.values()))


def test_a_word_may_belong_to_two_areas():
    both = [(1, 30), (2, 28), (0, 2)]  # documents of area 0, of area 1, of neither
    assert sorted(S._areas_of(both, [100, 100], 1000, None)) == [0, 1]
    assert S._areas_of([(1, 30), (3, 20), (0, 2)], [100, 400], 1000, None) == [0]
    assert S._areas_of([(1, 30)], [100, 100], 1000, (10, [1, 9])) == []  # the labelled documents speak against it
    assert S._areas_of([(0, 50), (1, 4)], [100, 100], 1000, None) == []


def test_the_beam_follows_the_chain():
    rnd = np.random.default_rng(3)
    n = 4000
    first = rnd.random(n) < 0.5
    second = np.where(first, rnd.random(n) < 0.9, rnd.random(n) < 0.05)
    total = np.stack([np.where(first, 6, 0), np.full(n, 2)], axis=1)  # the second area's own terms say nothing
    own, y = S.own_features(np.minimum(total, 3), total), np.stack([first, second], axis=1).astype(float)
    shared = np.ones((n, 1))
    with_chain = S.fit_chain(S.Chain(["a", "b"]), own, shared, y)
    without = S.fit_chain(S.Chain(["a", "b"]), own, shared, y, chained=False)
    right = lambda m: (S.decode(m, own, shared, miss_cost=1.0)[0] == y.astype(bool)).all(axis=1).mean()
    assert right(with_chain) > 0.9 and right(without) < 0.7
