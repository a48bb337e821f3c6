"""Small tests of the core problems: nulls, ties, repeated rows, empty tables, clashing columns, brute force."""

import random

import pytest
from pyspark.sql import functions as F

from loomtick.operators.changes import Lengths, apply_changes, book_at_close, merge_signed, positional_changes, replay_segment
from loomtick.operators.dedupe import DeliveryStore
from loomtick.operators.grid import missing_cells, regular_grid
from loomtick.operators.late import LateAggregates, arrival_partials, first_received, merge_partials
from loomtick.session import work_folder
from loomtick.streaming.compactor import StreamingCompactor

READINGS = "s string, at bigint, v double, q bigint, cell string, n string"


def grid(spark, rows, **kw):
    df = spark.createDataFrame(rows, READINGS)
    return {(r.s, r.cell): r for r in regular_grid(df, ["s"], "at", 10, ["v"], ["q"], **kw).collect()}


def test_grid_interpolates_between_neighbours(spark):
    g = grid(spark, [("a", 5, 1.0, 2, "x", "y"), ("a", 45, 5.0, 3, None, None), ("a", None, 9.0, 1, None, None)])
    assert sorted(k for _, k in g) == [0, 1, 2, 3, 4]
    assert [g["a", k].n for k in range(5)] == [1, 0, 0, 0, 1]
    assert [g["a", k].v_grid for k in range(1, 5)] == [1.5, 2.5, 3.5, 4.5]
    assert g["a", 0].v_grid is None and g["a", 0].v_last == 1.0 and g["a", 4].q_sum == 3 and g["a", 2].q_sum is None
    assert [g["a", k].state for k in range(5)] == ["observado", *["interpolado"] * 3, "observado"]


def test_grid_gap_limit_exact_points_ties_and_nulls(spark):
    rows = [(None, 0, 1.0, 1, None, None), (None, 0, 2.0, 1, None, None), (None, 0, 2.0, 1, None, None), (None, 25, None, None, None, None), (None, 60, 7.0, 1, None, None)]
    g = grid(spark, rows, gap_limit=50)
    assert g[None, 0].n == 3 and g[None, 0].v_last == 2.0 and g[None, 0].v_grid == 1.0
    assert g[None, 2].n == 1 and g[None, 2].v_last is None and g[None, 2].q_sum is None
    assert g[None, 1].state == "lacuna" and g[None, 1].v_grid is None and g[None, 6].v_grid == 7.0
    assert grid(spark, []) == {}


def test_missing_cells_follow_from_the_neighbours(spark):
    df = spark.createDataFrame([("a", 9, 1.0, 1, None, None), ("a", 10, 1.0, 1, None, None), ("a", 49, None, 1, None, None), (None, 0, 1.0, 1, None, None)], READINGS)
    out = regular_grid(df, ["s"], "at", 10, ["v"], ["q"])
    assert sorted((r.cell, r.anterior, r.seguinte) for r in missing_cells(out, 10).collect()) == [(2, 10, 49), (3, 10, 49)]
    plan = missing_cells(out, 10).select("s", "cell")._jdf.queryExecution().optimizedPlan().toString()
    assert "last(_l" in plan and "first(_f" in plan  # the as-of pair decides, nothing else


def brute_book(changes):
    books = {}
    for side, action, position, offer, quantity in changes:
        b = books.setdefault(side, [])
        if action is None or position is None:
            continue
        if action == 0:
            b.insert(position, [offer, quantity])
        elif action == 1 and position < len(b):
            b[position][1] = quantity
        elif action == 2 and position < len(b):
            del b[position]
        elif action == 3:
            del b[: position + 1]
    return {(s, i, o, q) for s, b in books.items() for i, (o, q) in enumerate(b)}


CHANGES = "symbol string, dt string, seq bigint, ts_recv_ns bigint, action bigint, side bigint, position bigint, offer_id bigint, quantidade bigint, k0 string, place string"


@pytest.mark.parametrize("segment", [4, 7, 1000])
def test_book_equals_replay_for_any_segment(spark, segment):
    rnd = random.Random(segment)
    want, rows = {}, []
    for symbol in ("A", "B"):
        changes = [(rnd.choice([0, 0, 1]), rnd.choice([0, 0, 0, 1, 2, 2, 3, 4, None]), rnd.choice([0, 0, 1, 2, 3, 9, None]), rnd.choice([None, 0, 7, 8]), rnd.choice([1, 2, 3, None])) for _ in range(60)]
        want[symbol] = brute_book(changes)
        for i, (side, action, position, offer, quantity) in enumerate(changes, 1):
            rows.append((symbol, "2018-01-08", i, 100, action, side, position, offer, quantity, "x", "y"))
            rows.append((symbol, "2018-01-08", i, 50, 2, side, 0, None, None, None, None))  # an older, differing copy
            rows.append(rows[-2])  # a repeated row
    rnd.shuffle(rows)
    out = book_at_close(spark.createDataFrame(rows, CHANGES), ["symbol", "dt"], segment=segment).collect()
    for symbol in want:
        got = [(r.side, r.position, r.offer_id, r.quantidade) for r in out if r.symbol == symbol]
        assert set(got) == want[symbol] and len(got) == len(want[symbol])


def test_book_of_nothing(spark):
    assert book_at_close(spark.createDataFrame([], CHANGES), ["symbol", "dt"]).count() == 0


def test_lengths_compose():
    rnd = random.Random(3)
    for _ in range(200):
        ops = [(rnd.choice([0, 1, 2, 3]), rnd.randrange(6)) for _ in range(rnd.randrange(25))]
        f = Lengths().replay([a for a, _ in ops], [p for _, p in ops])
        for before in range(12):
            book, _, _ = replay_segment(before, [a for a, _ in ops], [p for _, p in ops], [0] * len(ops))
            assert f.after(before) == len(book)


def test_removal_far_beyond_the_book_is_one_step():
    f = Lengths().replay([0, 3, 0, 2], [0, 2**31 - 1, 0, 5])
    assert (f.base, f.cleared, len(f.flat)) == (1, 2**31 - 1, 1)
    assert [f.after(n) for n in (0, 9, 2**31 - 1, 2**31 + 9)] == [1, 1, 1, 10]
    assert replay_segment(3, [3, 0], [2**31 - 1, 0], [0, 5])[0] == [1]


@pytest.mark.parametrize("segment", [2, 1000])
def test_every_effective_change_gives_its_images(spark, segment):
    rows = [("A", 1, 0, 0, 7, 5), ("A", 2, 0, 0, 8, 6), ("A", 3, 1, 1, None, 9), ("A", 4, 1, 7, None, 1), ("A", 5, 2, 0, None, None), ("A", 6, 2, 5, None, None), ("A", 7, 0, 2**31 - 1, 9, 4), ("A", 8, 4, 0, 1, 1), ("A", 9, 3, 2**31 - 1, None, None), (None, 1, 0, 0, 1, None)]
    df = spark.createDataFrame(rows, "symbol string, seq bigint, action bigint, position bigint, offer_id bigint, quantidade bigint")
    got = positional_changes(df, ["symbol"], "seq", "action", "position", "quantidade", "offer_id", segment).where("mult <> 0").collect()
    got = sorted((str(r.symbol), r.oferta_seq, r.offer_id, r.quantidade, r.mult) for r in got)
    want = [("A", 1, 7, 5, 1), ("A", 1, 7, 5, -1), ("A", 1, 7, 9, 1), ("A", 1, 7, 9, -1), ("A", 2, 8, 6, 1), ("A", 2, 8, 6, -1), ("A", 7, 9, 4, 1), ("A", 7, 9, 4, -1), ("None", 1, 1, None, 1)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_the_query_sums_before_images(spark, data):
    from loomtick.operators.changes import latest_copies
    from loomtick.sources.tables import table

    changes = table(spark, data, "book_offer", "ts_recv_ns", "symbol", "seq", "action", "side", "position", "offer_id", "quantidade", "dt")
    single = latest_copies(changes, ["symbol", "dt", "seq"], "ts_recv_ns", ["action", "side", "position", "offer_id", "quantidade"])
    mult = {r.mult: r["count"] for r in positional_changes(single, ["symbol", "dt", "side"], "seq", "action", "position", "quantidade", "offer_id").groupBy("mult").count().collect()}
    assert mult[-1] > mult[0] > 0 and mult[1] - mult[-1] == mult[0]  # what stays is what came less what went


def test_keyed_changes(spark):
    image = "struct<k: bigint, v: string>"
    df = spark.createDataFrame(
        [(1, 5, None, (1, "a")), (1, 5, None, (1, "a")), (3, 1, (1, "b"), None), (2, 1, (1, "a"), (1, "b")), (4, 1, None, (2, None)), (5, 1, None, None), (6, 1, (9, "z"), (9, "y"))],
        f"id bigint, r bigint, before {image}, after {image}",
    )
    base = spark.createDataFrame([(9, "z"), (9, "z")], "k bigint, v string")
    got = sorted((r.k, r.v, r.mult) for r in apply_changes(base, df, ["id"], "r", "before", "after", ["k", "v"]).collect())
    assert got == [(2, None, 1), (9, "y", 1), (9, "z", 1)]
    assert merge_signed(None, spark.createDataFrame([], "k bigint, mult bigint"), ["k"]).count() == 0


MESSAGES = "symbol string, dt string, trade_id bigint, ts_recv_ns bigint, price double, copias string, casa string"


def test_deliveries_keep_one_copy_across_batches_and_retries(spark):
    df = lambda rows: spark.createDataFrame(rows, MESSAGES)
    first = df([("A", "d1", 1, 10, 1.0, "x", None), ("A", "d1", 1, 10, 1.0, None, None), ("A", "d1", 2, 5, None, None, None), (None, "d1", 3, 1, 1.0, None, None), ("B", "d2", 1, 7, 2.0, None, None)])
    late = df([("A", "d1", 1, 30, 3.0, None, None), ("A", "d1", 9, 1, 9.0, None, None)])
    store = DeliveryStore(spark, work_folder(spark, "t"), first.schema, ["symbol", "dt", "trade_id"], "dt", ["ts_recv_ns"], ["price"], rows_per_slice=2)
    assert store.merge("0", first) == 0
    before = store.data.manifest()["parts"]
    assert store.merge("1", late) == 1  # only the partition that holds trade 1 of A
    assert store.merge("1", late) == 0 and store.merge("2", df([])) == 0
    after = store.data.manifest()["parts"]
    assert sum(before[p] != after[p] for p in before) == 1
    got = sorted((r.symbol, r.dt, r.trade_id, r.ts_recv_ns, r.price, r.copias) for r in store.read().collect())
    assert got == [("A", "d1", 1, 30, 3.0, 3), ("A", "d1", 2, 5, None, 1), ("A", "d1", 9, 1, 9.0, 1), ("B", "d2", 1, 7, 2.0, 1)]


@pytest.mark.parametrize("ids", [("in_0", "in_1", "in_2"), ("a/b", "a:b", "a b"), ("", "0_x_1", "lote=0")])
def test_deliveries_of_any_names(spark, ids):
    days = ["d_1", "x:1", "p/q", "", " ", "d1%", "__HIVE_DEFAULT_PARTITION__"]
    df = lambda rows: spark.createDataFrame(rows, MESSAGES)
    root = work_folder(spark, "t")
    new = lambda: DeliveryStore(spark, root, df([]).schema, ["symbol", "dt", "trade_id"], "dt", ["ts_recv_ns"], ["price"], rows_per_slice=3)
    for k, batch in enumerate(ids):  # every message comes again in every batch; one is new
        rows = [("A", day, i, 100 + k, float(k), None, None) for day in days for i in range(8 + k)]
        hit = new().merge(batch, df(rows))
        assert (hit > 0) == (k > 0)
        assert new().merge(batch, df(rows)) == 0
    got = {(r.dt, r.trade_id): (r.ts_recv_ns, r.price, r.copias) for r in new().read().collect()}
    assert new().read().count() == len(got) == 10 * len(days)
    assert all(got[day, i] == (102, 2.0, 3 if i < 8 else 2 if i == 8 else 1) for day in days for i in range(10))
    before = new().read().count()
    assert new().data.vacuum() > 0 and new().data.vacuum() == 0 and new().read().count() == before


def test_a_delivery_that_stopped_half_way_is_completed(spark, monkeypatch):
    df = lambda rows: spark.createDataFrame(rows, MESSAGES)
    root = work_folder(spark, "t")
    new = lambda: DeliveryStore(spark, root, df([]).schema, ["symbol", "dt", "trade_id"], "dt", ["ts_recv_ns"], ["price"])
    store = new()
    monkeypatch.setattr(store.index, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.merge("0", df([("A", "d", 1, 1, 1.0, None, None)]))
    new().merge("0", df([("A", "d", 1, 1, 1.0, None, None)]))
    assert new().merge("1", df([("A", "d", 1, 2, 2.0, None, None)])) == 1
    assert [(r.price, r.copias) for r in new().read().collect()] == [(2.0, 2)]


def test_the_query_overwrites_historical_partitions(spark, data):
    from loomtick.plans.core_problems import DELIVERIES, delivered

    store = delivered(spark, data)
    assert len(store.overwritten) == DELIVERIES and store.overwritten[0] == 0 and sum(store.overwritten) > 0  # at scales 0.01 and 0.1: [0, 2, 4] and [0, 5, 10]


def test_late_rows_correct_until_the_cut_off(spark):
    rows = [("A", 1, 5, 8), ("A", 1, 5, 90), ("A", 2, 7, 25), ("A", 3, 8, 200), ("A", None, 8, 11), ("A", 0, 9, None), ("A", 4, None, 3)]
    df = spark.createDataFrame(rows, "s string, id bigint, e bigint, r bigint").withColumn("janela", F.lit("clash"))
    single = first_received(df, ["s", "id"], "r", ["e"], F.col("id") > 0)
    assert single.count() == 6
    parts = arrival_partials(single, ["s"], "e", "r", 10, 10, 100, {"soma": F.col("e")}, 50)
    got = merge_partials(parts, ["s"], ["soma"]).collect()
    assert [(r.janela, r.n, r.n_corrigida, r.n_cortada, r.soma) for r in got] == [(0, 4, 1, 1, 29)]
    assert merge_partials(arrival_partials(single.where("false"), ["s"], "e", "r", 10, 10, 100, {}, 50), ["s"], []).count() == 0


LATE = "s string, d string, id bigint, e bigint, r bigint, q bigint, janela string, n string"


def test_late_batches_in_any_order_equal_one_pass(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("AB"), rnd.choice(["d_1", "", None]), rnd.choice([None, 0, *range(12)]), rnd.choice([None, *range(40)]), rnd.choice([None, *range(300)]), rnd.choice([None, 1, 2, 3]), "x", "y") for _ in range(300)]
    cut = [rows[:100], rows[100:250], [], rows[250:]]
    df = lambda r: spark.createDataFrame(r, LATE)
    single = first_received(df(rows), ["s", "d", "id"], "r", ["e", "q"], F.col("id") > 0)
    parts = arrival_partials(single, ["s"], "e", "r", 10, 10, 100, {"q": F.col("q")}, 50)
    want = {(r.s, r.janela): (r.n, r.n_corrigida, r.n_cortada, r.q or 0) for r in merge_partials(parts, ["s"], ["q"]).collect()}
    store = lambda root: LateAggregates(spark, root, df([]).schema, ["s"], ["s", "d", "id"], "d", "e", "r", 10, 10, 100, ["q"])
    for order in ((0, 1, 2, 3), (3, 2, 1, 0)):
        root = work_folder(spark, "t")
        for k in order:
            store(root).merge(f"b/{k}", df(cut[k]), F.col("id") > 0)
            store(root).merge(f"b/{k}", df(cut[k]), F.col("id") > 0)
        got = {(r.s, r.janela): (r.n, r.n_corrigida, r.n_cortada, r.q or 0) for r in store(root).read().collect()}
        assert {k: v for k, v in got.items() if any(v)} == want


def test_a_second_arrival_batch_reads_no_old_rows(spark):
    import shutil

    root, raw = work_folder(spark, "t"), work_folder(spark, "t")
    spark.createDataFrame([("A", "d", 1, 5, 8, 2, None, None), ("A", "d", 2, 6, 9, 3, None, None)], LATE).write.parquet(raw)
    store = LateAggregates(spark, root, spark.read.parquet(raw).schema, ["s"], ["s", "d", "id"], "d", "e", "r", 10, 10, 100, ["q"])
    store.merge("0", spark.read.parquet(raw), F.col("id") > 0)
    shutil.rmtree(raw.removeprefix("file://"))  # gone, and not missed
    late = [("A", "d", 1, 5, 60, 2, None, None), ("A", "d", 3, 7, 50, 4, None, None), ("A", "d", 4, 7, 500, 9, None, None), ("A", "d", 2, 6, 7, 8, None, None)]
    store.merge("1", spark.createDataFrame(late, LATE), F.col("id") > 0)
    assert [(r.n, r.n_corrigida, r.n_cortada, r.q, r.lotes) for r in store.read().collect()] == [(3, 1, 1, 14, 2)]


def test_compactor_merges_each_row_once_and_goes_on(spark):
    root = work_folder(spark, "t")
    listing = f"{root}/listing"
    rows = spark.createDataFrame([("A", "d", f, i, "c") for f, n in ((1, 3), (2, 2), (3, 1), (4, 5), (5, 50), (6, 2)) for i in range(n)] + [("A", "d", None, 0, "c")], "symbol string, dt string, file_id bigint, v bigint, path string")
    scans = lambda r: spark.createDataFrame(r, "file_id bigint, path string, scan_ts timestamp_ntz").coalesce(1).write.mode("append").parquet(listing)
    from datetime import datetime as T

    scans([(f, f"x/{f}.parquet", T(2018, 1, 1)) for f in (1, 2, 3, 5)] + [(4, "x/4.parquet.inprogress", T(2018, 1, 1)), (7, "x/7.parquet", T(2018, 1, 1)), (None, "y.parquet", None)])
    job = lambda: StreamingCompactor(spark, root, {"t": rows}, target_rows=4).run(listing)
    assert job().merged_files().count() == 0  # three closed, small files
    scans([(4, "x/4.parquet", T(2018, 1, 2)), (6, "x/6.tmp", T(2018, 1, 1))])
    c = job()
    assert sorted(r.file_id for r in c.merged_files().collect()) == [1, 2, 3, 4]
    scans([(6, "x/6.parquet", T(2018, 1, 3))])
    c = job()
    assert sorted(r.file_id for r in c.merged_files().collect()) == [1, 2, 3, 4, 6]
    got = sorted((r.file_id, r.v) for r in c.compacted("t").collect())
    assert got == sorted((f, i) for f, n in ((1, 3), (2, 2), (3, 1), (4, 5), (6, 2)) for i in range(n))
    whole = [(r.symbol, r.file_id, r.v) for r in c.current("t").collect()]
    assert sorted(whole, key=str) == sorted(((r.symbol, r.file_id, r.v) for r in rows.collect()), key=str)
    files = {r.parte for r in c.output["t"].read().select("parte").collect()}
    assert len({x["group"] for x in c.output["t"].manifest()["parts"].values()}) == 1 and len(files) > 1  # one symbol and day, cut at four rows
    c._batch(spark.read.parquet(listing).limit(0), 1)  # a retried micro-batch changes nothing
    assert sorted((r.file_id, r.v) for r in c.compacted("t").collect()) == got
