"""Price profiles, absorption readings, ties by the tape and doubled book days on planted cases."""

import pytest
from pyspark.sql import functions as F

from loomtick.operators import bars as B
from loomtick.operators.book import undouble
from loomtick.operators.labels import triple_barrier_by_tape


def profile(spark, bins):
    return spark.createDataFrame([("A", float(b), v) for b, v in bins.items()], "symbol string, faixa double, volume bigint")


@pytest.mark.parametrize(
    ("bins", "mode", "want"),
    [
        ({0: 3, 1: 10, 3: 5}, "bin", (1.0, 4.0, 15.0)),  # the next filled bin, however far
        ({0: 2, 1: 3, 2: 10, 3: 3, 4: 2}, "bin", (1.0, 4.0, 16.0)),  # ties go up, then the larger neighbour
        ({0: 4, 1: 1, 2: 10, 3: 2, 4: 1}, "bin", (2.0, 5.0, 13.0)),
        ({0: 4, 1: 1, 2: 10, 3: 2, 4: 1}, "pares", (0.0, 3.0, 15.0)),  # two below outweigh two above
        ({7: 5}, "bin", (7.0, 8.0, 5.0)),
        ({7: 5}, "pares", (7.0, 8.0, 5.0)),
    ],
)
def test_value_area(spark, bins, mode, want):
    r = B.value_area(profile(spark, bins), ["symbol"], 1.0, mode=mode).first()
    assert (r.de, r.ate, r.dentro, r.total) == (*want, float(sum(bins.values())))


def test_value_area_of_nothing_and_of_an_unknown_mode(spark):
    assert B.value_area(profile(spark, {}), ["symbol"], 1.0).count() == 0
    with pytest.raises(ValueError):
        B.value_area(profile(spark, {1: 1}), ["symbol"], 1.0, mode="trio")


def test_volume_nodes(spark):
    nodes = lambda bins: sorted((r.faixa, r.no, r.volume) for r in B.volume_nodes(profile(spark, bins), ["symbol"], 1.0).collect())
    assert nodes({0: 10, 1: 2, 2: 20, 3: 9, 4: 12}) == [(0.0, "hvn", 10), (1.0, "lvn", 2), (2.0, "hvn", 20), (4.0, "hvn", 12)]
    assert nodes({0: 10, 2: 20, 3: 9}) == [(0.0, "hvn", 10), (1.0, "lvn", 0), (2.0, "hvn", 20)]
    assert nodes({0: 10, 9: 20}) == []  # two filled bins
    assert [x for x in nodes({0: 10, 1: 9, 50: 20}) if 4 < x[0] < 47] == []  # far from any trade nothing stands out


def test_effort_and_reading(spark):
    rows = [(100, 2.0, 2.0, 1.5), (100, 0.0, 2.0, 0.2), (50, 1.0, -1.75, -1.0), (50, 1.0, -2.0, 1.5), (50, 1.0, 1.74, 9.0), (50, 1.0, None, None), (9, 1.0, 2.0, None)]
    df = spark.createDataFrame(rows, "v bigint, reach double, a double, i double")
    got = [(r.e, r.l) for r in df.select(B.effort(F.col("v"), F.col("reach"), F.lit(0.5)).alias("e"), B.absorption_reading(F.col("a"), F.col("i"), 1.75, 1.0).alias("l")).collect()]
    assert got == [(25.0, "A_compra_absorvida"), (None, "B_queda_sem_esforco"), (25.0, "A_venda_absorvida"), (25.0, "B_alta_sem_esforco"), (25.0, "nao_pintou"), (25.0, "nao_pintou"), (4.5, "B_queda_sem_esforco")]


def test_a_tie_is_broken_by_the_first_trade(spark):
    closes = [100.0, 101.0, 100.0, 101.0, 100.0, 100.0, 100.0, 100.0]
    bars = spark.createDataFrame([("A", i, c, c, c) if i != 5 else ("A", 5, 120.0, 80.0, c) for i, c in enumerate(closes)], "s string, m bigint, high double, low double, close double")
    trade = lambda rows: spark.createDataFrame(rows, "s string, m bigint, price double, ts_ns bigint, ts_recv_ns bigint, trade_id bigint")
    label = lambda t: {r.m: (r.rotulo, r.desempatado) for r in triple_barrier_by_tape(bars, t, ["s"], "m", 2.0, 2, 4, 2).collect()}
    assert label(trade([("A", 5, 100.0, 1, 1, 1), ("A", 5, 80.0, 2, 1, 2), ("A", 5, 120.0, 3, 1, 3)]))[4] == (-1, True)
    assert label(trade([("A", 5, 120.0, 2, 1, 2), ("A", 5, 80.0, 2, 1, 3), ("A", 4, 80.0, 1, 1, 1)]))[4] == (1, True)
    out = label(trade([]))
    assert out[4] == (0, True) and out[0] == (None, False) and out[6] == (None, False) and out[7] == (None, False)  # no σ yet; the day ends first


BOOK = "d string, i bigint, action bigint, price double"


def test_doubled_days_are_halved(spark):
    pair = [(1, 10.0), (2, None), (3, 11.0)]
    twice = [("x", 2 * i + k, a, p) for i, (a, p) in enumerate(pair) for k in (0, 1)]
    once = [("y", i, a, p) for i, (a, p) in enumerate(pair)]
    nearly = [("z", i, 1, 5.0) for i in range(2)] + [("z", 2, 2, 5.0)]  # two thirds are in even runs
    four = [("w", i, 1, None) for i in range(4)]
    out = undouble(spark.createDataFrame(twice + once + nearly + four, BOOK), ["d"], ["i"], ["action", "price"]).collect()
    kept = {d: sorted(r.i for r in out if r.d == d and r.mantida) for d in "xyzw"}
    assert kept == {"x": [0, 2, 4], "y": [0, 1, 2], "z": [0, 1, 2], "w": [0, 1]}
    assert {r.d: (round(r.fracao_par, 4), r.dobrado) for r in out} == {"x": (1.0, True), "y": (0.0, False), "z": (0.6667, False), "w": (1.0, True)}
    assert undouble(spark.createDataFrame([], BOOK), ["d"], ["i"], ["action"]).count() == 0
