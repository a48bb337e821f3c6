"""Orders against the tape: fills by limits, exits by stop, target and trailing, passive fills by the top of the book."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .asof import range_join
from .series import fold_series

_ORDER = ("ts_ns", "ts_recv_ns", "trade_id")


def limit_fills(orders: DataFrame, trades: DataFrame, keys: Sequence[str], ident: Sequence[str], valid_ns: int) -> DataFrame:
    """Adds ``entrada`` (price), ``entrada_ns`` and ``execucao`` to orders (``lado`` ±1, ``limite``, ``em`` instant); NULL where none.

    Trades of [em, em + valid_ns) count. If the first of them is already beyond the limit the order fills there (``abertura``),
    else the first one strictly through the limit fills it at the limit (``recuo``). A touch is no fill.
    """
    path = trades.select(*keys, "ts_ns", F.struct("ts_recv_ns", "trade_id").alias("_o"), F.col("price").alias("_p"))
    o = orders.withColumn("_from", F.col("em") - 1)
    met = range_join(o, path, keys, "_from", "ts_ns", valid_ns, ["_o", "_p"])
    when = F.struct("_at", "_o")
    through = F.when(F.col("lado") > 0, F.col("_p") < F.col("limite")).otherwise(F.col("_p") > F.col("limite"))
    seen = met.groupBy(*ident).agg(F.min_by(F.struct(F.col("_at").alias("t"), F.col("_p").alias("p"), through.alias("x")), when).alias("_a"), F.min_by(F.struct(F.col("_at").alias("t"), F.col("_p").alias("p")), F.when(through, when)).alias("_b"))
    out = orders.join(seen, list(ident), "left")
    opening = F.coalesce(F.col("_a.x"), F.lit(False))
    kind = F.when(opening, "abertura").when(F.col("_b").isNotNull(), "recuo")
    return out.withColumns({"execucao": kind, "entrada": F.when(opening, F.col("_a.p")).when(kind.isNotNull(), F.col("limite")), "entrada_ns": F.when(kind.isNotNull(), F.col("_b.t"))}).drop("_a", "_b")


def leg_exits(filled: DataFrame, trades: DataFrame, keys: Sequence[str], ident: Sequence[str], stop: float, targets: Sequence[float], trail_from: float, trail_to: float, trail_step: float, flat_ns: int) -> DataFrame:
    """What each leg of a filled order gives: per leg i ``p<i>`` (points) and ``m<i>`` (0 by time, 1 target, 2 stop), and ``saida_ns``.

    Trades after the fill count, up to ``flat_ns`` after it; the stop is checked before the target, on every trade. The first
    leg has a fixed stop. The others trail: once the best move reaches ``trail_from`` the stop goes to ``trail_to`` from the
    entry, and on by each further gain of at least ``trail_step``; a stop that a trade moves holds from the next trade on.
    What is still open at the end leaves at the last price. An order's path is a key of its own, so a hot symbol's orders
    spread, and none waits for another.
    """
    path = trades.select(*keys, "ts_ns", F.struct("ts_recv_ns", "trade_id").alias("_o"), F.col("price").alias("_p"))
    o = filled.where("entrada is not null").select(*keys, *(c for c in ident if c not in keys), "lado", "entrada", "entrada_ns")
    met = range_join(o, path, keys, "entrada_ns", "ts_ns", flat_ns, ["_o", "_p"]).withColumn("_fav", F.round(F.col("lado") * (F.col("_p") - F.col("entrada")), 9))  # prices are decimal
    legs = range(1, len(targets) + 1)

    def fold(fav: np.ndarray, at: np.ndarray) -> dict:
        result, reason = [0.0] * len(targets), [0] * len(targets)
        level, open_, best, active, end = [-stop] * len(targets), set(range(len(targets))), 0.0, False, int(at[-1])
        for x, t in zip(fav.tolist(), at.tolist()):
            for i in sorted(open_):
                if x <= level[i] or x >= targets[i]:
                    reason[i] = 2 if x <= level[i] else 1
                    result[i] = level[i] if reason[i] == 2 else targets[i]
                    open_.discard(i)
            if not open_:
                end = int(t)
                break
            if not active and x >= trail_from or active and x - best >= trail_step:
                gain = trail_to if not active else x - best
                level = [v if i == 0 else (gain if not active else v + gain) for i, v in enumerate(level)]
                active, best = True, x
        for i in open_:
            result[i] = float(fav[-1])
        n = len(fav)
        last = np.zeros(n, bool)
        last[-1] = True
        return {"_last": last, "saida_ns": np.full(n, end)} | {f"p{i}": np.full(n, result[i - 1]) for i in legs} | {f"m{i}": np.full(n, reason[i - 1]) for i in legs}

    ddl = "saida_ns bigint, " + ", ".join(f"p{i} double, m{i} bigint" for i in legs)
    done = fold_series(met.select(*ident, "_at", "_o", "_fav"), ident, ["_at", "_o"], ["_fav", "_at"], fold, ddl, keep="_last").drop("_at", "_o", "_fav")
    return filled.join(done, list(ident), "left")


def passive_fill(orders: DataFrame, tops: DataFrame, keys: Sequence[str], ident: Sequence[str], horizon_ns: int) -> DataFrame:
    """The first top of book within the horizon at which a resting order (``lado`` ±1, ``preco``, ``em``) counts as filled: for a
    buy the ask at or below it, or the bid below it (the level is gone: the end of the queue is assumed); sells mirror it.

    ``tops``: keys, ``ts_recv_ns``, ``topo_id``, ``bid``, ``ask``. Adds ``execucao_ns``, NULL without a fill.
    """
    met = range_join(orders, tops.select(*keys, "ts_recv_ns", "bid", "ask"), keys, "em", "ts_recv_ns", horizon_ns, ["bid", "ask"])
    buy = (F.col("ask") <= F.col("preco") + 1e-9) | (F.col("bid") < F.col("preco") - 1e-9)
    sell = (F.col("bid") >= F.col("preco") - 1e-9) | (F.col("ask") > F.col("preco") + 1e-9)
    hit = met.where(F.when(F.col("lado") > 0, buy).otherwise(sell)).groupBy(*ident).agg(F.min("_at").alias("execucao_ns"))
    return orders.join(hit, list(ident), "left")


def one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, tolerance: int) -> DataFrame:
    """Greedy pairs of events of one key, at most ``tolerance`` apart: left events in order each take the nearest right one (ties: the
    earlier) that nobody took. Columns: keys, ``a`` and ``b``; a key's events are one fold, so it should be a day's."""
    both = left.select(*keys, F.col(at).alias("t"), F.lit(0).alias("s")).unionByName(right.select(*keys, F.col(at).alias("t"), F.lit(1).alias("s")))

    def fold(t: np.ndarray, s: np.ndarray) -> dict:
        mine = t[s == 1].tolist()
        free, out = [True] * len(mine), np.full(len(t), np.nan)
        for i in np.flatnonzero(s == 0).tolist():
            near = [(abs(m - int(t[i])), m, j) for j, m in enumerate(mine) if free[j] and abs(m - int(t[i])) <= tolerance]
            if near:
                _, m, j = min(near)
                free[j], out[i] = False, m
        return {"_b": out}

    out = fold_series(both, keys, ["t", "s"], ["t", "s"], fold, "_b double")
    return out.where("s = 0 and _b is not null").select(*keys, F.col("t").alias("a"), F.col("_b").cast("bigint").alias("b"))


def remaining_after_touch(bars: DataFrame, keys: Sequence[str], order: str, entry: str, adverse: float, horizon: int) -> DataFrame:
    """For entries (``entry`` ±1 at the close) whose whole horizon is there and whose path touches ``adverse`` against them: the bar of
    the touch (from 1) and what holding on gives from there to the last close, filled at the level (``rem_otimista``) and at the
    touching bar's extreme (``rem_pessimista``)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(1, horizon)
    rows = bars.withColumn("_p", F.collect_list(F.struct("high", "low", "close")).over(w)).where((F.col(entry) != 0) & (F.size("_p") == horizon))
    rows = rows.withColumns({"_s": F.col(entry).cast("double"), "_nivel": F.col("close") - adverse * F.col(entry)})
    extremes = F.expr("transform(_p, x -> CASE WHEN _s > 0 THEN x.low ELSE x.high END)")
    rows = rows.withColumn("_e", extremes).withColumn("_i", F.expr("array_position(transform(_e, x -> CASE WHEN _s > 0 THEN x <= _nivel ELSE x >= _nivel END), true)")).where("_i > 0")
    end = F.element_at("_p", -1)["close"]
    return rows.select(*keys, order, entry, F.col("_i").alias("barra"), ((end - F.expr("_e[_i - 1]")) * F.col("_s")).alias("rem_pessimista"), ((end - F.col("_nivel")) * F.col("_s")).alias("rem_otimista"))
