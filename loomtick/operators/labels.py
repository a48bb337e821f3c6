"""Path labels: barriers, forward excursions, sequential trades."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .series import fold_series


def triple_barrier(bars: DataFrame, keys: Sequence[str], order: str, k: float, horizon: int, vol_rows: int = 50, vol_least: int = 25, truncated: bool = True) -> DataFrame:
    """Adds ``sigma`` (strictly past deviation of log returns), ``rotulo`` (+1, −1, 0) and ``ambiguo``.

    The first of the next ``horizon`` bars whose high reaches close·(1+kσ) or low close·(1−kσ) decides; both in one bar: 0 and
    ambiguous; none: 0. With ``truncated`` false, bars without a whole horizon left have a NULL label. ``keys`` with the day
    keep a horizon inside it, without it horizons cross days. One window of ``horizon`` rows a bar; no self-join.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    past = w.rowsBetween(-vol_rows, -1)
    out = bars.withColumn("_r", F.log(F.col("close") / F.lag("close").over(w)))
    out = out.withColumn("sigma", F.when(F.count("_r").over(past) >= vol_least, F.stddev_samp("_r").over(past)))
    ahead = w.rowsBetween(1, horizon)
    up, down = F.col("close") * (1 + k * F.col("sigma")), F.col("close") * (1 - k * F.col("sigma"))
    path = F.collect_list(F.struct("high", "low")).over(ahead)
    out = out.withColumns({"_p": path, "_u": up, "_d": down})
    touch = F.expr("filter(transform(_p, x -> struct(x.high >= _u AS u, x.low <= _d AS d)), x -> x.u OR x.d)")
    first = F.try_element_at(touch, F.lit(1))
    label = F.when(F.col("sigma").isNull(), F.lit(None)).when(first.isNull(), 0).when(first["u"] & first["d"], 0).when(first["u"], 1).otherwise(-1)
    if not truncated:
        label = F.when(first.isNull() & (F.size("_p") < horizon), F.lit(None)).otherwise(label)
    return out.withColumns({"rotulo": label.cast("bigint"), "ambiguo": F.coalesce(first["u"] & first["d"], F.lit(False))}).drop("_r", "_p", "_u", "_d")


def triple_barrier_by_tape(bars: DataFrame, trades: DataFrame, keys: Sequence[str], order: str, k: float, horizon: int, vol_rows: int = 50, vol_least: int = 25) -> DataFrame:
    """Adds ``rotulo`` and ``desempatado``: barriers at close·exp(±kσ) inside ``keys`` (a day), σ as in :func:`triple_barrier`.

    Bars without a positive σ, or with fewer than ``horizon`` bars left, have a NULL label. Where the deciding bar touches
    both sides, the first of ``trades`` (keys, ``order`` of its bar, tape order) beyond either barrier decides, and without
    one the label is 0. Only bars with such a tie meet the tape, by an equi-join on the deciding bar.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    past, ahead = w.rowsBetween(-vol_rows, -1), w.rowsBetween(1, horizon)
    out = bars.withColumn("_r", F.log(F.col("close") / F.lag("close").over(w)))
    out = out.withColumn("_s", F.when(F.count("_r").over(past) >= vol_least, F.stddev_samp("_r").over(past)))
    out = out.withColumns({"_p": F.collect_list(F.struct(F.col(order).alias("o"), "high", "low")).over(ahead), "_u": F.col("close") * F.exp(k * F.col("_s")), "_d": F.col("close") * F.exp(-k * F.col("_s"))})
    touch = F.expr("filter(transform(_p, x -> struct(x.high >= _u AS u, x.low <= _d AS d, x.o AS o)), x -> x.u OR x.d)")
    valid = F.coalesce((F.col("_s") > 0) & (F.size("_p") == horizon), F.lit(False))
    out = out.withColumns({"_ok": valid, "_f": F.try_element_at(touch, F.lit(1))}).drop("_r", "_p", "_s")
    out = out.withColumn("_tie", F.coalesce(F.col("_ok") & F.col("_f.u") & F.col("_f.d"), F.lit(False)))
    path = trades.select(*keys, F.col(order).alias("_at"), F.col("price").alias("_price"), F.struct("ts_ns", "ts_recv_ns", "trade_id").alias("_when"))
    met = out.where("_tie").select(*keys, order, F.col("_f.o").alias("_at"), "_u", "_d").join(path, [*keys, "_at"]).where("_price >= _u or _price <= _d")
    first = met.groupBy(*keys, order).agg(F.min_by(F.col("_price") >= F.col("_u"), "_when").alias("_up"))
    out = out.join(first, [*keys, order], "left")
    tied = F.when(F.col("_up"), 1).when(~F.col("_up"), -1).otherwise(0)
    label = F.when(F.col("_ok"), F.when(F.col("_f").isNull(), 0).when(F.col("_tie"), tied).when(F.col("_f.u"), 1).otherwise(-1))
    return out.withColumns({"rotulo": label.cast("bigint"), "desempatado": F.col("_tie")}).drop("_ok", "_f", "_tie", "_u", "_d", "_up")


def excursions(bars: DataFrame, keys: Sequence[str], order: str, horizons: Sequence[int]) -> DataFrame:
    """Adds, per horizon h, ``mfe_h`` (at least 0) and ``mae_h`` (at most 0) of a long entry at the close; NULL where the day ends first."""
    w = Window.partitionBy(*keys).orderBy(order)
    new = {}
    for h in horizons:
        ahead = w.rowsBetween(1, h)
        full = F.count(F.lit(1)).over(ahead) == h
        new[f"mfe_{h}"] = F.when(full, F.greatest(F.max("high").over(ahead) - F.col("close"), F.lit(0.0)))
        new[f"mae_{h}"] = F.when(full, F.least(F.min("low").over(ahead) - F.col("close"), F.lit(0.0)))
    return bars.withColumns(new)


def resolve_target_stop(bars: DataFrame, keys: Sequence[str], order: str, entry: str, target: float, stop: float, horizon: int) -> DataFrame:
    """For bars where ``entry`` is ±1: which of target and stop (price units from the close) a following bar of the key meets first.

    Columns added: ``desfecho`` (``alvo``, ``stop``, ``ambiguo`` for both in one bar, ``tempo``), ``saida`` (order of the deciding bar, or of the
    last one in reach) and ``resultado`` (pessimistic: ambiguous counts as stop; by time: last close).
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(1, horizon)
    out = bars.withColumn("_p", F.collect_list(F.struct(F.col(order).alias("o"), "high", "low", "close")).over(w)).where(F.col(entry) != 0)
    out = out.withColumns({"_s": F.col(entry).cast("double"), "_c": F.col("close")})
    seen = F.expr(f"transform(_p, x -> struct(CASE WHEN _s > 0 THEN x.high >= _c + {target} ELSE x.low <= _c - {target} END AS t, CASE WHEN _s > 0 THEN x.low <= _c - {stop} ELSE x.high >= _c + {stop} END AS s, x.o AS o))")
    out = out.withColumn("_f", F.try_element_at(F.filter(seen, lambda x: x["t"] | x["s"]), F.lit(1))).withColumn("_l", F.try_element_at("_p", F.lit(-1)))
    f = F.col("_f")
    kind = F.when(f.isNull(), "tempo").when(f["t"] & f["s"], "ambiguo").when(f["t"], "alvo").otherwise("stop")
    result = F.when(f.isNull(), F.coalesce(F.col("_s") * (F.col("_l.close") - F.col("_c")), F.lit(0.0))).when(f["s"], F.lit(-stop)).otherwise(F.lit(float(target)))
    return out.withColumns({"desfecho": kind, "saida": F.coalesce(f["o"], F.col("_l.o")), "resultado": result}).drop("_p", "_s", "_c", "_f", "_l")


def one_at_a_time(trades: DataFrame, keys: Sequence[str], entry: str, leave: str) -> DataFrame:
    """Drops entries while an earlier kept one is still open (entry ≤ its exit; without one: entry ≤ its own entry): one pass over a key's ordered signals."""
    rest = [c for c in trades.columns if c not in (*keys, entry, leave)]

    def fold(start: np.ndarray, end: np.ndarray) -> dict:
        kept, busy = np.zeros(len(start), bool), None
        for i, (a, b) in enumerate(zip(start.tolist(), end.tolist())):
            if busy is None or a > busy:
                kept[i], busy = True, a if b != b else b
        return {"kept": kept}

    return fold_series(trades, keys, [entry, leave, *rest], [entry, leave], fold, "", keep="kept").select(*keys, entry, leave, *rest)
