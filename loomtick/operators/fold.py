"""Sequential folds that are no window functions: greedy refractory selection, recursive averages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .series import fold_series

#: A function from a series' values to as many values.
Series = Callable[[np.ndarray], np.ndarray]


def greedy_keep(df: DataFrame, keys: Sequence[str], at: str, gap: int, order: Sequence[str] = ()) -> DataFrame:
    """Keeps an event iff at least ``gap`` has passed since the last *kept* one of its keys.

    One pass over a key's ordered events (not ticks), so a key should be a symbol and a day, whose events a threshold has
    already made few. Ties in ``at`` go by ``order``, then by the other columns. Events without an instant are dropped.
    """
    rest = [c for c in df.columns if c not in (*keys, at, *order)]

    def fold(t: np.ndarray) -> dict:
        kept, last = np.zeros(len(t), bool), None
        for i, x in enumerate(t.tolist()):
            if last is None or x - last >= gap:
                kept[i], last = True, x
        return {"kept": kept}

    out = fold_series(df.where(F.col(at).isNotNull()), keys, [at, *order, *rest], [at], fold, "", keep="kept")
    return out.select(*keys, at, *(c for c in df.columns if c not in (*keys, at)))


def ema(alpha: float, start: float | None = None) -> Series:
    """Exponential averages of a series, seeded by its first value, or by ``start`` as the average before it."""

    def run(values: np.ndarray) -> np.ndarray:
        out, e = np.empty(len(values)), start
        for i, x in enumerate(values.tolist()):
            e = x if e is None else alpha * x + (1 - alpha) * e
            out[i] = e
        return out

    return run


def seeded_ema(n: int) -> Series:
    """Exponential averages of n bars' span, seeded by the mean of the first n values; NaN before."""

    def run(values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), np.nan)
        if len(values) >= n:
            out[n - 1] = np.mean(values[:n])
            out[n:] = ema(2 / (n + 1), float(out[n - 1]))(values[n:])
        return out

    return run


def wilder(n: int) -> Series:
    """Wilder's average of a series: nothing for the first n−1 values, their mean as the seed, then recursive. Values that aren't there yet are passed over."""

    def run(values: np.ndarray) -> np.ndarray:
        out, total, seen = np.full(len(values), np.nan), 0.0, 0
        for i, x in enumerate(values.tolist()):
            if x != x:
                continue
            seen += 1
            if seen <= n:
                total += x
                e = total / n
            else:
                e = (e * (n - 1) + x) / n
            if seen >= n:
                out[i] = e
        return out

    return run


def by_series(df: DataFrame, keys: Sequence[str], order: str, value: str, series: dict[str, Series]) -> DataFrame:
    """Adds to each key's ordered rows a column per function of its values. NaN comes out as NULL."""
    out = df.select(*keys, order, F.col(value).cast("double").alias(value))
    return fold_series(out, keys, [order], [value], lambda v: {name: f(v) for name, f in series.items()}, ", ".join(f"`{n}` double" for n in series))
