"""Technical indicators per contiguous block."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from .windows import full_window


def true_range(high: Column, low: Column, close: Column, by: WindowSpec) -> Column:
    """NULL on the first bar."""
    before = F.lag(close).over(by)
    return F.when(before.isNotNull(), F.greatest(high - low, F.abs(high - before), F.abs(low - before)))


def sma(x: Column, by: WindowSpec, n: int) -> Column:
    return full_window(F.avg(x), x, by, -(n - 1), 0)


def bollinger(x: Column, by: WindowSpec, n: int = 21, width: float = 2.0, sample: bool = False) -> tuple[Column, Column, Column]:
    """Lower, middle and upper band."""
    mid = sma(x, by, n)
    sd = full_window(F.stddev_samp(x) if sample else F.stddev_pop(x), x, by, -(n - 1), 0)
    return mid - width * sd, mid, mid + width * sd


def stochastic(high: Column, low: Column, close: Column, by: WindowSpec, n: int = 14) -> Column:
    """Fast %K; NULL until full or where the range is flat."""
    top, bottom = full_window(F.max(high), high, by, -(n - 1), 0), full_window(F.min(low), low, by, -(n - 1), 0)
    return F.when(top > bottom, 100.0 * (close - bottom) / (top - bottom))


def rsi(gain: Column, loss: Column) -> Column:
    """From average gain and loss: 100 without losses, 50 where nothing moved."""
    return F.when(gain.isNull() | loss.isNull(), F.lit(None)).when((loss == 0) & (gain == 0), 50.0).when(loss == 0, 100.0).otherwise(100.0 - 100.0 / (1 + gain / loss))


def gains(values: np.ndarray) -> np.ndarray:
    """How far each value rose from the one before, 0 where it fell; NaN for the first. Losses are the gains of −values."""
    out = np.full(len(values), np.nan)
    out[1:] = np.maximum(np.diff(values), 0.0)
    return out
