"""Scalar functions as column expressions."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_tick(x: Column, tick: float) -> Column:
    """Rounded half up to a tick, at least one tick; NULL stays NULL."""
    return F.when(x.isNotNull(), F.greatest(F.lit(tick), F.floor(x / tick + 0.5) * tick))


def microprice(bid: Column, bid_size: Column, ask: Column, ask_size: Column) -> Column:
    """Prices weighted by the other side's size; NULL if a side is missing or both sizes are 0."""
    both = bid_size + ask_size
    return F.when((bid > 0) & (ask > 0) & (both > 0), (ask * bid_size + bid * ask_size) / both)


def queue_imbalance(bid_size: Column, ask_size: Column) -> Column:
    both = bid_size + ask_size
    return F.when(both > 0, (bid_size - ask_size) / both)


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson's interval of a share."""
    p = k / n
    mid, half = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4.0 * n * n))
    return (mid - half) / (1 + z * z / n), (mid + half) / (1 + z * z / n)


def ticker_family(symbol: Column) -> Column:
    return (
        F.when(symbol.rlike("FUT$"), "futuro").when(symbol.rlike("^[A-Z]{4}(34|35)$"), "bdr").when(symbol.rlike("^[A-Z]{4}11$"), "unit_etf")
        .when(symbol.rlike("^[A-Z]{4}[3-8]$"), "acao").when(symbol.rlike("^[A-Z]{3}[FGHJKMNQUVXZ][0-9]{2}$"), "vencimento").otherwise("outro")
    )


def brazilian_number(text: Column) -> Column:
    """``1.234,56`` or ``1234.56`` as a double: with a comma, points are thousands. NULL if it is no number."""
    t = F.trim(text)
    return F.when(t.contains(","), F.translate(F.regexp_replace(t, r"\.", ""), ",", ".")).otherwise(t).try_cast("double")


def chart_date(code: Column) -> Column:
    """``1YYMMDD`` as a date; NULL if it is none."""
    day = code.cast("bigint") + 19_000_000
    return F.to_date(F.try_to_timestamp(day.cast("string"), F.lit("yyyyMMdd")))


def safe_path(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9._-]", "_")


def hhmm_label(hhmm: Column) -> Column:
    return F.format_string("%02d:%02d", F.floor(hhmm / 100).cast("bigint"), F.pmod(hhmm, F.lit(100)).cast("bigint"))


def minimum_effect(sd: Column, n: Column) -> Column:
    """Smallest effect a sample could show: 1.96·sd/√n."""
    return 1.96 * sd / F.sqrt(n)


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def normal_quantile(p: float) -> float:
    """Inverse of :func:`normal_cdf` by bisection and Newton steps; driver-side."""
    if not 0 < p < 1:
        raise ValueError("0 < p < 1")
    lo, hi = -40.0, 40.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if normal_cdf(mid) < p else (lo, mid)
    return (lo + hi) / 2


def t_critical(p: float, df: int) -> float:
    """Student quantile by the Cornish-Fisher expansion around the normal one."""
    z = normal_quantile(p)
    z2 = z * z
    terms = (z * (z2 + 1) / 4, z * (5 * z2 * z2 + 16 * z2 + 3) / 96, z * (3 * z2**3 + 19 * z2**2 + 17 * z2 - 15) / 384)
    return z + sum(t / df ** (i + 1) for i, t in enumerate(terms))


def deflated_threshold(trials: int, level: float = 0.05) -> float:
    """Two-sided normal threshold after ``trials`` tests (Bonferroni)."""
    return normal_quantile(1 - level / (2 * max(trials, 1)))


def nearest_wednesday(month: Column) -> Column:
    """The Wednesday nearest the 15th of a date's month."""
    middle = F.date_add(F.trunc(month, "month"), 14)
    ahead = F.pmod(F.lit(4) - F.dayofweek(middle) + 3, F.lit(7)) - 3  # −3 to 3; dayofweek counts from Sunday
    return F.date_add(middle, ahead.cast("int"))


_TOKEN = re.compile(r"\s*(?:(?P<name>[A-Za-z_]\w*)|(?P<number>\d+(?:\.\d+)?)|(?P<op><=|>=|<>|!=|==|[-+*/%()<>=]))")
_WORDS = {"and", "or", "not", "is", "null", "between", "abs", "true", "false"}


def checked_expression(text: str, columns: Sequence[str]) -> Column:
    """A user's expression as a column: names of ``columns``, numbers, arithmetic, comparisons, and/or/not/is null/between/abs.

    Anything else (other names, calls, quotes, semicolons) is refused before Spark sees it.
    """
    at, known = 0, {c.lower() for c in columns}
    while text[at:].strip():
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"not allowed at {at}: {text[at:at + 20]!r}")
        name = m["name"]
        if name and name.lower() not in known | _WORDS:
            raise ValueError(f"unknown column {name!r}")
        at = m.end()
    if not at:
        raise ValueError("empty expression")
    return F.expr(text)


def content_hash(*columns: str) -> Column:
    """SHA-256 of the columns as JSON, in the order given; NULL fields are left out of it, as JSON does."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)
