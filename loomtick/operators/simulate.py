"""A policy run bar by bar, day by day, and the check that it doesn't look ahead."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

#: A policy sees one bar, its place in the day and the open position (−1, 0, 1), and answers the position it wants (None: as it is).
Policy = Callable[[dict[str, Any], int, int], "int | None"]


@dataclass(frozen=True)
class Limits:
    """Exits forced by the close, in this order of priority, and a stop for the day after losses in a row."""

    stop: float | None = None
    target: float | None = None
    bars: int | None = None
    losses_in_a_row: int | None = None
    cost: float = 0.0


def run_day(bars: pd.DataFrame, order: str, policy: Policy, limits: Limits) -> list[tuple]:
    """(order in, order out, side, price in, price out, net result, reason) of a day's operations."""
    out: list[tuple] = []
    side, entry, since, losses = 0, 0.0, 0, 0
    rows = bars.sort_values(order).to_dict("records")

    def leave(i: int, reason: str) -> None:
        nonlocal side, losses
        net = (rows[i]["close"] - entry) * side - limits.cost
        out.append((rows[since][order], rows[i][order], side, entry, rows[i]["close"], net, reason))
        losses = losses + 1 if net < 0 else 0
        side = 0

    for i, row in enumerate(rows):
        wanted = policy(row, i, side)
        if side:
            gain = (row["close"] - entry) * side
            if limits.stop is not None and gain <= -limits.stop:
                leave(i, "stop")
            elif limits.target is not None and gain >= limits.target:
                leave(i, "alvo")
            elif limits.bars is not None and i - since >= limits.bars:
                leave(i, "tempo")
            elif wanted is not None and wanted != side:
                leave(i, "politica")
        elif wanted and not (limits.losses_in_a_row and losses >= limits.losses_in_a_row):
            side, entry, since = wanted, row["close"], i
    if side:
        leave(len(rows) - 1, "fim_do_dia")
    return out


def simulate(bars: DataFrame, keys: Sequence[str], order: str, policy: Policy, limits: Limits | None = None, hide: Sequence[str] = ()) -> DataFrame:
    """A policy over every key (a symbol and day) on its own; columns of ``hide`` (labels) never reach it."""
    limits = limits or Limits()
    kinds = dict(bars.dtypes)
    ddl = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", entrada {kinds[order]}, saida {kinds[order]}, lado bigint, preco_entrada double, preco_saida double, resultado double, motivo string"

    def day(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, *op) for op in run_day(pdf, order, policy, limits)], columns=[c.split()[0].strip("`") for c in ddl.split(", ")])

    return bars.drop(*hide).groupBy(*keys).applyInPandas(day, ddl)


def looks_ahead(bars: pd.DataFrame, order: str, policy: Callable[[], Policy], cuts: Sequence[int]) -> list[int]:
    """Prefix lengths on which a fresh policy decides otherwise than over the whole day; empty if it doesn't look ahead."""
    rows = bars.sort_values(order).to_dict("records")
    whole = policy()
    want = [whole(r, i, 0) for i, r in enumerate(rows)]
    bad = []
    for n in cuts:
        p = policy()
        if [p(r, i, 0) for i, r in enumerate(rows[:n])] != want[:n]:
            bad.append(n)
    return bad
