"""Volume bars, time bars, profiles."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tape import AUCTION, BUY, RETAIL, SELL, TAPE_ORDER, aggressor_sign, is_aggressor
from .windows import sliced_running_sum, with_previous

_DAY = ("symbol", "dt")

#: Running sums are cut into slices of this length.
SLICE_NS = 300_000_000_000


def _aggr(c: str = "quantidade") -> Column:
    return F.when(is_aggressor(F.col("trade_type")), F.col(c)).otherwise(0)


def two_digits(x: Column) -> Column:
    """Two significant digits, half to even."""
    scale = F.pow(F.lit(10.0), F.floor(F.log10(x)) - 1)
    return F.greatest(F.floor(F.bround(x / scale, 0) * scale + 1e-9), F.lit(1)).cast("bigint")


def suggest_threshold(tape: DataFrame, per_day: int) -> DataFrame:
    """By symbol: the median daily aggressor volume over ``per_day``, to two significant digits."""
    return _threshold(tape.where(is_aggressor(F.col("trade_type"))).groupBy(*_DAY).agg(F.sum("quantidade").alias("v")), per_day)


def _threshold(daily: DataFrame, per_day: int) -> DataFrame:
    return daily.groupBy("symbol").agg(F.median("v").alias("mediana")).withColumn("limite", two_digits(F.greatest(F.col("mediana") / per_day, F.lit(1.0))))


def local_bars(tape: DataFrame, threshold: int | Column | None, per_day: int | None = None) -> DataFrame:
    """Adds ``_l``, the trade's bar inside its day, and ``_n``, the day's number of complete bars; trades behind the last one are dropped.

    ``threshold`` None takes the symbol's own suggestion of ``per_day`` bars, from the same sums by slice. The sums run in
    two levels, so no task holds a whole day of one symbol.
    """
    enrich = None
    if threshold is None:

        def enrich(slices: DataFrame) -> DataFrame:
            daily = slices.where("_cum_all > 0").groupBy(*_DAY).agg(F.first("_cum_all").alias("v"))
            return slices.join(_threshold(daily, per_day).select("symbol", F.col("limite").alias("_limit")), "symbol")

    rows = sliced_running_sum(tape, _DAY, "ts_ns", SLICE_NS, TAPE_ORDER, {"_cum": _aggr()}, enrich=enrich)
    t = F.col("_limit") if threshold is None else threshold if isinstance(threshold, Column) else F.lit(threshold)
    rows = rows.withColumns({"_l": F.floor(F.col("_cum") / t).cast("bigint"), "_n": F.floor(F.col("_cum_all") / t).cast("bigint")})
    return rows.where(F.col("_l") < F.col("_n")).drop("_cum", "_cum_all", "_limit")


def volume_bars(tape: DataFrame, threshold: int | Column | None, offset: str | None = "last", per_day: int | None = None) -> DataFrame:
    """Adds ``bar_id``: aggressor volume before the trade, over the whole day, div ``threshold`` (None: as :func:`local_bars`).

    A trade that crosses belongs to the bar it completes, others stay in the bar in formation, the day's last incomplete
    bar is dropped, and no bar crosses days. ``offset`` makes ids global per symbol: ``"completed"`` adds the earlier days'
    total div threshold, ``"last"`` one more than the highest id those days really have, None keeps them local.
    """
    rows = local_bars(tape, threshold, per_day)
    if offset is None:
        return rows.withColumnRenamed("_l", "bar_id").drop("_n")
    by_day = rows.groupBy(*_DAY).agg(F.max("_l").alias("_m"), F.max("_n").alias("_t"))
    step = F.col("_t") if offset == "completed" else F.col("_m") + 1
    earlier = Window.partitionBy("symbol").orderBy("dt").rowsBetween(Window.unboundedPreceding, -1)
    by_day = by_day.select(*_DAY, F.coalesce(F.sum(step).over(earlier), F.lit(0)).alias("_o"))
    return rows.join(by_day, list(_DAY)).withColumn("bar_id", F.col("_l") + F.col("_o")).drop("_l", "_n", "_o")


def flow_bars(tape: DataFrame, per_day: int, tick: Column, keep_day: bool = False) -> DataFrame:
    """Volume bars of the symbol's own size with their flow features, ids as in :func:`volume_bars` with ``"last"``.

    Bars are built inside their days and numbered afterwards, on bars instead of trades: the last bar of a day always has
    the aggressor trade that completes it, so no day's highest id is lost with bars without aggression.
    """
    f = flow_features(local_bars(tape, None, per_day), [*_DAY, "_l", "_tick"], F.col("_tick"), {"_tick": tick})
    w = Window.partitionBy("symbol").orderBy("dt", "_l")
    ends = F.coalesce(F.lead("dt").over(w) != F.col("dt"), F.lit(True))
    f = f.withColumn("_e", F.when(ends, F.col("_l") + 1).otherwise(0))
    earlier = F.coalesce(F.sum("_e").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return f.withColumn("bar_id", F.col("_l") + earlier).drop("_l", "_e", "_tick", *(() if keep_day else ("dt",)))


def time_bars(tape: DataFrame, period_ns: int) -> DataFrame:
    """Adds ``bar_id`` by the epoch's buckets: the day's last bucket is dropped, gaps stay, ids run on over a symbol's days.

    Which buckets there are is a table of one row each; ticks only join it, by bucket, so no task holds a day of them.
    """
    rows = tape.withColumn("_b", F.expr(f"ts_ns div {period_ns}"))
    day = Window.partitionBy(*_DAY)
    cells = rows.select(*_DAY, "_b").distinct().withColumn("_last", F.max("_b").over(day)).where("_b < _last").drop("_last")
    spans = cells.groupBy(*_DAY).agg(F.min("_b").alias("_f"), (F.max("_b") - F.min("_b") + 1).alias("_s"))
    earlier = Window.partitionBy("symbol").orderBy("dt").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(*_DAY, "_f", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_o"))
    numbered = cells.join(spans, list(_DAY)).select(*_DAY, "_b", (F.col("_b") - F.col("_f") + F.col("_o")).alias("bar_id"))
    return rows.join(numbered, [*_DAY, "_b"]).drop("_b")


def session_bars(tape: DataFrame, period_ns: int, fold_from: int, max_gap_ns: int = 5_000_000_000) -> DataFrame:
    """Adds ``bucket`` and ``gap_ok``: trades from the instant of day ``fold_from`` (ns) on belong to the last bucket before it,
    and a bucket is reliable if no two neighbouring trades of the day in it are more than ``max_gap_ns`` apart."""
    early = F.pmod(F.col("ts_ns"), F.lit(86_400_000_000_000)) < fold_from
    own = F.expr(f"ts_ns div {period_ns}")
    last = tape.where(early).groupBy(*_DAY).agg(F.max(own).alias("_last"))
    rows = with_previous(tape, _DAY, "ts_ns", SLICE_NS, TAPE_ORDER, ["ts_ns"]).join(last, list(_DAY), "left")
    rows = rows.withColumn("bucket", F.when(early, own).otherwise(F.coalesce("_last", own)))
    return rows.withColumn("gap_ok", F.coalesce(F.col("ts_ns") - F.col("_prev.ts_ns") <= max_gap_ns, F.lit(True))).drop("_prev", "_last")


def ohlc(rows: DataFrame, keys: Sequence[str], only_aggressors: bool = True) -> DataFrame:
    """Open, high, low, close, volume, trades and instants per key; first and last by the tape's order, never by arrival."""
    at = F.struct(*TAPE_ORDER)
    base = rows.where(is_aggressor(F.col("trade_type"))) if only_aggressors else rows
    return base.groupBy(*keys).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"),
        F.sum("quantidade").alias("volume"), F.count(F.lit(1)).alias("n_trades"), F.min("ts_ns").alias("ts_open"), F.max("ts_ns").alias("ts_close"),
    )


def roll_up(bars: DataFrame, keys: Sequence[str], period_ns: int, at: str = "ts_open") -> DataFrame:
    """Finer bars into coarser ones: first open, extremes, last close, volume and how many there were."""
    return bars.groupBy(*keys, F.expr(f"`{at}` div {period_ns}").alias("bucket")).agg(
        F.min_by("open", at).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", at).alias("close"),
        F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("filhas"),
    )


def price_profile(tape: DataFrame, keys: Sequence[str], bin_size: float) -> DataFrame:
    """Volume by price bin: total, aggressor buys and sells, retail, auction."""
    kind = lambda k: F.sum(F.when(F.col("trade_type") == k, F.col("quantidade")).otherwise(0))
    return tape.groupBy(*keys, (F.floor(F.col("price") / bin_size) * bin_size).alias("faixa")).agg(
        F.sum("quantidade").alias("volume"), kind(BUY).alias("compra"), kind(SELL).alias("venda"), kind(RETAIL).alias("varejo"), kind(AUCTION).alias("leilao")
    )


def point_of_control(profile: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bin of most volume; ties: nearest to the middle of the range, then the lower. With the plateau's ends (bins of at least 90 %)."""
    day = Window.partitionBy(*keys)
    rows = profile.withColumns({"_m": (F.min("faixa").over(day) + F.max("faixa").over(day)) / 2, "_v": F.max("volume").over(day)})
    best = F.max_by("faixa", F.struct(F.col("volume"), -F.abs(F.col("faixa") - F.col("_m")), -F.col("faixa")))
    top = F.col("volume") >= 0.9 * F.col("_v")
    return rows.groupBy(*keys).agg(best.alias("poc"), F.max("volume").alias("volume"), F.min(F.when(top, F.col("faixa"))).alias("plato_de"), F.max(F.when(top, F.col("faixa"))).alias("plato_ate"))


def _area(volumes: Sequence[float], centre: int, share: float, step: int) -> tuple[int, int, float]:
    """First and last place and volume of the value area over the volumes of filled bins in order of price."""
    goal, lo, hi, got = share * sum(volumes), centre, centre + 1, volumes[centre]
    while got < goal and (lo or hi < len(volumes)):
        below, above = volumes[max(0, lo - step) : lo], volumes[hi : hi + step]
        if above and (not below or sum(above) >= sum(below)):
            hi, got = hi + len(above), got + sum(above)
        else:
            lo, got = lo - len(below), got + sum(below)
    return lo, hi - 1, got


def value_area(profile: DataFrame, keys: Sequence[str], bin_size: float, share: float = 0.7, mode: str = "bin") -> DataFrame:
    """The value area: from the POC towards the larger neighbour (ties up) until ``share`` of the volume is in.

    A neighbour is the next *filled* bin; ``mode`` "bin" takes one at a time, "pares" two, comparing the sums of both.
    ``de`` and ``ate`` are outer edges. Greedy and sequential, so each key's profile (filled bins only, however wide its
    price range) goes to one task.
    """
    if mode not in ("bin", "pares"):
        raise ValueError(f"{mode!r} is no mode of the value area")
    kinds, step = dict(profile.dtypes), 1 if mode == "bin" else 2
    poc = point_of_control(profile, keys).select(*keys, "poc")
    rows = profile.join(poc, list(keys)).select(*keys, "faixa", F.col("volume").cast("double").alias("v"), "poc")

    def area(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("faixa")
        at, v, poc = pdf.faixa.tolist(), pdf.v.tolist(), pdf.poc.iloc[0]
        a, b, got = _area(v, at.index(poc), share, step)
        return pd.DataFrame([(*key, poc, at[a], at[b] + bin_size, got, sum(v))])

    ddl = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", poc double, de double, ate double, dentro double, total double"
    return rows.groupBy(*keys).applyInPandas(area, ddl)


def volume_nodes(profile: DataFrame, keys: Sequence[str], bin_size: float, low: float = 0.3, high: float = 0.5) -> DataFrame:
    """Low- and high-volume nodes (``no``: lvn, hvn) on the grid between the lowest and the highest filled bin, empty bins counting as 0.

    A low node has less than ``low`` times the mean of up to two neighbours on each side (fewer at the ends), a high node
    is not below either neighbour and has at least ``high`` times the POC's volume. Profiles of fewer than three filled
    bins have no nodes. Only bins within two of a filled one are laid out: elsewhere all volumes are 0 and nothing stands out.
    """
    span = Window.partitionBy(*keys)
    b = profile.withColumn("_k", F.round(F.col("faixa") / bin_size).cast("bigint"))
    b = b.withColumns({"_lo": F.min("_k").over(span), "_hi": F.max("_k").over(span), "_top": F.max("volume").over(span), "_bins": F.count(F.lit(1)).over(span)}).where("_bins >= 3")
    near = b.withColumn("_o", F.explode(F.array(*(F.lit(i) for i in range(-2, 3)))))
    near = near.groupBy(*keys, (F.col("_k") + F.col("_o")).alias("k"), "_lo", "_hi", "_top").agg(F.sum(F.when(F.col("_o") == 0, F.col("volume")).otherwise(0)).alias("volume"))
    near = near.where("k between _lo and _hi")
    w = span.orderBy("k")
    v, k = F.col("volume"), F.col("k")
    at = lambda step, i: F.when(step("k", 1).over(w) == k + i, step("volume", 1).over(w)).when(step("k", 2).over(w) == k + i, step("volume", 2).over(w)).otherwise(0)
    a1, a2, d1, d2 = at(F.lag, -1), at(F.lag, -2), at(F.lead, 1), at(F.lead, 2)
    near = near.withColumns({"_a1": a1, "_d1": d1, "_all": a1 + a2 + d1 + d2})
    beside = F.least(k - F.col("_lo"), F.lit(2)) + F.least(F.col("_hi") - k, F.lit(2))
    mean = F.col("_all").cast("double") / beside
    kind = F.when((mean > 0) & (v < low * mean), "lvn").when((v > 0) & (v >= F.col("_a1")) & (v >= F.col("_d1")) & (v >= high * F.col("_top")), "hvn")
    return near.withColumn("no", kind).where("no is not null").select(*keys, (k * bin_size).alias("faixa"), "volume", "no")


def infer_tick(tape: DataFrame) -> DataFrame:
    """By symbol: the median over days of the day's least positive price step between aggressor trades."""
    rows = with_previous(tape.where(is_aggressor(F.col("trade_type"))), _DAY, "ts_ns", SLICE_NS, TAPE_ORDER, ["price"])
    daily = rows.withColumn("_s", F.abs(F.col("price") - F.col("_prev.price"))).where("_s > 1e-9").groupBy(*_DAY).agg(F.min("_s").alias("_s"))
    return daily.groupBy("symbol").agg(F.median("_s").alias("tick"))


def flow_features(rows: DataFrame, keys: Sequence[str], tick: float | Column, derived: dict[str, Column] | None = None) -> DataFrame:
    """Bars with order flow: OHLC and VWAP of aggressor trades, signed volumes, imbalances, absorption, displacement, retail share.

    Bars without aggression vanish, as do their retail volumes. Ratios with nothing below are NULL. ``derived`` columns are added first and may be keys.
    """
    rows = rows.withColumns(derived) if derived else rows
    at = F.struct(*TAPE_ORDER)
    kind, q, p = F.col("trade_type"), F.col("quantidade"), F.col("price")
    aggr = is_aggressor(kind)
    q_if = lambda c: F.sum(F.when(c, q).otherwise(0))
    n_if = lambda c: F.sum(F.when(c, 1).otherwise(0))
    b = rows.groupBy(*keys).agg(
        F.min_by(p, F.when(aggr, at)).alias("open"), F.max(F.when(aggr, p)).alias("high"), F.min(F.when(aggr, p)).alias("low"), F.max_by(p, F.when(aggr, at)).alias("close"),
        F.min(F.when(aggr, F.col("ts_ns"))).alias("ts_open"), F.max(F.when(aggr, F.col("ts_ns"))).alias("ts_close"),
        q_if(kind == BUY).alias("vol_compra"), q_if(kind == SELL).alias("vol_venda"), q_if(kind == RETAIL).alias("vol_rlp"),
        n_if(kind == BUY).alias("n_compra"), n_if(kind == SELL).alias("n_venda"), F.sum(F.when(aggr, p * q)).alias("_pq"),
    )
    va, n = F.col("vol_compra") + F.col("vol_venda"), F.col("n_compra") + F.col("n_venda")
    tick = tick if isinstance(tick, Column) else F.lit(tick)
    reach = F.col("high") - F.col("low")
    b = b.where(n > 0)
    moved = F.when(reach > 0, (F.col("close") - F.col("open")) / reach).otherwise(0.0)
    imbalance = (F.col("vol_compra") - F.col("vol_venda")) / va
    return b.select(
        *keys, "open", "high", "low", "close", "ts_open", "ts_close", "vol_compra", "vol_venda", "vol_rlp", n.alias("n_trades"),
        (F.col("_pq") / va).alias("vwap"), imbalance.alias("imbalance"), ((F.col("n_compra") - F.col("n_venda")) / n).alias("tick_imbalance"),
        (va / F.greatest(reach / tick, F.lit(1.0))).alias("absorcao"), moved.alias("desloc_norm"), (imbalance - moved).alias("absorcao_dir"),
        (F.col("vol_rlp") / (F.col("vol_rlp") + va)).alias("rlp_frac"),
    )


def broker_flow(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Signed aggressor flow per broker in long form: the buyer of a trade gains its quantity, the seller loses it."""
    legs = rows.where(is_aggressor(F.col("trade_type"))).select(*keys, F.explode(F.array(F.struct(F.col("agente_comprador").alias("a"), F.col("quantidade").alias("q")), F.struct(F.col("agente_vendedor").alias("a"), (-F.col("quantidade")).alias("q")))).alias("l"))
    return legs.groupBy(*keys, F.col("l.a").alias("agente")).agg(F.sum("l.q").alias("fluxo"), F.sum(F.abs("l.q")).alias("dois_lados"))


def signed_volume() -> Column:
    return F.sum(aggressor_sign(F.col("trade_type")) * F.col("quantidade"))


def effort(volume: Column, reach: Column, tick: Column) -> Column:
    """Contracts per tick of range, without bound; NULL on a flat bar, which is no division but no number either."""
    return F.when(reach > 0, volume / (reach / tick))


def absorption_reading(z_absorption: Column, z_imbalance: Column, limit: float, limit_imbalance: float) -> Column:
    """The colour of a bar: aggression that was absorbed (A) or a move without aggression (B), on either side; ``nao_pintou`` without a score."""
    strong = F.abs(z_imbalance) >= limit_imbalance
    buyers, sellers = z_absorption >= limit, z_absorption <= -limit
    return (
        F.when(buyers & strong & (z_imbalance > 0), "A_compra_absorvida").when(buyers, "B_queda_sem_esforco")
        .when(sellers & strong & (z_imbalance < 0), "A_venda_absorvida").when(sellers, "B_alta_sem_esforco").otherwise("nao_pintou")
    )
