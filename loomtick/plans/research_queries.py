"""Bars, flow, indicators, events, simulations, book, statistics and quality (inventory groups I to S)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators.asof import asof_backward
from ..operators.book import undouble
from ..operators.fold import by_series, ema, greedy_keep, wilder
from ..operators.indicators import bollinger, gains, rsi, sma, stochastic, true_range
from ..operators.labels import excursions, one_at_a_time, resolve_target_stop, triple_barrier, triple_barrier_by_tape
from ..operators.quotes import crossed_episodes, top_of_book, usability
from ..operators.series import fold_series
from ..operators.stats import information_coefficient, quantile_bucket, value_at_risk, walk_forward, welch_t
from ..operators.tape import is_aggressor, local_hhmm, passive_broker
from ..operators.windows import correlation, islands, strict_past_z
from ..sources.tables import table, valid_ts
from .registry import SQL_QUOTES, SQL_SYMBOL, SQL_TAPE, SQL_VALID, Registry, quotes, r6, tape, tape_once
from .tape_queries import _M1W, _P, MINUTE, SQL_HHMM, SQL_M1, SQL_ORD, in_minutes, m1, sql_full, sql_z

R = Registry()
PER_DAY = 20
_AGGR = "CASE WHEN trade_type IN (2, 3) THEN quantidade ELSE 0 END"

SQL_BARS = f"""{SQL_TAPE},
lim AS (SELECT symbol, greatest(floor(round_even(x / pow(10, floor(log10(x)) - 1), 0) * pow(10, floor(log10(x)) - 1) + 1e-9), 1)::bigint AS limite
  FROM (SELECT symbol, greatest(median(v) / {PER_DAY}, 1.0) AS x FROM (SELECT symbol, dt, sum(quantidade) AS v FROM tape WHERE trade_type IN (2, 3) GROUP BY ALL) GROUP BY symbol)),
loc AS (SELECT t.*, (coalesce(sum({_AGGR}) OVER ({SQL_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // limite)::bigint AS l,
    (sum({_AGGR}) OVER (PARTITION BY symbol, dt) // limite)::bigint AS n FROM tape t JOIN lim USING (symbol)),
kept AS (SELECT * FROM loc WHERE l < n),
off AS (SELECT symbol, dt, coalesce(sum(m + 1) OVER (PARTITION BY symbol ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS o,
    coalesce(sum(c) OVER (PARTITION BY symbol ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS oc
  FROM (SELECT symbol, dt, max(l) AS m, max(n) AS c FROM kept GROUP BY ALL)),
barred AS (SELECT k.*, k.l + off.o AS bar_id, k.l + off.oc AS bar_id_total FROM kept k JOIN off USING (symbol, dt))"""


def barred(spark: SparkSession, d: str, offset: str = "last") -> DataFrame:
    """The tape in volume bars of the symbol's own suggested size; ``trades`` is read once."""
    return barred_tape(tape_once(spark, d), offset)


def barred_tape(t: DataFrame, offset: str = "last") -> DataFrame:
    return B.volume_bars(t, None, offset, PER_DAY)


_ORD = "{'a': ts_ns, 'b': ts_recv_ns, 'c': trade_id}"
SQL_FLOW = f"""{SQL_BARS}, tk AS (SELECT {SQL_SYMBOL} AS symbol, tick FROM ativos),
agg AS (SELECT symbol, bar_id, arg_min(price, CASE WHEN trade_type IN (2, 3) THEN {_ORD} END) AS open, max(price) FILTER (WHERE trade_type IN (2, 3)) AS high,
    min(price) FILTER (WHERE trade_type IN (2, 3)) AS low, arg_max(price, CASE WHEN trade_type IN (2, 3) THEN {_ORD} END) AS close,
    min(ts_ns) FILTER (WHERE trade_type IN (2, 3)) AS ts_open, max(ts_ns) FILTER (WHERE trade_type IN (2, 3)) AS ts_close,
    coalesce(sum(quantidade) FILTER (WHERE trade_type = 2), 0)::bigint AS vc, coalesce(sum(quantidade) FILTER (WHERE trade_type = 3), 0)::bigint AS vv,
    coalesce(sum(quantidade) FILTER (WHERE trade_type = 13), 0)::bigint AS vr, count(*) FILTER (WHERE trade_type = 2) AS nc, count(*) FILTER (WHERE trade_type = 3) AS nv,
    sum(price * quantidade) FILTER (WHERE trade_type IN (2, 3)) AS pq FROM barred GROUP BY ALL),
flow AS (SELECT symbol, bar_id, open, high, low, close, ts_open, ts_close, vc AS vol_compra, vv AS vol_venda, vr AS vol_rlp, nc + nv AS n_trades, pq / (vc + vv) AS vwap,
    (vc - vv) / (vc + vv) AS imbalance, (nc - nv) / (nc + nv) AS tick_imbalance, (vc + vv) / greatest((high - low) / tick, 1.0) AS absorcao,
    CASE WHEN high > low THEN (close - open) / (high - low) ELSE 0.0 END AS desloc_norm, vr / (vr + vc + vv) AS rlp_frac
  FROM agg LEFT JOIN tk USING (symbol) WHERE nc + nv > 0)"""


def flow(spark: SparkSession, d: str) -> DataFrame:
    rows = tape_once(spark, d).join(table(spark, d, "ativos", "symbol", "tick"), "symbol", "left")
    return B.flow_bars(rows, PER_DAY, F.col("tick"))


def by_bar() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("bar_id")


# ---- I: bars ---------------------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_BARS} SELECT symbol, dt, trade_id, bar_id FROM barred")
def i01b_volume_bars(spark, d):
    return barred(spark, d).select("symbol", "dt", "trade_id", "bar_id")


@R.add(f"WITH {SQL_BARS} SELECT symbol, dt, bar_id_total AS bar_id, count(*) AS n FROM barred GROUP BY ALL")
def i01_volume_bars_completed(spark, d):
    return barred(spark, d, "completed").groupBy("symbol", "dt", "bar_id").agg(F.count(F.lit(1)).alias("n"))


@R.add(f"WITH {SQL_BARS} SELECT symbol, limite FROM lim")
def i02_threshold(spark, d):
    return B.suggest_threshold(tape(spark, d), PER_DAY).select("symbol", "limite")


_P5 = 5 * MINUTE
SQL_TB = f"""{SQL_TAPE}, b AS (SELECT *, ts_ns // {_P5} AS k FROM tape), c AS (SELECT * FROM b QUALIFY k < max(k) OVER (PARTITION BY symbol, dt)),
o AS (SELECT symbol, dt, f, coalesce(sum(s) OVER (PARTITION BY symbol ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS o
  FROM (SELECT symbol, dt, min(k) AS f, max(k) - min(k) + 1 AS s FROM c GROUP BY ALL)),
tb AS (SELECT c.*, k - f + o AS bar_id FROM c JOIN o USING (symbol, dt))"""


@R.add(f"WITH {SQL_TB} SELECT symbol, dt, bar_id, arg_min(price, {_ORD}) AS open, max(price) AS high, min(price) AS low, arg_max(price, {_ORD}) AS close, sum(quantidade)::bigint AS volume FROM tb WHERE trade_type IN (2, 3) GROUP BY ALL")
def i03_time_bars(spark, d):
    return B.ohlc(B.time_bars(tape_once(spark, d), _P5), ["symbol", "dt", "bar_id"]).select("symbol", "dt", "bar_id", "open", "high", "low", "close", "volume")


_FOLD = 20 * 3600 * 1_000_000_000  # 17:00 local


@R.add(f"WITH {SQL_TAPE}, l AS (SELECT *, max(CASE WHEN ts_ns % 86400000000000 < {_FOLD} THEN ts_ns // {_P5} END) OVER (PARTITION BY symbol, dt) AS ult, coalesce(ts_ns - lag(ts_ns) OVER ({SQL_ORD}) <= 5000000000, true) AS g FROM tape), b AS (SELECT *, CASE WHEN ts_ns % 86400000000000 < {_FOLD} THEN ts_ns // {_P5} ELSE coalesce(ult, ts_ns // {_P5}) END AS bucket FROM l) SELECT symbol, dt, bucket, count(*) AS n, sum(quantidade)::bigint AS volume, bool_and(g) AS volume_confiavel FROM b GROUP BY ALL")
def i04_session_bars(spark, d):
    rows = B.session_bars(tape_once(spark, d), _P5, _FOLD)
    return rows.groupBy("symbol", "dt", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("quantidade").alias("volume"), F.bool_and("gap_ok").alias("volume_confiavel"))


@R.add(f"WITH {SQL_TAPE}, s AS (SELECT symbol, dt, ts_ns // 15000000000 AS k, arg_min(price, {_ORD}) AS open, max(price) AS high, min(price) AS low, arg_max(price, {_ORD}) AS close, sum(quantidade)::bigint AS volume FROM tape WHERE trade_type IN (2, 3, 13) GROUP BY ALL) SELECT symbol, dt, k * 15 // 360 AS bucket, arg_min(open, k) AS open, max(high) AS high, min(low) AS low, arg_max(close, k) AS close, sum(volume)::bigint AS volume, count(*) AS filhas FROM s GROUP BY symbol, dt, k * 15 // 360")
def i06_roll_up(spark, d):
    """15-second bars of a chosen set of trade types, rolled up to 6 minutes."""
    rows = tape(spark, d).where("trade_type in (2, 3, 13)").withColumn("k", F.expr("ts_ns div 15000000000"))
    fine = B.ohlc(rows, ["symbol", "dt", "k"], only_aggressors=False).withColumn("at", F.col("k") * 15)
    return B.roll_up(fine, ["symbol", "dt"], 360, "at")


@R.add(f"WITH {SQL_M1} SELECT symbol, dt, minuto, round(ln(close / lag(close) OVER ({_M1W})), 9) + 0.0 AS retorno FROM m1")
def i08_log_returns(spark, d):
    return m1(spark, d).select("symbol", "dt", "minuto", r6(F.log(F.col("close") / F.lag("close").over(in_minutes())), 9).alias("retorno"))


@R.add(f"WITH {SQL_TAPE}, h AS (SELECT symbol, dt, {SQL_HHMM} // 100 * 100 + CASE WHEN {SQL_HHMM} % 100 >= 30 THEN 30 ELSE 0 END AS faixa, sum(quantidade) AS v FROM tape GROUP BY ALL), p AS (SELECT *, v / sum(v) OVER (PARTITION BY symbol, dt) AS parte FROM h) SELECT symbol, faixa, printf('%02d:%02d', faixa // 100, faixa % 100) AS hora, round(median(v), 6) AS contratos, round(median(parte), 6) AS parte FROM p GROUP BY ALL")
def i10_half_hour_profile(spark, d):
    hhmm = local_hhmm(F.col("ts_ns"))
    slot = F.floor(hhmm / 100) * 100 + F.when(F.pmod(hhmm, F.lit(100)) >= 30, 30).otherwise(0)
    h = tape(spark, d).groupBy("symbol", "dt", slot.cast("bigint").alias("faixa")).agg(F.sum("quantidade").alias("v"))
    h = h.withColumn("parte", F.col("v") / F.sum("v").over(Window.partitionBy("symbol", "dt")))
    label = F.format_string("%02d:%02d", F.floor(F.col("faixa") / 100), F.pmod("faixa", F.lit(100)))
    return h.groupBy("symbol", "faixa").agg(F.first(label).alias("hora"), r6(F.median("v")).alias("contratos"), r6(F.median("parte")).alias("parte"))


_BIN = 0.5
SQL_PROFILE = f"{SQL_TAPE}, pf AS (SELECT symbol, dt, floor(price / {_BIN}) * {_BIN} AS faixa, sum(quantidade)::bigint AS volume, sum(CASE WHEN trade_type = 2 THEN quantidade ELSE 0 END)::bigint AS compra, sum(CASE WHEN trade_type = 3 THEN quantidade ELSE 0 END)::bigint AS venda, sum(CASE WHEN trade_type = 13 THEN quantidade ELSE 0 END)::bigint AS varejo, sum(CASE WHEN trade_type = 4 THEN quantidade ELSE 0 END)::bigint AS leilao FROM tape GROUP BY ALL)"


def profile(spark, d):
    return B.price_profile(tape(spark, d), ["symbol", "dt"], _BIN)


@R.add(f"WITH {SQL_PROFILE} SELECT * FROM pf")
def i11_price_profile(spark, d):
    return profile(spark, d)


@R.add(f"WITH {SQL_PROFILE}, m AS (SELECT *, (min(faixa) OVER w + max(faixa) OVER w) / 2 AS c, max(volume) OVER w AS v FROM pf WINDOW w AS (PARTITION BY symbol, dt)) SELECT symbol, dt, arg_max(faixa, {{'a': volume, 'b': -abs(faixa - c), 'c': -faixa}}) AS poc, max(volume) AS volume, min(CASE WHEN volume >= 0.9 * v THEN faixa END) AS plato_de, max(CASE WHEN volume >= 0.9 * v THEN faixa END) AS plato_ate FROM m GROUP BY ALL")
def i12_point_of_control(spark, d):
    return B.point_of_control(profile(spark, d), ["symbol", "dt"])


def _area_sql(step: int) -> str:
    below, above = f"list_sum(v[greatest(lo - {step}, 1):lo - 1])", f"list_sum(v[hi + 1:least(hi + {step}, len(v))])"
    up = f"hi < len(v) AND (lo <= 1 OR {above} >= {below})"
    return f"""WITH RECURSIVE {SQL_PROFILE}, c AS (SELECT *, (min(faixa) OVER w + max(faixa) OVER w) / 2 AS c FROM pf WINDOW w AS (PARTITION BY symbol, dt)),
b AS (SELECT symbol, dt, arg_max(faixa, {{'a': volume, 'b': -abs(faixa - c), 'c': -faixa}}) AS poc, list(faixa ORDER BY faixa) AS f, list(volume ORDER BY faixa) AS v FROM c GROUP BY ALL),
r AS (SELECT symbol, dt, poc, f, v, list_position(f, poc)::bigint AS lo, list_position(f, poc)::bigint AS hi, v[list_position(f, poc)]::hugeint AS got, 0 AS i FROM b
  UNION ALL SELECT symbol, dt, poc, f, v, CASE WHEN {up} THEN lo ELSE greatest(lo - {step}, 1) END, CASE WHEN {up} THEN least(hi + {step}, len(v)) ELSE hi END, got + CASE WHEN {up} THEN {above} ELSE {below} END, i + 1
  FROM r WHERE got::double < 0.7::double * list_sum(v)::double AND (lo > 1 OR hi < len(v)))
SELECT symbol, dt, poc, f[lo] AS de, f[hi] + {_BIN} AS ate, got::double AS dentro, list_sum(v)::double AS total FROM r QUALIFY row_number() OVER (PARTITION BY symbol, dt ORDER BY i DESC) = 1"""


@R.add(_area_sql(1))
def i13_value_area(spark, d):
    """One filled bin at a time."""
    return B.value_area(profile(spark, d), ["symbol", "dt"], _BIN)


@R.add(_area_sql(2))
def i13b_value_area_pairs(spark, d):
    """Two filled bins at a time, by the sums of both."""
    return B.value_area(profile(spark, d), ["symbol", "dt"], _BIN, mode="pares")


@R.add(f"""WITH {SQL_PROFILE}, k AS (SELECT symbol, dt, round(faixa / {_BIN})::bigint AS k, volume, round(min(faixa) OVER w / {_BIN})::bigint AS lo, round(max(faixa) OVER w / {_BIN})::bigint AS hi, max(volume) OVER w AS topo FROM pf WINDOW w AS (PARTITION BY symbol, dt) QUALIFY count(*) OVER w >= 3),
c AS (SELECT DISTINCT symbol, dt, k + o AS k, lo, hi, topo FROM k, (SELECT unnest([-2, -1, 0, 1, 2]) AS o) WHERE k + o BETWEEN lo AND hi),
n AS (SELECT c.symbol, c.dt, c.k, c.topo, coalesce(max(v.volume) FILTER (WHERE v.k = c.k), 0)::bigint AS volume, coalesce(max(v.volume) FILTER (WHERE v.k = c.k - 1), 0) AS antes, coalesce(max(v.volume) FILTER (WHERE v.k = c.k + 1), 0) AS depois,
    coalesce(sum(v.volume) FILTER (WHERE v.k <> c.k), 0)::double / (least(c.k - c.lo, 2) + least(c.hi - c.k, 2)) AS media FROM c LEFT JOIN k v ON v.symbol = c.symbol AND v.dt = c.dt AND v.k BETWEEN c.k - 2 AND c.k + 2 GROUP BY c.symbol, c.dt, c.k, c.topo, c.lo, c.hi),
q AS (SELECT *, CASE WHEN media > 0 AND volume < 0.3::double * media THEN 'lvn' WHEN volume > 0 AND volume >= antes AND volume >= depois AND volume >= 0.5::double * topo THEN 'hvn' END AS no FROM n)
SELECT symbol, dt, k * {_BIN} AS faixa, volume, no FROM q WHERE no IS NOT NULL""")
def i14_volume_nodes(spark, d):
    return B.volume_nodes(profile(spark, d), ["symbol", "dt"], _BIN)


@R.add(f"WITH {SQL_M1}, g AS (SELECT symbol, dt, lead(minuto) OVER ({_M1W}) - minuto - 1 AS f, high - low AS a FROM m1) SELECT symbol, dt, coalesce(sum(f), 0)::bigint AS buracos, round(median(a), 6) AS faixa_mediana FROM g GROUP BY ALL")
def i15_holes(spark, d):
    rows = m1(spark, d).withColumn("f", F.lead("minuto").over(in_minutes()) - F.col("minuto") - 1)
    return rows.groupBy("symbol", "dt").agg(F.coalesce(F.sum("f"), F.lit(0)).alias("buracos"), r6(F.median(F.col("high") - F.col("low"))).alias("faixa_mediana"))


@R.add(f"WITH {SQL_TAPE}, s AS (SELECT symbol, dt, abs(price - lag(price) OVER ({SQL_ORD})) AS s FROM tape WHERE trade_type IN (2, 3)), m AS (SELECT symbol, dt, min(s) AS s FROM s WHERE s > 1e-9 GROUP BY ALL) SELECT symbol, round(median(s), 6) AS tick FROM m GROUP BY symbol")
def i16_tick(spark, d):
    return B.infer_tick(tape_once(spark, d)).select("symbol", r6("tick").alias("tick"))


# ---- J: flow features and labels -------------------------------------------------------------------------------------

_FLOW_COLS = ("open", "high", "low", "close", "ts_open", "ts_close", "vol_compra", "vol_venda", "vol_rlp", "n_trades")


@R.add(f"WITH {SQL_FLOW} SELECT symbol, bar_id, {', '.join(_FLOW_COLS)}, round(vwap, 6) AS vwap, round(imbalance, 6) AS imbalance, round(tick_imbalance, 6) AS tick_imbalance, round(absorcao, 4) AS absorcao, round(desloc_norm, 6) + 0.0 AS desloc_norm, round(imbalance - desloc_norm, 6) + 0.0 AS absorcao_dir, round(rlp_frac, 6) AS rlp_frac FROM flow")
def j01_flow_bars(spark, d):
    digits = {"vwap": 6, "imbalance": 6, "tick_imbalance": 6, "absorcao": 4, "desloc_norm": 6, "absorcao_dir": 6, "rlp_frac": 6}
    return flow(spark, d).select("symbol", "bar_id", *_FLOW_COLS, *(r6(c, n).alias(c) for c, n in digits.items()))


@R.add(f"WITH {SQL_FLOW} SELECT symbol, bar_id, round(imbalance, 6) AS imbalance, round({sql_z('imbalance', 'PARTITION BY symbol ORDER BY bar_id', 20, 10)}, 5) + 0.0 AS z_imbalance, round({sql_z('rlp_frac', 'PARTITION BY symbol ORDER BY bar_id', 20, 10)}, 5) + 0.0 AS z_rlp_frac FROM flow")
def j07_flow_z(spark, d):
    """The flagship: curated tape → volume bars → flow → strictly past z-scores, continuous across days."""
    z = lambda c: r6(strict_past_z(F.col(c), by_bar(), 20), 5).alias(f"z_{c}")
    return flow(spark, d).select("symbol", "bar_id", r6("imbalance").alias("imbalance"), z("imbalance"), z("rlp_frac"))


@R.add(f"WITH {SQL_BARS}, tv AS (SELECT symbol, agente, sum(q) AS q FROM (SELECT symbol, agente_comprador AS agente, quantidade AS q FROM tape WHERE trade_type IN (2, 3) UNION ALL SELECT symbol, agente_vendedor, quantidade FROM tape WHERE trade_type IN (2, 3)) GROUP BY ALL), top AS (SELECT symbol, agente FROM tv QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY q DESC, agente) <= 3), l AS (SELECT symbol, bar_id, agente_comprador AS agente, quantidade AS q FROM barred WHERE trade_type IN (2, 3) UNION ALL SELECT symbol, bar_id, agente_vendedor, -quantidade FROM barred WHERE trade_type IN (2, 3)), va AS (SELECT symbol, bar_id, sum(quantidade) AS va FROM barred WHERE trade_type IN (2, 3) GROUP BY ALL) SELECT l.symbol, l.bar_id, l.agente, round(sum(q) / any_value(va), 6) + 0.0 AS agf FROM l JOIN top USING (symbol, agente) JOIN va USING (symbol, bar_id) GROUP BY ALL")
def j06_broker_features(spark, d):
    """Signed flow over aggressor volume of the three largest brokers of a symbol, in long form."""
    t = tape_once(spark, d)
    rows, whole = barred_tape(t), B.broker_flow(t, ["symbol"])
    top = whole.withColumn("_r", F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("dois_lados"), "agente"))).where("_r <= 3").select("symbol", "agente")
    va = rows.where(is_aggressor(F.col("trade_type"))).groupBy("symbol", "bar_id").agg(F.sum("quantidade").alias("va"))
    per = B.broker_flow(rows, ["symbol", "bar_id"]).join(top, ["symbol", "agente"]).join(va, ["symbol", "bar_id"])
    return per.select("symbol", "bar_id", "agente", r6(F.col("fluxo") / F.col("va")).alias("agf"))


@R.add(f"WITH {SQL_M1}, x AS (SELECT *, CASE WHEN high > low THEN (close - open) / (high - low) ELSE 0.0 END AS d FROM m1), dia AS (SELECT symbol, dt, arg_min(open, minuto) AS o, arg_max(close, minuto) AS c, max(high) AS h, min(low) AS l FROM m1 GROUP BY ALL), s AS (SELECT symbol, dt, CASE WHEN h > l THEN abs(c - o) / (h - l) END AS direcao FROM dia) SELECT symbol, dt, round(direcao, 6) AS direcao FROM s")
def j15_day_shape(spark, d):
    day = m1(spark, d).groupBy("symbol", "dt").agg(F.min_by("open", "minuto").alias("o"), F.max_by("close", "minuto").alias("c"), F.max("high").alias("h"), F.min("low").alias("l"))
    return day.select("symbol", "dt", r6(F.when(F.col("h") > F.col("l"), F.abs(F.col("c") - F.col("o")) / (F.col("h") - F.col("l")))).alias("direcao"))


_CORES = (1.75, 1.0)
_Z20 = lambda c: sql_z(c, "PARTITION BY symbol ORDER BY bar_id", 20, 10)


@R.add(f"""WITH {SQL_FLOW}, ft AS (SELECT * FROM flow JOIN tk USING (symbol)), z AS (SELECT symbol, bar_id, (vol_compra + vol_venda) / nullif((high - low) / tick, 0) AS esforco, {_Z20('imbalance - desloc_norm')} AS za, {_Z20('imbalance')} AS zi FROM ft),
r AS (SELECT symbol, bar_id, round(esforco, 4) AS esforco, round(za, 5) AS a, round(zi, 5) AS i FROM z)
SELECT symbol, bar_id, esforco, CASE WHEN a >= {_CORES[0]} AND i >= {_CORES[1]} THEN 'A_compra_absorvida' WHEN a >= {_CORES[0]} THEN 'B_queda_sem_esforco' WHEN a <= -{_CORES[0]} AND i <= -{_CORES[1]} THEN 'A_venda_absorvida' WHEN a <= -{_CORES[0]} THEN 'B_alta_sem_esforco' ELSE 'nao_pintou' END AS leitura FROM r""")
def j10_effort_reading(spark, d):
    """Aggressor contracts per tick of range (NULL on flat bars), and the reading by the strictly past scores of directed absorption and imbalance."""
    z = lambda c: F.round(strict_past_z(F.col(c), by_bar(), 20), 5)
    rows = flow(spark, d).join(table(spark, d, "ativos", "symbol", "tick"), "symbol").withColumns({"a": z("absorcao_dir"), "i": z("imbalance")})
    return rows.select("symbol", "bar_id", r6(B.effort(F.col("vol_compra") + F.col("vol_venda"), F.col("high") - F.col("low"), F.col("tick")), 4).alias("esforco"), B.absorption_reading(F.col("a"), F.col("i"), *_CORES).alias("leitura"))


def sql_barrier(by: str, h: int) -> str:
    return f"""{SQL_M1}, rr AS (SELECT *, ln(close / lag(close) OVER ({by})) AS r FROM m1),
sg AS (SELECT *, CASE WHEN count(r) OVER w >= 10 THEN stddev_samp(r) OVER w END AS sigma, row_number() OVER ({by}) AS i FROM rr WINDOW w AS ({by} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))"""


def _barrier_sql(keys: str, by: str) -> str:
    on = " AND ".join(f"f.{k} = s.{k}" for k in keys.split(", "))
    return f"""WITH {sql_barrier(by, 10)}, hits AS (SELECT s.symbol, s.minuto, arg_min(CASE WHEN f.high >= s.close * (1 + 2.0 * s.sigma) AND f.low <= s.close * (1 - 2.0 * s.sigma) THEN 0 WHEN f.high >= s.close * (1 + 2.0 * s.sigma) THEN 1 ELSE -1 END, f.i) AS rotulo
  FROM sg s JOIN sg f ON {on} AND f.i BETWEEN s.i + 1 AND s.i + 10 WHERE s.sigma IS NOT NULL AND (f.high >= s.close * (1 + 2.0 * s.sigma) OR f.low <= s.close * (1 - 2.0 * s.sigma)) GROUP BY ALL)
SELECT s.symbol, s.dt, s.minuto, CASE WHEN s.sigma IS NULL THEN NULL ELSE coalesce(h.rotulo, 0) END::bigint AS rotulo FROM sg s LEFT JOIN hits h ON h.symbol = s.symbol AND h.minuto = s.minuto"""


@R.add(_barrier_sql("symbol", "PARTITION BY symbol ORDER BY minuto"))
def j11_triple_barrier(spark, d):
    """Barriers at two deviations within ten bars; the series runs on over days."""
    return triple_barrier(m1(spark, d), ["symbol"], "minuto", 2.0, 10, 20, 10).select("symbol", "dt", "minuto", "rotulo")


@R.add(f"""WITH {SQL_M1}, rr AS (SELECT *, ln(close / lag(close) OVER ({_M1W})) AS r FROM m1),
sg AS (SELECT *, CASE WHEN count(r) OVER w >= 10 THEN stddev_samp(r) OVER w END AS sigma, row_number() OVER ({_M1W}) AS i, count(*) OVER (PARTITION BY symbol, dt) AS n FROM rr WINDOW w AS ({_M1W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
bar AS (SELECT *, close * exp(2.0 * sigma) AS u, close * exp(-2.0 * sigma) AS l FROM sg WHERE sigma > 0 AND i + 10 <= n),
hit AS (SELECT s.symbol, s.dt, s.minuto, any_value(s.u) AS u, any_value(s.l) AS l, min({{'i': f.i, 'm': f.minuto, 'cima': f.high >= s.u, 'baixo': f.low <= s.l}}) AS h FROM bar s JOIN sg f ON f.symbol = s.symbol AND f.dt = s.dt AND f.i BETWEEN s.i + 1 AND s.i + 10 WHERE f.high >= s.u OR f.low <= s.l GROUP BY ALL),
tie AS (SELECT h.symbol, h.dt, h.minuto, arg_min(t.price >= h.u, {_ORD}) AS cima FROM hit h JOIN tape t ON t.symbol = h.symbol AND t.dt = h.dt AND t.ts_ns // {MINUTE} = h.h['m'] WHERE h.h['cima'] AND h.h['baixo'] AND t.trade_type IN (2, 3) AND (t.price >= h.u OR t.price <= h.l) GROUP BY ALL)
SELECT sg.symbol, sg.dt, sg.minuto, CASE WHEN bar.minuto IS NULL THEN NULL WHEN hit.h IS NULL THEN 0 WHEN hit.h['cima'] AND hit.h['baixo'] THEN CASE WHEN tie.cima THEN 1 WHEN NOT tie.cima THEN -1 ELSE 0 END WHEN hit.h['cima'] THEN 1 ELSE -1 END::bigint AS rotulo,
  coalesce(hit.h['cima'] AND hit.h['baixo'], false) AS desempatado FROM sg LEFT JOIN bar USING (symbol, dt, minuto) LEFT JOIN hit USING (symbol, dt, minuto) LEFT JOIN tie USING (symbol, dt, minuto)""")
def j12_triple_barrier_in_day(spark, d):
    """Barriers inside the day: no label where the day ends first, and where one bar touches both sides the first aggressor trade in it decides."""
    t = tape(spark, d).where(is_aggressor(F.col("trade_type"))).withColumn("minuto", F.expr(f"ts_ns div {MINUTE}"))
    return triple_barrier_by_tape(m1(spark, d), t, ["symbol", "dt"], "minuto", 2.0, 10, 20, 10).select("symbol", "dt", "minuto", "rotulo", "desempatado")


# ---- K: indicators ---------------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_M1}, t AS (SELECT *, CASE WHEN lag(close) OVER ({_M1W}) IS NOT NULL THEN greatest(high - low, abs(high - lag(close) OVER ({_M1W})), abs(low - lag(close) OVER ({_M1W}))) END AS tr FROM m1) SELECT symbol, dt, minuto, round(tr, 6) AS tr, round({sql_full('avg(tr)', 'tr', _M1W, '13 PRECEDING', 'CURRENT ROW', 14)}, 6) AS atr, round({sql_full('avg(close)', 'close', _M1W, '20 PRECEDING', 'CURRENT ROW', 21)} + 2.0 * {sql_full('stddev_pop(close)', 'close', _M1W, '20 PRECEDING', 'CURRENT ROW', 21)}, 5) AS banda, round(100.0 * (close - {sql_full('min(low)', 'low', _M1W, '13 PRECEDING', 'CURRENT ROW', 14)}) / nullif({sql_full('max(high)', 'high', _M1W, '13 PRECEDING', 'CURRENT ROW', 14)} - {sql_full('min(low)', 'low', _M1W, '13 PRECEDING', 'CURRENT ROW', 14)}, 0), 5) AS estocastico FROM t")
def k03_ranges_and_bands(spark, d):
    b = m1(spark, d).withColumn("tr", true_range(F.col("high"), F.col("low"), F.col("close"), in_minutes()))
    return b.select("symbol", "dt", "minuto", r6("tr").alias("tr"), r6(sma(F.col("tr"), in_minutes(), 14)).alias("atr"), r6(bollinger(F.col("close"), in_minutes())[2], 5).alias("banda"), r6(stochastic(F.col("high"), F.col("low"), F.col("close"), in_minutes()), 5).alias("estocastico"))


@R.add(f"""WITH RECURSIVE {SQL_M1}, s AS (SELECT symbol, dt, minuto, close, close - lag(close) OVER ({_M1W}) AS dif, row_number() OVER ({_M1W}) AS i FROM m1),
g AS (SELECT *, greatest(dif, 0) AS g, greatest(-dif, 0) AS p FROM s),
seed AS (SELECT symbol, dt, avg(g) AS ag, avg(p) AS ap FROM g WHERE i BETWEEN 2 AND 3 GROUP BY ALL HAVING count(*) = 2),
rec AS (SELECT symbol, dt, 3::bigint AS i, ag, ap FROM seed UNION ALL SELECT r.symbol, r.dt, r.i + 1, (r.ag + g.g) / 2, (r.ap + g.p) / 2 FROM rec r JOIN g ON g.symbol = r.symbol AND g.dt = r.dt AND g.i = r.i + 1),
em AS (SELECT symbol, dt, i, close AS e FROM g WHERE i = 1 UNION ALL SELECT m.symbol, m.dt, m.i + 1, 2.0 / 9 * g.close + (1 - 2.0 / 9) * m.e FROM em m JOIN g ON g.symbol = m.symbol AND g.dt = m.dt AND g.i = m.i + 1)
SELECT g.symbol, g.dt, g.minuto, round(em.e, 5) AS ema, round(CASE WHEN ap IS NULL THEN NULL WHEN ap = 0 AND ag = 0 THEN 50.0 WHEN ap = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1 + ag / ap) END, 2) AS rsi
FROM g JOIN em USING (symbol, dt, i) LEFT JOIN rec USING (symbol, dt, i)""")
def k01_rsi_ema(spark, d):
    """RSI(2) after Wilder and EMA(8) seeded by the first close: folds over the day's ordered bars."""
    bars = m1(spark, d).select("symbol", "dt", "minuto", "close")
    out = by_series(bars, ["symbol", "dt"], "minuto", "close", {"ema": ema(2 / 9), "g": lambda v: wilder(2)(gains(v)), "p": lambda v: wilder(2)(gains(-v))})
    return out.select("symbol", "dt", "minuto", r6("ema", 5).alias("ema"), r6(rsi(F.col("g"), F.col("p")), 2).alias("rsi"))


# ---- L: events -------------------------------------------------------------------------------------------------------

_JUMP = "j AS (SELECT symbol, dt, minuto, round(close - lag(close) OVER ({w}), 6) AS salto, (close - lag(close) OVER ({w})) / lag(close) OVER ({w}) AS rel FROM m1)".format(w=_M1W)


def jumps(spark, d):
    before = F.lag("close").over(in_minutes())
    return m1(spark, d).select("symbol", "dt", "minuto", r6(F.col("close") - before).alias("salto"), ((F.col("close") - before) / before).alias("rel"))


@R.add(f"""WITH RECURSIVE {SQL_M1}, {_JUMP}, e AS (SELECT *, row_number() OVER (PARTITION BY symbol, dt ORDER BY minuto) AS i FROM j WHERE abs(rel) >= 0.0003),
r AS (SELECT symbol, dt, minuto, salto, minuto AS ult, true AS fica, i FROM e WHERE i = 1
  UNION ALL SELECT e.symbol, e.dt, e.minuto, e.salto, CASE WHEN e.minuto - r.ult >= 10 THEN e.minuto ELSE r.ult END, e.minuto - r.ult >= 10, e.i FROM r JOIN e ON e.symbol = r.symbol AND e.dt = r.dt AND e.i = r.i + 1)
SELECT symbol, dt, minuto, salto FROM r WHERE fica""")
def l01_ignitions(spark, d):
    """Bars that jump by at least 0.03 %, with ten minutes of rest after each kept one."""
    e = jumps(spark, d).where(F.abs("rel") >= 0.0003).drop("rel")
    return greedy_keep(e, ["symbol", "dt"], "minuto", 10)


@R.add(f"""WITH RECURSIVE {SQL_TAPE}, {_P}, c AS (SELECT symbol, dt, ts_ns, ts_recv_ns, trade_id, price, ts_ns - {MINUTE} AS antes FROM tape),
e AS (SELECT c.symbol, c.dt, c.ts_ns, arg_min({{'trade_id': c.trade_id, 'price': c.price, 'mov': round(c.price - p.w['p'], 6)}}, {{'a': c.ts_recv_ns, 'b': c.trade_id}}) AS x
  FROM c ASOF JOIN p ON c.symbol = p.symbol AND c.dt = p.dt AND c.antes >= p.ts_ns WHERE abs(c.price - p.w['p']) >= 0.0003 * p.w['p'] - 1e-9 GROUP BY ALL),
r AS (SELECT symbol, dt, min(ts_ns) AS ts_ns FROM e GROUP BY ALL UNION ALL SELECT r.symbol, r.dt, min(e.ts_ns) FROM r JOIN e ON e.symbol = r.symbol AND e.dt = r.dt AND e.ts_ns >= r.ts_ns + {10 * MINUTE} GROUP BY r.symbol, r.dt)
SELECT symbol, dt, ts_ns, e.x['trade_id'] AS trade_id, e.x['price'] AS price, e.x['mov'] AS movimento FROM r JOIN e USING (symbol, dt, ts_ns)""")
def l01b_trade_ignitions(spark, d):
    """Trades at least 0.03 % away from the price as of a minute before, with ten minutes of rest after each kept one.

    The whole of L1: l01_ignitions looks at closes of existing bars only.
    """
    return ignitions(tape_once(spark, d))


def ignitions(t: DataFrame, window_ns: int = MINUTE, limit: float = 0.0003, gap_ns: int = 10 * MINUTE) -> DataFrame:
    probe = t.select("symbol", "dt", "trade_id", "ts_recv_ns", "price", F.col("ts_ns").alias("em"), (F.col("ts_ns") - window_ns).alias("ts_ns"))
    path = t.select("symbol", "dt", "ts_ns", "ts_recv_ns", F.col("trade_id").alias("_id"), F.col("price").alias("antes"))
    e = asof_backward(probe, path, ["symbol", "dt"], "ts_ns", ["antes"], tie=["ts_recv_ns", "_id"], slice_size=B.SLICE_NS)
    e = e.where(F.abs(F.col("price") - F.col("antes")) >= limit * F.col("antes") - 1e-9).drop("ts_ns").withColumnRenamed("em", "ts_ns")
    e = e.select("symbol", "dt", "ts_ns", "ts_recv_ns", "trade_id", "price", r6(F.col("price") - F.col("antes")).alias("movimento"))
    return greedy_keep(e, ["symbol", "dt"], "ts_ns", gap_ns, ["ts_recv_ns", "trade_id"]).drop("ts_recv_ns")


@R.add(f"WITH {SQL_M1}, x AS (SELECT *, lag(high, 1) OVER w AS h1, lag(low, 1) OVER w AS l1, lag(low, 2) OVER w AS l2, lead(high) OVER w AS hn FROM m1 WINDOW w AS ({_M1W})) SELECT symbol, dt, minuto, high AS gatilho, hn > high AS acionou FROM x WHERE l1 < l2 AND l1 < low AND hn IS NOT NULL")
def l09_reversal_123(spark, d):
    """Three bars with the lowest low in the middle; triggered if the next bar passes the last high."""
    h, low = F.col("high"), F.col("low")
    l1, l2, nxt = F.lag("low", 1).over(in_minutes()), F.lag("low", 2).over(in_minutes()), F.lead("high").over(in_minutes())
    rows = m1(spark, d).withColumns({"_p": (l1 < l2) & (l1 < low), "_n": nxt})
    return rows.where("_p and _n is not null").select("symbol", "dt", "minuto", h.alias("gatilho"), (F.col("_n") > h).alias("acionou"))


@R.add(f"""WITH RECURSIVE {SQL_M1}, b AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY dt, minuto) AS i FROM m1),
em AS (SELECT symbol, i, close AS ema FROM b WHERE i = 1 UNION ALL SELECT em.symbol, b.i, 2.0 / 81 * b.close + (1 - 2.0 / 81) * em.ema FROM em JOIN b ON b.symbol = em.symbol AND b.i = em.i + 1),
x AS (SELECT b.*, round(ema, 5) AS e, lag(high, 1) OVER w AS h1, lag(high, 2) OVER w AS h2, lag(low, 1) OVER w AS l1, lag(low, 2) OVER w AS l2, lead(high) OVER w AS hn, lead(low) OVER w AS ln FROM b JOIN em USING (symbol, i) WINDOW w AS ({_M1W}))
SELECT symbol, dt, minuto, 'compra' AS lado, high AS gatilho, e AS ema_80, close > e AS regime_ok, coalesce(hn > high, false) AS acionou FROM x WHERE l1 < l2 AND l1 < low
UNION ALL SELECT symbol, dt, minuto, 'venda', low, e, close < e, coalesce(ln < low, false) FROM x WHERE h1 > h2 AND h1 > high""")
def l09b_reversal_123_sides(spark, d):
    """The 123 on both sides: the lowest low (or highest high) in the middle of three bars of a day, whether the close is on the
    right side of the 80-bar average, and whether the next bar of the day passes the trigger.

    The whole of L9: l09_reversal_123 has buys only, without the regime and without a day's last bar.
    """
    return reversals_123(m1(spark, d))


def reversals_123(bars: DataFrame, n: int = 80) -> DataFrame:
    h, low, c = F.col("high"), F.col("low"), F.col("close")
    x = bars.select("symbol", "dt", "minuto", "high", "low", *(f(v, k).over(in_minutes()).alias(f"_{v[0]}{k}{s}") for v in ("high", "low") for f, k, s in ((F.lag, 1, ""), (F.lag, 2, ""), (F.lead, 1, "n"))))
    side = lambda name, at, regime, after: F.struct(F.lit(name).alias("lado"), at.alias("gatilho"), regime.alias("regime_ok"), F.coalesce(after, F.lit(False)).alias("acionou"))
    buy, sell = F.expr("_l1 < _l2 and _l1 < low"), F.expr("_h1 > _h2 and _h1 > high")
    x = x.join(carried_ema(bars, n), ["symbol", "dt", "minuto"]).withColumn("ema_80", r6("ema", 5))
    sides = F.array(F.when(buy, side("compra", h, c > F.col("ema_80"), F.col("_h1n") > h)), F.when(sell, side("venda", low, c < F.col("ema_80"), F.col("_l1n") < low)))
    x = x.where(buy | sell).withColumn("_s", F.explode(F.filter(sides, lambda s: s.isNotNull())))
    return x.select("symbol", "dt", "minuto", "_s.lado", "_s.gatilho", "ema_80", "_s.regime_ok", "_s.acionou")


def carried_ema(bars: DataFrame, n: int) -> DataFrame:
    """The average of n bars' span over all of a symbol's days, seeded by its first close.

    Each day is folded alone from 0; what the days before left over decays by (1 − α) a bar, so only one number a day is
    carried on.
    """
    a = 2 / (n + 1)
    own = by_series(bars, ["symbol", "dt"], "minuto", "close", {"_own": ema(a, 0.0)}).withColumn("_n", F.row_number().over(in_minutes()))
    day = own.groupBy("symbol", "dt").agg(F.max("_n").alias("n"), F.max_by("_own", "_n").alias("end"), F.min_by("close", "_n").alias("first"))
    starts = fold_series(day, ["symbol"], ["dt"], ["n", "end", "first"], lambda k, end, first: {"_start": _carried(k, end, first, 1 - a)}, "_start double").select("symbol", "dt", "_start")
    return own.join(starts, ["symbol", "dt"]).select("symbol", "dt", "minuto", "close", (F.pow(F.lit(1 - a), F.col("_n")) * F.col("_start") + F.col("_own")).alias("ema"))


def _carried(bars: np.ndarray, end: np.ndarray, first: np.ndarray, left: float) -> np.ndarray:
    """The average that each day starts from: what the day before started from, decayed over its bars, and that day's own part."""
    at, out = float(first[0]), np.empty(len(bars))
    for i, (k, e) in enumerate(zip(bars.tolist(), end.tolist())):
        out[i] = at
        at = left**k * at + e
    return out


@R.add(f"WITH {SQL_M1}, a AS (SELECT symbol, dt, min(minuto) AS m0 FROM m1 GROUP BY ALL), ab AS (SELECT m1.symbol, m1.dt, max(high) AS topo, min(low) AS fundo, any_value(m0) AS m0 FROM m1 JOIN a USING (symbol, dt) WHERE minuto < m0 + 15 GROUP BY ALL), t AS (SELECT m1.symbol, m1.dt, min(minuto) FILTER (WHERE high > topo) AS alta, min(minuto) FILTER (WHERE low < fundo) AS baixa FROM m1 JOIN ab USING (symbol, dt) WHERE minuto >= m0 + 15 GROUP BY ALL) SELECT symbol, dt, CASE WHEN alta IS NULL AND baixa IS NULL THEN 'nenhum' WHEN alta = baixa THEN 'duplo' WHEN baixa IS NULL OR alta < baixa THEN 'alta' ELSE 'baixa' END AS rompimento FROM t")
def l11_opening_range(spark, d):
    """Break-out of the first fifteen minutes: the first side triggered; both in one bar count apart."""
    bars = m1(spark, d).withColumn("m0", F.min("minuto").over(Window.partitionBy("symbol", "dt")))
    opening = F.col("minuto") < F.col("m0") + 15
    day = Window.partitionBy("symbol", "dt")
    bars = bars.withColumns({"topo": F.max(F.when(opening, F.col("high"))).over(day), "fundo": F.min(F.when(opening, F.col("low"))).over(day)}).where(~opening)
    t = bars.groupBy("symbol", "dt").agg(F.min(F.when(F.col("high") > F.col("topo"), F.col("minuto"))).alias("a"), F.min(F.when(F.col("low") < F.col("fundo"), F.col("minuto"))).alias("b"))
    kind = F.when(F.col("a").isNull() & F.col("b").isNull(), "nenhum").when(F.col("a") == F.col("b"), "duplo").when(F.col("b").isNull() | (F.col("a") < F.col("b")), "alta").otherwise("baixa")
    return t.select("symbol", "dt", kind.alias("rompimento"))


_PASS = "CASE trade_type WHEN 2 THEN agente_vendedor WHEN 3 THEN agente_comprador ELSE 0 END"


@R.add(f"WITH {SQL_TAPE}, p AS (SELECT *, {_PASS} AS passivo FROM tape), a AS (SELECT * FROM p WHERE passivo > 0), f AS (SELECT *, CASE WHEN coalesce(ts_ns - lag(ts_ns) OVER w <= 30000000000, false) THEN 0 ELSE 1 END AS s FROM a WINDOW w AS (PARTITION BY symbol, dt, price, quantidade, passivo ORDER BY ts_ns, ts_recv_ns, trade_id)), g AS (SELECT *, sum(s) OVER (PARTITION BY symbol, dt, price, quantidade, passivo ORDER BY ts_ns, ts_recv_ns, trade_id)::bigint AS ilha FROM f) SELECT symbol, dt, price, quantidade, passivo, ilha, count(*) AS n, min(ts_ns) AS de, max(ts_ns) AS ate FROM g GROUP BY ALL HAVING count(*) >= 2")
def l18_iceberg_runs(spark, d):
    """Repeated equal lots of one passive broker at one price, no more than 30 s apart."""
    return iceberg_runs(tape(spark, d))


def iceberg_runs(t: DataFrame, gap_ns: int = 30_000_000_000, least: int = 2) -> DataFrame:
    keys = ["symbol", "dt", "price", "quantidade", "passivo"]
    rows = t.withColumn("passivo", passive_broker(F.col("trade_type"), F.col("agente_comprador"), F.col("agente_vendedor")).cast("bigint")).where("passivo > 0")
    order = ["ts_ns", "ts_recv_ns", "trade_id"]
    fresh = ~F.coalesce(F.col("ts_ns") - F.lag("ts_ns").over(Window.partitionBy(*keys).orderBy(*order)) <= gap_ns, F.lit(False))
    runs = islands(rows, keys, order, fresh)
    return runs.groupBy(*keys, "ilha").agg(F.count(F.lit(1)).alias("n"), F.min("ts_ns").alias("de"), F.max("ts_ns").alias("ate")).where(F.col("n") >= least)


@R.add(f"WITH {SQL_M1}, top AS (SELECT symbol FROM m1 GROUP BY symbol ORDER BY count(*) DESC, symbol LIMIT 1), r AS (SELECT symbol, dt, minuto, ln(close / lag(close) OVER ({_M1W})) AS r FROM m1), l AS (SELECT r.dt, r.minuto, r.r FROM r JOIN top USING (symbol)), p AS (SELECT r.symbol, a.atraso, l.r AS x, r.r AS y FROM r, (SELECT unnest([-2, -1, 0, 1, 2]) AS atraso) a, l WHERE l.dt = r.dt AND l.minuto = r.minuto - a.atraso AND r.symbol NOT IN (SELECT symbol FROM top) AND l.r IS NOT NULL AND r.r IS NOT NULL) SELECT symbol, atraso::bigint AS atraso, count(*) AS n, round(CASE WHEN count(*) >= 30 AND stddev_samp(x) > 0 AND stddev_samp(y) > 0 THEN corr(x, y) END, 5) + 0.0 AS correlacao FROM p GROUP BY ALL")
def l06_lead_lag(spark, d):
    """Correlation of each symbol's returns with the most traded one's, at lags of minutes: six sums per lag, mergeable over days."""
    bars = m1(spark, d)
    top = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "symbol").limit(1).select("symbol")
    r = bars.select("symbol", "dt", "minuto", F.log(F.col("close") / F.lag("close").over(in_minutes())).alias("r")).where("r is not null")
    lead = r.join(top, "symbol", "left_semi").select("dt", F.explode(F.array(*map(F.lit, (-2, -1, 0, 1, 2)))).alias("atraso"), "minuto", F.col("r").alias("x")).withColumn("minuto", F.col("minuto") + F.col("atraso"))
    p = r.join(top, "symbol", "left_anti").join(lead, ["dt", "minuto"]).withColumn("y", F.col("r"))
    usable = (F.count(F.lit(1)) >= 30) & (F.stddev_samp("x") > 0) & (F.stddev_samp("y") > 0)
    return p.groupBy("symbol", F.col("atraso").cast("bigint").alias("atraso")).agg(F.count(F.lit(1)).alias("n"), r6(F.when(usable, correlation(F.col("x"), F.col("y"))), 5).alias("correlacao"))


# ---- M: simulations --------------------------------------------------------------------------------------------------


_AHEAD = f"({_M1W} ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)"


@R.add(f"WITH {SQL_M1} SELECT symbol, dt, minuto, round(CASE WHEN count(*) OVER {_AHEAD} = 5 THEN greatest(max(high) OVER {_AHEAD} - close, 0.0) END, 6) AS mfe_5, round(CASE WHEN count(*) OVER {_AHEAD} = 5 THEN least(min(low) OVER {_AHEAD} - close, 0.0) END, 6) + 0.0 AS mae_5 FROM m1")
def m01_excursions(spark, d):
    return excursions(m1(spark, d), ["symbol", "dt"], "minuto", [5]).select("symbol", "dt", "minuto", r6("mfe_5").alias("mfe_5"), r6("mae_5").alias("mae_5"))


_REL = 0.0005


def _signal(bars: DataFrame) -> DataFrame:
    """Against a move of at least 0.05 % from the close before."""
    move = F.col("close") / F.lag("close").over(in_minutes()) - 1
    return bars.withColumn("lado", F.when(move >= _REL, -1).when(move <= -_REL, 1).otherwise(0).cast("bigint"))


_M5 = f"""{SQL_M1}, sg AS (SELECT *, CASE WHEN close / lag(close) OVER ({_M1W}) - 1 >= {_REL} THEN -1 WHEN close / lag(close) OVER ({_M1W}) - 1 <= -{_REL} THEN 1 ELSE 0 END AS lado, row_number() OVER ({_M1W}) AS i FROM m1),
f AS (SELECT s.symbol, s.dt, s.minuto, s.lado, s.close AS c, f.i, f.minuto AS m, f.close AS fc, CASE WHEN s.lado > 0 THEN f.high >= s.close + 0.05 ELSE f.low <= s.close - 0.05 END AS t, CASE WHEN s.lado > 0 THEN f.low <= s.close - 0.03 ELSE f.high >= s.close + 0.03 END AS st
  FROM sg s JOIN sg f ON f.symbol = s.symbol AND f.dt = s.dt AND f.i BETWEEN s.i + 1 AND s.i + 20 WHERE s.lado <> 0),
h AS (SELECT symbol, dt, minuto, min({{'i': i, 'm': m, 't': t, 's': st}}) FILTER (WHERE t OR st) AS w, max({{'i': i, 'm': m, 'c': fc}}) AS u FROM f GROUP BY ALL),
res AS (SELECT s.symbol, s.dt, s.minuto, s.lado, CASE WHEN w IS NULL THEN 'tempo' WHEN w['t'] AND w['s'] THEN 'ambiguo' WHEN w['t'] THEN 'alvo' ELSE 'stop' END AS desfecho, coalesce(w['m'], u['m']) AS saida,
    CASE WHEN w IS NULL THEN coalesce(s.lado * (u['c'] - s.close), 0.0) WHEN w['s'] THEN -0.03 ELSE 0.05 END AS resultado FROM sg s LEFT JOIN h USING (symbol, dt, minuto) WHERE s.lado <> 0)"""


def resolved(spark, d):
    return resolve_target_stop(_signal(m1(spark, d)), ["symbol", "dt"], "minuto", "lado", 0.05, 0.03, 20)


@R.add(f"WITH {_M5} SELECT symbol, dt, minuto, lado, desfecho, saida, round(resultado, 6) + 0.0 AS resultado FROM res")
def m05_target_stop(spark, d):
    return resolved(spark, d).select("symbol", "dt", "minuto", "lado", "desfecho", "saida", r6("resultado").alias("resultado"))


_M5_SEQ = f"""WITH RECURSIVE {_M5}, n AS (SELECT *, row_number() OVER (PARTITION BY symbol, dt ORDER BY minuto) AS k FROM res),
r AS (SELECT symbol, dt, minuto, coalesce(saida, minuto) AS ate, resultado, true AS fica, k FROM n WHERE k = 1
  UNION ALL SELECT n.symbol, n.dt, n.minuto, CASE WHEN n.minuto > r.ate THEN coalesce(n.saida, n.minuto) ELSE r.ate END, n.resultado, n.minuto > r.ate, n.k FROM r JOIN n ON n.symbol = r.symbol AND n.dt = r.dt AND n.k = r.k + 1)"""


@R.add(f"{_M5_SEQ} SELECT symbol, dt, minuto, round(resultado, 6) + 0.0 AS resultado FROM r WHERE fica")
def m05b_sequential(spark, d):
    """One position at a time."""
    kept = one_at_a_time(resolved(spark, d).select("symbol", "dt", "minuto", "saida", "resultado"), ["symbol", "dt"], "minuto", "saida")
    return kept.select("symbol", "dt", "minuto", r6("resultado").alias("resultado"))


@R.add(f"WITH {_M5} SELECT symbol, count(*) AS n, round(avg(resultado), 6) + 0.0 AS media, round(100.0 * count(*) FILTER (WHERE resultado > 0) / count(*), 6) AS acerto, round(sum(resultado) FILTER (WHERE resultado > 0) / nullif(-sum(resultado) FILTER (WHERE resultado < 0), 0), 5) AS fator FROM res GROUP BY symbol")
def m15_summary(spark, d):
    rows, x = resolved(spark, d), F.col("resultado")
    factor = F.sum(F.when(x > 0, x)) / F.nullif(-F.sum(F.when(x < 0, x)), F.lit(0.0))
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), r6(F.avg(x)).alias("media"), r6(100.0 * F.count_if(x > 0) / F.count(F.lit(1))).alias("acerto"), r6(factor, 5).alias("fator"))


# ---- N: book ---------------------------------------------------------------------------------------------------------

SQL_TOP = f"""{SQL_QUOTES}, tp AS (SELECT symbol, dia, topo_id, ts_recv_ns, nullif(last_value(preco_bid IGNORE NULLS) OVER w, 0) AS bid, last_value(CASE WHEN preco_bid IS NOT NULL THEN qtd_bid END IGNORE NULLS) OVER w AS bid_qtd,
  nullif(last_value(preco_ask IGNORE NULLS) OVER w, 0) AS ask, last_value(CASE WHEN preco_ask IS NOT NULL THEN qtd_ask END IGNORE NULLS) OVER w AS ask_qtd
  FROM quotes WINDOW w AS (PARTITION BY symbol, dia ORDER BY ts_recv_ns, topo_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


_TICKS = f"tk AS (SELECT {SQL_SYMBOL} AS symbol, tick FROM ativos)"


@R.add(f"WITH {SQL_TOP}, {_TICKS} SELECT symbol, round((ask - bid) / tick)::bigint AS passos, count(*) AS n FROM tp JOIN tk USING (symbol) WHERE bid < ask GROUP BY ALL")
def n05_spread_histogram(spark, d):
    top = top_of_book(quotes(spark, d)).where("bid < ask").join(table(spark, d, "ativos", "symbol", "tick"), "symbol")
    return top.groupBy("symbol", F.round((F.col("ask") - F.col("bid")) / F.col("tick")).cast("bigint").alias("passos")).agg(F.count(F.lit(1)).alias("n"))


@R.add(f"WITH {SQL_TOP}, r AS (SELECT *, lag(topo_id) OVER (PARTITION BY symbol, dia ORDER BY ts_recv_ns, topo_id) AS antes FROM tp) SELECT symbol, count(*) AS cotacoes, count(*) FILTER (WHERE bid IS NULL OR ask IS NULL) AS sem_lado, count(*) FILTER (WHERE bid >= ask) AS cruzadas, count(*) FILTER (WHERE least(bid_qtd, ask_qtd) < 1) AS vazias, count(*) FILTER (WHERE topo_id < antes) AS fora_de_ordem FROM r GROUP BY symbol")
def n05b_quote_counters(spark, d):
    """Quotes without a side, crossed, without quantity, and received before one of a smaller number: the counters beside N5's histogram."""
    w = Window.partitionBy("symbol", "dia").orderBy("ts_recv_ns", "topo_id")
    rows = top_of_book(quotes(spark, d)).withColumn("antes", F.lag("topo_id").over(w))
    n = F.count_if
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("cotacoes"), n(F.col("bid").isNull() | F.col("ask").isNull()).alias("sem_lado"), n(F.col("bid") >= F.col("ask")).alias("cruzadas"), n(F.least("bid_qtd", "ask_qtd") < 1).alias("vazias"), n(F.col("topo_id") < F.col("antes")).alias("fora_de_ordem"))


@R.add(f"WITH {SQL_TOP}, c AS (SELECT *, coalesce(bid >= ask, false) AS c, lead(ts_recv_ns) OVER w AS nx FROM tp WINDOW w AS (PARTITION BY symbol, dia ORDER BY ts_recv_ns, topo_id)), s AS (SELECT *, CASE WHEN coalesce(lag(c) OVER w <> c, true) THEN 1 ELSE 0 END AS s FROM c WINDOW w AS (PARTITION BY symbol, dia ORDER BY ts_recv_ns, topo_id)), i AS (SELECT *, sum(s) OVER (PARTITION BY symbol, dia ORDER BY ts_recv_ns, topo_id)::bigint AS ilha FROM s) SELECT symbol, dia, ilha, min(ts_recv_ns) AS de, count(*) AS n, max(coalesce(nx, ts_recv_ns)) - min(ts_recv_ns) AS duracao_ns FROM i WHERE c GROUP BY ALL")
def n04_crossed_episodes(spark, d):
    return crossed_episodes(top_of_book(quotes(spark, d)))


@R.add(f"WITH {SQL_TOP}, a AS (SELECT *, coalesce(ts_recv_ns - lag(ts_recv_ns) OVER (PARTITION BY symbol, dia ORDER BY ts_recv_ns, topo_id), 0) AS idade FROM tp), k AS (SELECT a.symbol, CASE WHEN bid IS NULL OR ask IS NULL THEN 'sem_livro' WHEN bid >= ask THEN 'cruzado' WHEN idade > 5000000000 THEN 'velho' WHEN ask - bid > 5 * tick + 1e-9 THEN 'largo' WHEN least(bid_qtd, ask_qtd) < 1 THEN 'fino' ELSE 'ok' END AS uso FROM a JOIN (SELECT {SQL_SYMBOL} AS symbol, tick FROM ativos) t USING (symbol)) SELECT symbol, uso, count(*) AS n FROM k GROUP BY ALL")
def n06_usability(spark, d):
    top = top_of_book(quotes(spark, d))
    w = Window.partitionBy("symbol", "dia").orderBy("ts_recv_ns", "topo_id")
    top = top.withColumn("idade", F.coalesce(F.col("ts_recv_ns") - F.lag("ts_recv_ns").over(w), F.lit(0))).join(table(spark, d, "ativos", "symbol", "tick"), "symbol")
    use = usability(F.col("bid"), F.col("ask"), F.col("bid_qtd"), F.col("ask_qtd"), F.col("idade"), F.col("tick"))
    return top.groupBy("symbol", use.alias("uso")).agg(F.count(F.lit(1)).alias("n"))


_SAME = ("action", "side", "position", "offer_id", "price", "quantidade", "agente")


@R.add(f"""WITH b AS (SELECT {SQL_SYMBOL} AS symbol, dt, seq, ts_recv_ns, {", ".join(_SAME)} FROM book_offer),
f AS (SELECT *, CASE WHEN lag(seq) OVER w IS NOT NULL AND {" AND ".join(f"{c} IS NOT DISTINCT FROM lag({c}) OVER w" for c in _SAME)} THEN 0 ELSE 1 END AS novo FROM b WINDOW w AS (PARTITION BY symbol, dt ORDER BY ts_recv_ns, seq, {", ".join(f"{c} NULLS FIRST" for c in _SAME)})),
g AS (SELECT *, sum(novo) OVER (PARTITION BY symbol, dt ORDER BY ts_recv_ns, seq, {", ".join(f"{c} NULLS FIRST" for c in _SAME)} ROWS UNBOUNDED PRECEDING) AS seq_id FROM f),
t AS (SELECT symbol, dt, seq_id, count(*) AS n FROM g GROUP BY ALL)
SELECT symbol, dt, sum(n)::bigint AS linhas, round(sum(CASE WHEN n % 2 = 0 THEN n ELSE 0 END) / sum(n), 4) AS fracao_par, sum(CASE WHEN n % 2 = 0 THEN n ELSE 0 END) / sum(n) >= 0.9 AS dobrado,
  CASE WHEN sum(CASE WHEN n % 2 = 0 THEN n ELSE 0 END) / sum(n) >= 0.9 THEN sum((n + 1) // 2) ELSE sum(n) END::bigint AS mantidas FROM t GROUP BY ALL""")
def n02_undoubled_days(spark, d):
    """Days whose changes stand twice (at least 90 % of rows in runs of even length), and the rows left when each such run is halved."""
    b = table(spark, d, "book_offer", "symbol", "dt", "seq", "ts_recv_ns", *_SAME)
    out = undouble(b, ["symbol", "dt"], ["ts_recv_ns", "seq", *_SAME], _SAME)
    return out.groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("linhas"), r6(F.first("fracao_par"), 4).alias("fracao_par"), F.first("dobrado").alias("dobrado"), F.count_if("mantida").alias("mantidas"))


# ---- O: statistics ---------------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_FLOW}, days AS (SELECT dt, dense_rank() OVER (ORDER BY dt) AS n FROM (SELECT DISTINCT dt FROM tape)) SELECT dt, CASE WHEN n > 1 THEN (n - 2) // 2 END AS fold FROM days")
def o01_folds(spark, d):
    return walk_forward(tape(spark, d).select("dt"), "dt", 1, 2)


_FR = f"fr AS (SELECT symbol, bar_id, imbalance, rlp_frac, lead(close) OVER (PARTITION BY symbol ORDER BY bar_id) / close - 1 AS ret FROM flow)"


@R.add(f"WITH {SQL_FLOW}, {_FR}, l AS (SELECT symbol, 'imbalance' AS feature, round(imbalance, 9) AS x, round(ret, 12) AS ret FROM fr UNION ALL SELECT symbol, 'rlp_frac', round(rlp_frac, 9), round(ret, 12) FROM fr), k AS (SELECT *, rank() OVER (PARTITION BY symbol, feature ORDER BY x) + (count(*) OVER (PARTITION BY symbol, feature, x) - 1) / 2.0 AS a, rank() OVER (PARTITION BY symbol, feature ORDER BY ret) + (count(*) OVER (PARTITION BY symbol, feature, ret) - 1) / 2.0 AS b FROM l WHERE x IS NOT NULL AND ret IS NOT NULL) SELECT symbol, feature, count(*) AS n, round(CASE WHEN count(*) >= 10 AND stddev_samp(a) > 0 AND stddev_samp(b) > 0 THEN corr(a, b) END, 5) + 0.0 AS ic FROM k GROUP BY ALL")
def o02_information_coefficient(spark, d):
    """Spearman's coefficient of each feature with the next bar's return; features unpivoted, one shuffle."""
    fr = flow(spark, d).select("symbol", "bar_id", "imbalance", "rlp_frac", (F.lead("close").over(by_bar()) / F.col("close") - 1).alias("ret"))
    long = fr.unpivot(["symbol", "ret"], ["imbalance", "rlp_frac"], "feature", "x").withColumns({"x": F.round("x", 9), "ret": F.round("ret", 12)})
    return information_coefficient(long, ["symbol", "feature"], "x", "ret").withColumn("ic", r6("ic", 5))


@R.add(f"WITH {SQL_FLOW}, {_FR}, f2 AS (SELECT symbol, round(imbalance, 9) AS x, ret FROM fr WHERE ret IS NOT NULL), e AS (SELECT symbol, list_distinct(quantile_cont(x, [0.2, 0.4, 0.6, 0.8])) AS e FROM f2 GROUP BY symbol), q AS (SELECT f2.symbol, (1 + len(list_filter(e, lambda y: x > y)))::bigint AS quintil, ret FROM f2 JOIN e USING (symbol)) SELECT symbol, quintil, count(*) AS n, round(avg(ret), 9) + 0.0 AS media FROM q GROUP BY ALL")
def o05_quintiles(spark, d):
    fr = flow(spark, d).select("symbol", F.round("imbalance", 9).alias("x"), (F.lead("close").over(by_bar()) / F.col("close") - 1).alias("ret")).where("ret is not null")
    return quantile_bucket(fr, ["symbol"], "x", 5).groupBy("symbol", "quintil").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("ret"), 9).alias("media"))


@R.add(f"WITH {_M5}, s AS (SELECT symbol, avg(resultado) FILTER (WHERE lado > 0) AS ma, var_samp(resultado) FILTER (WHERE lado > 0) AS va, count(*) FILTER (WHERE lado > 0) AS na, avg(resultado) FILTER (WHERE lado < 0) AS mb, var_samp(resultado) FILTER (WHERE lado < 0) AS vb, count(*) FILTER (WHERE lado < 0) AS nb FROM res GROUP BY symbol) SELECT symbol, round(CASE WHEN na >= 2 AND nb >= 2 AND sqrt(va / na + vb / nb) > 1e-12 THEN (ma - mb) / sqrt(va / na + vb / nb) END, 5) + 0.0 AS t FROM s")
def o06_welch(spark, d):
    """Whether buys and sells end differently."""
    x = lambda s, f: f(F.when(F.col("lado") == s, F.col("resultado")))
    s = resolved(spark, d).groupBy("symbol").agg(x(1, F.avg).alias("ma"), x(1, F.var_samp).alias("va"), x(1, F.count).alias("na"), x(-1, F.avg).alias("mb"), x(-1, F.var_samp).alias("vb"), x(-1, F.count).alias("nb"))
    return s.select("symbol", r6(welch_t(*(F.col(c) for c in ("ma", "va", "na", "mb", "vb", "nb"))), 5).alias("t"))


@R.add(f"WITH {_M5}, v AS (SELECT symbol, quantile_cont(round(resultado, 6), 0.05) AS var FROM res GROUP BY symbol) SELECT symbol, round(any_value(var), 6) + 0.0 AS var, round(avg(round(resultado, 6)) FILTER (WHERE round(resultado, 6) <= var), 6) + 0.0 AS es, count(*) AS n FROM res JOIN v USING (symbol) GROUP BY symbol")
def o11_value_at_risk(spark, d):
    out = value_at_risk(resolved(spark, d).withColumn("x", r6("resultado")), ["symbol"], "x")
    return out.select("symbol", r6("var").alias("var"), r6("es").alias("es"), "n")


# ---- P: descriptive queries ------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_M1}, f AS (SELECT *, row_number() OVER (PARTITION BY symbol, dt ORDER BY minuto DESC) AS k, sum(volume) OVER (PARTITION BY symbol, dt) AS tot FROM m1) SELECT symbol, k, count(*) AS dias, round(median(volume / tot), 6) AS parte FROM f WHERE k <= 5 GROUP BY ALL")
def mk02_closing_share(spark, d):
    """Volume share of the session's last five bars, counted from the end; the median over days."""
    end = Window.partitionBy("symbol", "dt").orderBy(F.desc("minuto"))
    rows = m1(spark, d).withColumns({"k": F.row_number().over(end).cast("bigint"), "tot": F.sum("volume").over(Window.partitionBy("symbol", "dt"))})
    return rows.where("k <= 5").groupBy("symbol", "k").agg(F.count(F.lit(1)).alias("dias"), r6(F.median(F.col("volume") / F.col("tot"))).alias("parte"))


@R.add(f"WITH {SQL_TAPE} SELECT DISTINCT agente FROM (SELECT agente_comprador AS agente FROM tape UNION ALL SELECT agente_vendedor FROM tape) WHERE agente > 0")
def mk17_brokers(spark, d):
    t = tape(spark, d)
    return t.select(F.explode(F.array("agente_comprador", "agente_vendedor")).alias("agente")).where("agente > 0").distinct()


@R.add("SELECT upper(trim(status)) AS situacao, count(*) AS n, count(DISTINCT profit_id) AS ordens, count(*) FILTER (WHERE executada > 0) AS com_execucao FROM evento_ordem GROUP BY ALL")
def mk14_order_diary(spark, d):
    e = table(spark, d, "evento_ordem", "status", "profit_id", "executada")
    return e.groupBy(F.upper(F.trim("status")).alias("situacao")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("profit_id").alias("ordens"), F.count_if(F.col("executada") > 0).alias("com_execucao"))


# ---- Q: batch views of streams, S: quality ---------------------------------------------------------------------------


@R.add(f"SELECT {SQL_SYMBOL} AS symbol, ts_recv_ns // 300000000000 AS janela, count(*) AS n, round(quantile_cont((ts_recv_ns - ts_ns)::double, 0.5), 1) AS p50, max(ts_recv_ns - ts_ns) AS pior FROM trades WHERE {SQL_VALID} AND coalesce(is_edit, false) = false GROUP BY ALL")
def q12_lag_monitor(spark, d):
    """Receive minus event time per five minutes of arrival, edits apart."""
    t = table(spark, d, "trades", "symbol", "dt", "ts_ns", "ts_recv_ns", "is_edit").where(valid_ts(F.col("ts_ns"), F.col("dt")) & ~F.coalesce("is_edit", F.lit(False)))
    lag = F.col("ts_recv_ns") - F.col("ts_ns")
    return t.groupBy("symbol", F.expr(f"ts_recv_ns div {_P5}").alias("janela")).agg(F.count(F.lit(1)).alias("n"), r6(F.percentile(lag.cast("double"), F.lit(0.5)), 1).alias("p50"), F.max(lag).alias("pior"))


@R.add(f"WITH {SQL_TAPE} SELECT symbol, dt, count(*) AS linhas, min(ts_ns) AS de, max(ts_ns) AS ate, sum(quantidade)::bigint AS volume FROM tape GROUP BY ALL")
def s01_curate_totals(spark, d):
    return tape(spark, d).groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("linhas"), F.min("ts_ns").alias("de"), F.max("ts_ns").alias("ate"), F.sum("quantidade").alias("volume"))


@R.add(f"WITH r AS (SELECT {SQL_SYMBOL} AS symbol, dt, trade_id, count(*) AS n, count(DISTINCT (coalesce(price, -1), coalesce(quantidade, -1), ts_ns)) AS v FROM trades WHERE trade_id > 0 GROUP BY ALL HAVING count(*) > 1) SELECT symbol, dt, count(*) AS chaves, count(*) FILTER (WHERE v = 1) AS reentregas, count(*) FILTER (WHERE v > 1) AS edicoes FROM r GROUP BY ALL")
def s03_duplicate_diagnosis(spark, d):
    """Repeated ids: the same content again, or an edit."""
    content = F.struct(F.coalesce("price", F.lit(-1.0)).alias("p"), F.coalesce("quantidade", F.lit(-1)).alias("q"), "ts_ns")
    r = table(spark, d, "trades", "symbol", "dt", "trade_id", "price", "quantidade", "ts_ns").where("trade_id > 0").groupBy("symbol", "dt", "trade_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(content).alias("v")).where("n > 1")
    return r.groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("chaves"), F.count_if(F.col("v") == 1).alias("reentregas"), F.count_if(F.col("v") > 1).alias("edicoes"))


@R.add(f"SELECT {SQL_SYMBOL} AS symbol, dt, count(*) AS linhas, min(ts_recv_ns) AS de, max(ts_recv_ns) AS ate, count(*) FILTER (WHERE coalesce({SQL_VALID}, false) = false) AS invalidas, count(*) FILTER (WHERE trade_type IS NULL OR trade_type NOT IN (1, 2, 3, 4, 13)) AS tipos_desconhecidos, round(100.0 * count(agente_comprador) / count(*), 4) AS compradores_pct, round(quantile_cont((ts_recv_ns - ts_ns)::double, 0.5) FILTER (WHERE {SQL_VALID}) / 1e6, 3) AS latencia_ms FROM trades GROUP BY ALL")
def s04_audit(spark, d):
    """One pass over the raw trades: span, invalid instants, unknown types, broker fill rate, median latency."""
    t = table(spark, d, "trades", "symbol", "dt", "ts_ns", "ts_recv_ns", "trade_type", "agente_comprador")
    ok = valid_ts(F.col("ts_ns"), F.col("dt"))
    return t.groupBy("symbol", "dt").agg(
        F.count(F.lit(1)).alias("linhas"), F.min("ts_recv_ns").alias("de"), F.max("ts_recv_ns").alias("ate"), F.count_if(~ok).alias("invalidas"),
        F.count_if(F.col("trade_type").isNull() | ~F.col("trade_type").isin(1, 2, 3, 4, 13)).alias("tipos_desconhecidos"), r6(100.0 * F.count("agente_comprador") / F.count(F.lit(1)), 4).alias("compradores_pct"),
        r6(F.percentile(F.when(ok, (F.col("ts_recv_ns") - F.col("ts_ns")).cast("double")), F.lit(0.5)) / 1e6, 3).alias("latencia_ms"),
    )


@R.add(f"WITH r AS (SELECT file_id, max(ts_recv_ns) - min(ts_recv_ns) AS vao, median((ts_recv_ns - ts_ns)::double) FILTER (WHERE {SQL_VALID}) AS med FROM trades GROUP BY file_id) SELECT CASE WHEN med IS NULL THEN 'desconhecida' WHEN abs(med) <= 60e9 THEN 'ao_vivo' ELSE 'importada' END AS origem, count(*) AS arquivos FROM r GROUP BY ALL")
def s07_capture_origin(spark, d):
    """Live or imported, by how far reception is from the event."""
    t = table(spark, d, "trades", "file_id", "dt", "ts_ns", "ts_recv_ns")
    lag = F.when(valid_ts(F.col("ts_ns"), F.col("dt")), (F.col("ts_recv_ns") - F.col("ts_ns")).cast("double"))
    r = t.groupBy("file_id").agg(F.median(lag).alias("med"))
    return r.groupBy(F.when(F.col("med").isNull(), "desconhecida").when(F.abs("med") <= 60e9, "ao_vivo").otherwise("importada").alias("origem")).agg(F.count(F.lit(1)).alias("arquivos"))


@R.add(f"WITH t AS (SELECT {SQL_SYMBOL} AS symbol, count(DISTINCT dt) AS dias, min(dt) AS de, max(dt) AS ate, count(*) AS linhas FROM trades GROUP BY ALL) SELECT a.symbol, a.familia, coalesce(dias, 0) AS dias, de, ate, coalesce(linhas, 0) AS linhas FROM (SELECT {SQL_SYMBOL} AS symbol, familia FROM ativos) a LEFT JOIN t USING (symbol)")
def s08_asset_inventory(spark, d):
    t = table(spark, d, "trades", "symbol", "dt").groupBy("symbol").agg(F.count_distinct("dt").alias("dias"), F.min("dt").alias("de"), F.max("dt").alias("ate"), F.count(F.lit(1)).alias("linhas"))
    return table(spark, d, "ativos", "symbol", "familia").join(t, "symbol", "left").select("symbol", "familia", F.coalesce("dias", F.lit(0)).alias("dias"), "de", "ate", F.coalesce("linhas", F.lit(0)).alias("linhas"))


QUERIES, ORACLES = R.queries, R.sql
