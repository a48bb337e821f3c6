"""Orders on the tape, book events, pairs, indicator variants and verdicts: further rows of groups C, D, I, K, L, M, N, O, P and Q."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators.asof import has_within
from ..operators.book import level_events, refill_chains
from ..operators.fold import by_series, ema, greedy_keep, seeded_ema, wilder
from ..operators.indicators import gains, rsi, sma, stochastic, true_range
from ..operators.quotes import top_of_book
from ..operators.replay import leg_exits, limit_fills, one_to_one, passive_fill, remaining_after_touch
from ..operators.stats import information_coefficient, verdict, walk_forward
from ..operators.tape import is_aggressor, local_hhmm
from ..operators.windows import full_window
from ..sources.tables import table
from .registry import SQL_SYMBOL, SQL_TAPE, Registry, quotes, r6, tape, tape_once
from .research_queries import _M5, _ORD, _REL, SQL_FLOW, SQL_TOP, _signal, by_bar, flow, resolved
from .tape_queries import _BIG, _M1W, MINUTE, SQL_HHMM, SQL_M1, big_buys, in_minutes, m1, sql_full

R = Registry()
_S = 1_000_000_000

# ---- C, D, I: joins, broker classes, chart bars ----------------------------------------------------------------------


@R.add(f"WITH {SQL_M1}, six AS (SELECT symbol, dt, minuto // 6 AS k, arg_max(close, minuto) AS fecho FROM m1 GROUP BY ALL) SELECT m1.symbol, m1.dt, minuto, round(fecho - close, 6) + 0.0 AS ainda_por_vir FROM m1 JOIN six ON six.symbol = m1.symbol AND six.dt = m1.dt AND six.k = m1.minuto // 6")
def c06_containing_bucket(spark, d):
    """What the 6-minute bar *containing* a minute knows that the minute doesn't: the look-ahead variant, for diagnosis only."""
    bars = m1(spark, d).withColumn("k", F.expr("minuto div 6"))
    six = bars.groupBy("symbol", "dt", "k").agg(F.max_by("close", "minuto").alias("fecho"))
    return bars.join(six, ["symbol", "dt", "k"]).select("symbol", "dt", "minuto", r6(F.col("fecho") - F.col("close")).alias("ainda_por_vir"))


_OPS = f"""ops AS (SELECT symbol, dt, em // {MINUTE} AS minuto, CASE lado WHEN 1 THEN 1 ELSE -1 END AS lado, sum(executada)::bigint AS executada FROM (
  SELECT upper(trim(ticker)) AS symbol, s.dt, ts_base_ns + round((t_mono - t_mono_base) * 1e9)::bigint AS em, lado, executada FROM evento_ordem JOIN sessoes s USING (sessao_id)) WHERE executada > 0 AND lado IN (1, 2) GROUP BY ALL)"""


@R.add(f"WITH {SQL_M1}, {_OPS} SELECT ops.symbol, ops.dt, ops.minuto, ops.lado, executada, volume, sign(close - open)::bigint = ops.lado AS a_favor FROM ops LEFT JOIN (SELECT * FROM m1) m ON m.symbol = ops.symbol AND m.dt = ops.dt AND m.minuto = ops.minuto")
def c15_operations_on_bars(spark, d):
    """Executed quantity by (symbol, day, minute, side), matched with that minute's bar, if there is one."""
    e = table(spark, d, "evento_ordem", "ticker", "sessao_id", "t_mono", "lado", "executada").where("executada > 0 and lado in (1, 2)")
    at = F.col("ts_base_ns") + F.round((F.col("t_mono") - F.col("t_mono_base")) * 1e9).cast("bigint")
    ops = e.join(table(spark, d, "sessoes", "sessao_id", "dt", "t_mono_base", "ts_base_ns"), "sessao_id").withColumn("_at", at)
    ops = ops.groupBy(F.col("ticker").alias("symbol"), "dt", F.expr(f"_at div {MINUTE}").alias("minuto"), F.when(F.col("lado") == 1, 1).otherwise(-1).cast("bigint").alias("lado")).agg(F.sum("executada").alias("executada"))
    bars = m1(spark, d).select("symbol", "dt", "minuto", "volume", F.signum(F.col("close") - F.col("open")).cast("bigint").alias("_v"))
    return ops.join(bars, ["symbol", "dt", "minuto"], "left").select("symbol", "dt", "minuto", "lado", "executada", "volume", (F.col("_v") == F.col("lado")).alias("a_favor"))


_LEGS = "l AS (SELECT symbol, dt, agente_comprador AS agente, quantidade AS q FROM tape WHERE trade_type IN (2, 3) UNION ALL SELECT symbol, dt, agente_vendedor, -quantidade FROM tape WHERE trade_type IN (2, 3))"


@R.add(f"WITH {SQL_TAPE}, {_LEGS}, v AS (SELECT agente, sum(abs(q)) AS v FROM l WHERE agente > 0 GROUP BY ALL), k AS (SELECT agente, CASE WHEN row_number() OVER (ORDER BY v DESC, agente) <= 10 THEN 'grande' ELSE 'outros' END AS classe FROM v) SELECT symbol, dt, coalesce(classe, 'sem_agente') AS classe, sum(q)::bigint AS fluxo, sum(abs(q))::bigint AS dois_lados FROM l LEFT JOIN k USING (agente) GROUP BY ALL")
def d05_class_flow(spark, d):
    """Signed aggressor flow by class of broker: the ten largest of the table, the others, and legs without one."""
    flow_ = B.broker_flow(tape_once(spark, d), ["symbol", "dt"])
    v = flow_.where("agente > 0").groupBy("agente").agg(F.sum("dois_lados").alias("v"))
    classes = v.select("agente", F.when(F.row_number().over(Window.orderBy(F.desc("v"), "agente")) <= 10, "grande").otherwise("outros").alias("classe"))  # one row a broker
    return flow_.join(classes, "agente", "left").groupBy("symbol", "dt", F.coalesce("classe", F.lit("sem_agente")).alias("classe")).agg(F.sum("fluxo").alias("fluxo"), F.sum("dois_lados").alias("dois_lados"))


def _chart_sql(kinds: str) -> str:
    return f"WITH {SQL_TAPE}, s AS (SELECT symbol, dt, ts_ns // 15000000000 AS k, arg_min(price, {_ORD}) AS open, max(price) AS high, min(price) AS low, arg_max(price, {_ORD}) AS close, sum(quantidade)::bigint AS volume, count(*) AS n_trades FROM tape WHERE trade_type IN ({kinds}) GROUP BY ALL) SELECT symbol, dt, ((k * 15 - 10800) % 86400 // 3600 * 10000 + (k * 15 - 10800) % 3600 // 60 * 100 + (k * 15 - 10800) % 60)::bigint AS hhmmss, row_number() OVER (PARTITION BY symbol, dt ORDER BY k) AS current_bar, open, high, low, close, volume, n_trades FROM s"


def chart_bars(t: DataFrame, kinds: str, seconds: int = 15, offset_hours: int = -3) -> DataFrame:
    """Bars of a chosen set of trade types, labelled by their start on the local clock, and numbered from 1 inside the day."""
    rows = t.where(f"trade_type in ({kinds})").withColumn("k", F.expr(f"ts_ns div {seconds * _S}"))
    b = B.ohlc(rows, ["symbol", "dt", "k"], only_aggressors=False)
    label = F.expr(f"pmod(k * {seconds} + {3600 * offset_hours}, 86400)")
    b = b.withColumn("_l", label).withColumn("current_bar", F.row_number().over(Window.partitionBy("symbol", "dt").orderBy("k")).cast("bigint"))
    return b.select("symbol", "dt", F.expr("_l div 3600 * 10000 + pmod(_l, 3600) div 60 * 100 + pmod(_l, 60)").alias("hhmmss"), "current_bar", "open", "high", "low", "close", "volume", "n_trades")


@R.add(_chart_sql("2, 3"))
def i05_chart_bars(spark, d):
    return chart_bars(tape(spark, d), "2, 3")


@R.add(_chart_sql("2, 3, 4, 13"))
def i05b_chart_bars_all(spark, d):
    """With retail and auction trades."""
    return chart_bars(tape(spark, d), "2, 3, 4, 13")


# ---- K: indicator variants -------------------------------------------------------------------------------------------

_DIF = f"s AS (SELECT symbol, dt, minuto, close, high, low, close - lag(close) OVER ({_M1W}) AS dif, row_number() OVER ({_M1W}) AS i FROM m1), g AS (SELECT *, CASE WHEN i > 1 THEN greatest(dif, 0) END AS g, CASE WHEN i > 1 THEN greatest(-dif, 0) END AS p FROM s)"
_RSI = "CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {b} = 0 AND {a} = 0 THEN 50.0 WHEN {b} = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1 + {a} / {b}) END"


@R.add(f"""WITH RECURSIVE {SQL_M1}, {_DIF}, m AS (SELECT symbol, dt, minuto, i, round({sql_full('avg(g)', 'g', _M1W, '13 PRECEDING', 'CURRENT ROW', 14)}, 9) AS sg, round({sql_full('avg(p)', 'p', _M1W, '13 PRECEDING', 'CURRENT ROW', 14)}, 9) AS sp FROM g),
w AS (SELECT symbol, dt, i, g AS eg, p AS ep FROM g WHERE i = 2 UNION ALL SELECT w.symbol, w.dt, w.i + 1, g.g * 2.0 / 15 + w.eg * 13.0 / 15, g.p * 2.0 / 15 + w.ep * 13.0 / 15 FROM w JOIN g ON g.symbol = w.symbol AND g.dt = w.dt AND g.i = w.i + 1)
SELECT symbol, dt, minuto, round({_RSI.format(a='sg', b='sp')}, 2) AS rsi_sma, round({_RSI.format(a='eg', b='ep')}, 2) AS rsi_ewm FROM m LEFT JOIN w USING (symbol, dt, i)""")
def k01b_rsi_variants(spark, d):
    """RSI(14) by simple and by exponential averages of gains and losses, inside the day."""
    steps = by_series(m1(spark, d), ["symbol", "dt"], "minuto", "close", {"g": gains, "p": lambda v: gains(-v), "eg": lambda v: _after_first(ema(2 / 15), gains(v)), "ep": lambda v: _after_first(ema(2 / 15), gains(-v))})
    mean = lambda c: F.round(sma(F.col(c), in_minutes(), 14), 9)
    steps = steps.withColumns({"sg": mean("g"), "sp": mean("p")})
    return steps.select("symbol", "dt", "minuto", r6(rsi(F.col("sg"), F.col("sp")), 2).alias("rsi_sma"), r6(rsi(F.col("eg"), F.col("ep")), 2).alias("rsi_ewm"))


def _after_first(series, values):  # noqa: ANN001, ANN202
    out = values.copy()
    out[1:] = series(values[1:])
    return out


@R.add(f"""WITH RECURSIVE {SQL_M1}, s AS (SELECT symbol, dt, minuto, close, row_number() OVER ({_M1W}) AS i FROM m1),
a AS (SELECT symbol, dt, 9::bigint AS i, avg(close) AS e FROM s WHERE i <= 9 GROUP BY ALL HAVING count(*) = 9 UNION ALL SELECT a.symbol, a.dt, a.i + 1, 0.2 * s.close + 0.8 * a.e FROM a JOIN s ON s.symbol = a.symbol AND s.dt = a.dt AND s.i = a.i + 1),
b AS (SELECT symbol, dt, i, 0.2 * close + 0.8 * 100.0 AS e FROM s WHERE i = 1 UNION ALL SELECT b.symbol, b.dt, b.i + 1, 0.2 * s.close + 0.8 * b.e FROM b JOIN s ON s.symbol = b.symbol AND s.dt = b.dt AND s.i = b.i + 1)
SELECT symbol, dt, minuto, round(a.e, 5) AS ema_media, round(b.e, 5) AS ema_externa FROM s LEFT JOIN a USING (symbol, dt, i) JOIN b USING (symbol, dt, i)""")
def k02_ema_seeds(spark, d):
    """EMA(9) seeded by the mean of its first nine closes, and by an external value (100)."""
    out = by_series(m1(spark, d), ["symbol", "dt"], "minuto", "close", {"a": seeded_ema(9), "b": ema(0.2, 100.0)})
    return out.select("symbol", "dt", "minuto", r6("a", 5).alias("ema_media"), r6("b", 5).alias("ema_externa"))


_TR = f"CASE WHEN lag(close) OVER ({_M1W}) IS NOT NULL THEN greatest(high - low, abs(high - lag(close) OVER ({_M1W})), abs(low - lag(close) OVER ({_M1W}))) END"
_FULL21 = lambda agg: sql_full(agg, "close", _M1W, "20 PRECEDING", "CURRENT ROW", 21)


@R.add(f"""WITH RECURSIVE {SQL_M1}, t AS (SELECT *, {_TR} AS tr, row_number() OVER ({_M1W}) AS i FROM m1),
w AS (SELECT symbol, dt, 15::bigint AS i, avg(tr) AS a FROM t WHERE i BETWEEN 2 AND 15 GROUP BY ALL HAVING count(tr) = 14 UNION ALL SELECT w.symbol, w.dt, w.i + 1, (w.a * 13 + t.tr) / 14 FROM w JOIN t ON t.symbol = w.symbol AND t.dt = w.dt AND t.i = w.i + 1),
b AS (SELECT symbol, dt, minuto, i, {_FULL21('avg(close)')} AS m, {_FULL21('stddev_samp(close)')} AS s1, {_FULL21('stddev_pop(close)')} AS s0 FROM t)
SELECT symbol, dt, minuto, round(w.a, 5) AS atr_wilder, round(m + 0.38 * s1, 5) AS banda_amostral, round(m + 0.38 * s0, 5) AS banda_populacional FROM b LEFT JOIN w USING (symbol, dt, i)""")
def k03b_wilder_ranges(spark, d):
    """ATR(14) after Wilder, and bands of 0.38 deviations with both denominators."""
    bars = m1(spark, d).withColumn("tr", true_range(F.col("high"), F.col("low"), F.col("close"), in_minutes()))
    atr = by_series(bars, ["symbol", "dt"], "minuto", "tr", {"a": wilder(14)}).drop("tr")
    c, w = F.col("close"), in_minutes()
    full = lambda f: full_window(f(c), c, w, -20, 0)
    bands = bars.select("symbol", "dt", "minuto", (full(F.avg) + 0.38 * full(F.stddev_samp)).alias("b1"), (full(F.avg) + 0.38 * full(F.stddev_pop)).alias("b0"))
    return bands.join(atr, ["symbol", "dt", "minuto"]).select("symbol", "dt", "minuto", r6("a", 5).alias("atr_wilder"), r6("b1", 5).alias("banda_amostral"), r6("b0", 5).alias("banda_populacional"))


_KF = f"round(100.0 * (close - {sql_full('min(low)', 'low', _M1W, '13 PRECEDING', 'CURRENT ROW', 14)}) / nullif({sql_full('max(high)', 'high', _M1W, '13 PRECEDING', 'CURRENT ROW', 14)} - {sql_full('min(low)', 'low', _M1W, '13 PRECEDING', 'CURRENT ROW', 14)}, 0), 9)"


@R.add(f"WITH {SQL_M1}, f AS (SELECT symbol, dt, minuto, {_KF} AS k FROM m1), l AS (SELECT *, round({sql_full('avg(k)', 'k', _M1W, '2 PRECEDING', 'CURRENT ROW', 3)}, 9) AS lento FROM f) SELECT symbol, dt, minuto, round(k, 5) AS k_rapido, round(lento, 5) AS k_lento, round({sql_full('avg(lento)', 'lento', _M1W, '2 PRECEDING', 'CURRENT ROW', 3)}, 5) AS d FROM l")
def k05_slow_stochastic(spark, d):
    """Fast %K(14), its mean of three bars (slow %K) and the mean of that (%D); NULL until each is full."""
    w = in_minutes()
    f = m1(spark, d).select("symbol", "dt", "minuto", F.round(stochastic(F.col("high"), F.col("low"), F.col("close"), w), 9).alias("k"))
    f = f.withColumn("lento", F.round(sma(F.col("k"), w, 3), 9))
    return f.select("symbol", "dt", "minuto", r6("k", 5).alias("k_rapido"), r6("lento", 5).alias("k_lento"), r6(sma(F.col("lento"), w, 3), 5).alias("d"))


@R.add(f"""WITH RECURSIVE {SQL_M1}, b AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY dt, minuto) AS i FROM m1),
em AS (SELECT symbol, i, close AS e FROM b WHERE i = 1 UNION ALL SELECT em.symbol, b.i, 2.0 / 81 * b.close + (1 - 2.0 / 81) * em.e FROM em JOIN b ON b.symbol = em.symbol AND b.i = em.i + 1),
dias AS (SELECT symbol, dt, count(*) AS n, max(i) AS u FROM b GROUP BY ALL), cal AS (SELECT d::date AS dia FROM (SELECT unnest(generate_series(min(dt)::date, max(dt)::date, INTERVAL 1 DAY)) AS d FROM trades) WHERE isodow(d) <= 5),
ini AS (SELECT symbol, min(dt) AS de FROM dias GROUP BY ALL),
falta AS (SELECT ini.symbol, count(*) FILTER (WHERE coalesce(n, 0) < 30) AS faltam, count(*) AS dias FROM ini JOIN cal ON cal.dia > ini.de::date LEFT JOIN dias ON dias.symbol = ini.symbol AND dias.dt = strftime(cal.dia, '%Y-%m-%d') GROUP BY ALL),
fim AS (SELECT symbol, max(u) AS u FROM dias GROUP BY ALL)
SELECT ini.symbol, coalesce(dias, 0) AS dias_ponte, coalesce(faltam, 0) AS dias_sem_barras, CASE WHEN coalesce(faltam, 0) = 0 THEN round(e, 5) END AS semente FROM ini LEFT JOIN falta USING (symbol) JOIN fim USING (symbol) JOIN em ON em.symbol = ini.symbol AND em.i = fim.u""")
def k08_seed_bridge(spark, d):
    """The EMA(80) that the next session starts from: the first day's stored average carried over every weekday since.

    A weekday with fewer than 30 bars refuses the seed (NULL), and says how many there are.
    """
    from .research_queries import carried_ema

    bars = m1(spark, d)
    per = bars.groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("n"))
    span = table(spark, d, "trades", "dt").agg(F.min(F.to_date("dt")).alias("a"), F.max(F.to_date("dt")).alias("z"))
    cal = span.select(F.explode(F.sequence("a", "z")).alias("dia")).where("weekday(dia) <= 4").select(F.date_format("dia", "yyyy-MM-dd").alias("dt"))
    start = per.groupBy("symbol").agg(F.min("dt").alias("de"))
    due = start.join(F.broadcast(cal), F.col("dt") > F.col("de")).select("symbol", "dt")  # a calendar of days
    gaps = due.join(per, ["symbol", "dt"], "left").groupBy("symbol").agg(F.count(F.lit(1)).alias("dias_ponte"), F.count_if(F.coalesce("n", F.lit(0)) < 30).alias("dias_sem_barras"))
    last = carried_ema(bars, 80).groupBy("symbol").agg(F.max_by("ema", F.struct("dt", "minuto")).alias("e"))
    out = last.join(gaps, "symbol", "left").select("symbol", F.coalesce("dias_ponte", F.lit(0)).alias("dias_ponte"), F.coalesce("dias_sem_barras", F.lit(0)).alias("dias_sem_barras"), "e")
    return out.select("symbol", "dias_ponte", "dias_sem_barras", F.when(F.col("dias_sem_barras") == 0, r6("e", 5)).alias("semente"))


# ---- L: inspection, pairs, refills -----------------------------------------------------------------------------------

_CONDITIONS = {"volume": ("volume", 100.0), "amplitude": ("high - low", 0.05), "corpo": ("abs(close - open)", 0.03), "negocios": ("n_trades", 3.0)}


@R.add(f"WITH {SQL_M1}, c AS (SELECT symbol, dt, minuto, " + ", ".join(f"round(({x}) - {limit}, 6) + 0.0 AS folga_{n}" for n, (x, limit) in _CONDITIONS.items()) + " FROM m1) SELECT symbol, count(*) AS barras, " + ", ".join(f"count(*) FILTER (WHERE folga_{n} < 0) AS falha_{n}, count(*) FILTER (WHERE folga_{n} < 0 AND " + " AND ".join(f"folga_{o} >= 0" for o in _CONDITIONS if o != n) + f") AS so_{n}, round(median(folga_{n}), 6) AS folga_{n}" for n in _CONDITIONS) + " FROM c GROUP BY symbol")
def l26_condition_slack(spark, d):
    """How far bars are from each of several conditions, how often each fails, and how often it alone does."""
    rows = m1(spark, d).select("symbol", *(r6(F.expr(x).cast("double") - limit).alias(f"folga_{n}") for n, (x, limit) in _CONDITIONS.items()))
    aggs = [F.count(F.lit(1)).alias("barras")]
    for n in _CONDITIONS:
        fails = F.col(f"folga_{n}") < 0
        alone = fails
        for o in _CONDITIONS:
            alone = alone & (F.col(f"folga_{o}") >= 0) if o != n else alone
        aggs += [F.count_if(fails).alias(f"falha_{n}"), F.count_if(alone).alias(f"so_{n}"), r6(F.median(f"folga_{n}")).alias(f"folga_{n}")]
    return rows.groupBy("symbol").agg(*aggs)


@R.add(f"""WITH {SQL_TAPE}, r AS (SELECT symbol, row_number() OVER (ORDER BY count(*) DESC, symbol) AS k FROM tape GROUP BY symbol QUALIFY k <= 2),
a AS (SELECT tape.* FROM tape JOIN r ON r.symbol = tape.symbol AND k = 1), b AS (SELECT tape.* FROM tape JOIN r ON r.symbol = tape.symbol AND k = 2),
p AS (SELECT 'vende_A_compra_B' AS perna, dt, quantidade, EXISTS (SELECT 1 FROM b WHERE b.dt = a.dt AND b.agente_comprador = a.agente_vendedor AND b.ts_ns BETWEEN a.ts_ns - 2000000000 AND a.ts_ns + 2000000000) AS par FROM a WHERE agente_vendedor > 0
  UNION ALL SELECT 'compra_A_vende_B', dt, quantidade, EXISTS (SELECT 1 FROM b WHERE b.dt = a.dt AND b.agente_vendedor = a.agente_comprador AND b.ts_ns BETWEEN a.ts_ns - 2000000000 AND a.ts_ns + 2000000000) FROM a WHERE agente_comprador > 0)
SELECT perna, dt, count(*) AS negocios, count(*) FILTER (WHERE par) AS pares, coalesce(sum(quantidade) FILTER (WHERE par), 0)::bigint AS volume_nos_pares, round(coalesce(sum(quantidade) FILTER (WHERE par), 0) / sum(quantidade), 6) AS fracao FROM p GROUP BY ALL""")
def l22_roll_pairs(spark, d):
    """Opposite legs of one broker in the two most traded contracts within two seconds, either way round."""
    t = tape_once(spark, d)
    top = t.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "symbol").limit(2)
    top = top.withColumn("_k", F.row_number().over(Window.orderBy(F.desc("_n"), "symbol"))).drop("_n")  # two rows
    both = t.join(top, "symbol")
    parts = None
    for name, mine, other in (("vende_A_compra_B", "agente_vendedor", "agente_comprador"), ("compra_A_vende_B", "agente_comprador", "agente_vendedor")):
        a = both.where(f"_k = 1 and {mine} > 0").select(F.col(mine).alias("agente"), "dt", "ts_ns", "trade_id", "quantidade")
        b = both.where(f"_k = 2 and {other} > 0").select(F.col(other).alias("agente"), "dt", "ts_ns")
        pairs = has_within(a, b, ["agente", "dt"], "ts_ns", 2 * _S).groupBy("dt").agg(F.count(F.lit(1)).alias("pares"), F.sum("quantidade").alias("v"))
        out = a.groupBy("dt").agg(F.count(F.lit(1)).alias("negocios"), F.sum("quantidade").alias("q")).join(pairs, "dt", "left").withColumn("perna", F.lit(name))
        parts = out if parts is None else parts.unionByName(out)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return parts.select("perna", "dt", "negocios", zero("pares").alias("pares"), zero("v").alias("volume_nos_pares"), r6(zero("v") / F.col("q")).alias("fracao"))


def book_events(spark: SparkSession, d: str) -> DataFrame:
    return level_events(table(spark, d, "book_offer", "symbol", "dt", "seq", "ts_recv_ns", "action", "side", "position", "offer_id", "quantidade", "price", "agente"), ["symbol", "dt"])


#: The book's replay in SQL with what each change removes: (seq, price, quantity, broker) of the offers that leave.
_EVENTS = f"""WITH RECURSIVE copies AS (
  SELECT {SQL_SYMBOL} AS symbol, dt, seq, max({{'r': ts_recv_ns, 'a': coalesce(action, -1)::bigint, 's': side::bigint, 'p': coalesce(position, -1)::bigint, 'o': coalesce(offer_id, -1), 'q': coalesce(quantidade, -1), 'pr': coalesce(price, -1), 'ag': coalesce(agente, -1)::bigint}}) AS w FROM book_offer WHERE seq IS NOT NULL GROUP BY ALL),
ch AS (SELECT symbol, dt, seq, w['r'] AS r, w['s'] AS side, w['a'] AS a, w['p'] AS p, nullif(w['q'], -1) AS q, nullif(w['pr'], -1) AS pr, nullif(w['ag'], -1) AS ag, row_number() OVER (PARTITION BY symbol, dt, w['s'] ORDER BY seq) AS i FROM copies WHERE w['a'] IN (0, 1, 2, 3) AND w['p'] >= 0),
r AS (
  SELECT DISTINCT symbol, dt, side, 0::bigint AS i, []::STRUCT(pr DOUBLE, q BIGINT, ag BIGINT)[] AS b, []::STRUCT(pr DOUBLE, q BIGINT, ag BIGINT)[] AS saiu FROM ch
  UNION ALL
  SELECT r.symbol, r.dt, r.side, ch.i,
    CASE WHEN a = 0 THEN list_concat(list_concat(b[1:p], [{{'pr': ch.pr, 'q': ch.q, 'ag': ch.ag}}]), b[p + 1:])
         WHEN a = 1 AND p < len(b) THEN list_concat(list_concat(b[1:p], [{{'pr': b[p + 1].pr, 'q': ch.q, 'ag': b[p + 1].ag}}]), b[p + 2:])
         WHEN a = 2 AND p < len(b) THEN list_concat(b[1:p], b[p + 2:]) WHEN a = 3 THEN b[p + 2:] ELSE b END,
    CASE WHEN a = 2 THEN b[p + 1:p + 1] WHEN a = 3 THEN b[1:p + 1] ELSE [] END
  FROM r JOIN ch ON ch.symbol = r.symbol AND ch.dt = r.dt AND ch.side = r.side AND ch.i = r.i + 1),
ev AS (
  SELECT symbol, dt, side, seq, r AS em, 'entrada' AS tipo, pr AS price, q AS quantidade, ag AS agente FROM ch WHERE a = 0
  UNION ALL SELECT symbol, dt, side, seq, rr AS em, CASE WHEN a = 2 THEN 'saida_avulsa' ELSE 'saida_varredura' END, u.pr, u.q, u.ag FROM (
    SELECT r.symbol, r.dt, r.side, ch.seq, ch.r AS rr, ch.a, unnest(r.saiu) AS u FROM r JOIN ch ON ch.symbol = r.symbol AND ch.dt = r.dt AND ch.side = r.side AND ch.i = r.i))"""


@R.add(f"{_EVENTS} SELECT symbol, dt, side, seq, em, tipo, price, quantidade, agente FROM ev")
def n03_level_events(spark, d):
    """Every entry and exit of an offer, with what it was worth then."""
    return book_events(spark, d)


@R.add(f"""{_EVENTS}, l AS (SELECT *, lag(tipo) OVER w AS t0, lag(em) OVER w AS e0 FROM ev WINDOW w AS (PARTITION BY symbol, dt, side, price, quantidade, agente ORDER BY em, seq)),
f AS (SELECT * FROM l WHERE tipo = 'entrada' AND t0 <> 'entrada' AND em - e0 <= 5000000000),
c AS (SELECT *, CASE WHEN coalesce(em - lag(em) OVER w <= 5000000000, false) THEN 0 ELSE 1 END AS novo FROM f WINDOW w AS (PARTITION BY symbol, dt, side, price, quantidade, agente ORDER BY em, seq)),
n AS (SELECT *, sum(novo) OVER (PARTITION BY symbol, dt, side, price, quantidade, agente ORDER BY em, seq ROWS UNBOUNDED PRECEDING) AS k FROM c),
g AS (SELECT symbol, dt, side, price, quantidade, agente, k, count(*) AS recargas, count(*) FILTER (WHERE t0 = 'saida_varredura') AS av FROM n GROUP BY ALL)
SELECT symbol, recargas, count(*) AS cadeias, sum(av)::bigint AS apos_varredura FROM g GROUP BY ALL""")
def l21_refill_chains(spark, d):
    """Chains of refills by length: how many, and how many of their refills followed a sweep."""
    chains = refill_chains(book_events(spark, d), ["symbol", "dt"], 5 * _S)
    return chains.groupBy("symbol", "recargas").agg(F.count(F.lit(1)).alias("cadeias"), F.sum("apos_varredura").alias("apos_varredura"))


# ---- M: orders on bars and ticks -------------------------------------------------------------------------------------


def entries(spark: SparkSession, d: str) -> DataFrame:
    """Signals against a move, as orders: a limit two cents better than the close, valid from the next minute on."""
    s = _signal(m1(spark, d)).where("lado <> 0")
    return s.select("symbol", "dt", "minuto", "lado", F.round(F.col("close") - 0.02 * F.col("lado"), 6).alias("limite"), ((F.col("minuto") + 1) * MINUTE).alias("em"))


_ENTRIES = f"""{SQL_M1}, sg AS (SELECT *, CASE WHEN close / lag(close) OVER ({_M1W}) - 1 >= {_REL} THEN -1 WHEN close / lag(close) OVER ({_M1W}) - 1 <= -{_REL} THEN 1 ELSE 0 END AS lado FROM m1),
en AS (SELECT symbol, dt, minuto, lado::bigint AS lado, round(close - 0.02 * lado, 6) AS limite, (minuto + 1) * {MINUTE} AS em FROM sg WHERE lado <> 0),
cd AS (SELECT en.symbol, en.dt, en.minuto, t.ts_ns, {{'a': t.ts_ns, 'b': t.ts_recv_ns, 'c': t.trade_id}} AS o, t.price AS p, CASE WHEN lado > 0 THEN t.price < limite ELSE t.price > limite END AS x FROM en JOIN tape t ON t.symbol = en.symbol AND t.dt = en.dt AND t.ts_ns >= en.em AND t.ts_ns < en.em + {5 * MINUTE}),
fl AS (SELECT symbol, dt, minuto, arg_min({{'t': ts_ns, 'p': p, 'x': x}}, o) AS a, arg_min(ts_ns, o) FILTER (WHERE x) AS b FROM cd GROUP BY ALL),
fi AS (SELECT en.*, CASE WHEN a['x'] THEN 'abertura' WHEN b IS NOT NULL THEN 'recuo' END AS execucao, CASE WHEN a['x'] THEN a['p'] WHEN b IS NOT NULL THEN limite END AS entrada, b AS entrada_ns FROM en LEFT JOIN fl USING (symbol, dt, minuto))"""

_LEG = {"stop": 0.06, "targets": (0.05, 0.1), "trail_from": 0.04, "trail_to": 0.02, "trail_step": 0.01, "flat_ns": 30 * MINUTE}
_X = "round(pa.lado * (pa.p - pa.entrada), 9)"


@R.add(f"""WITH RECURSIVE {_ENTRIES},
pa AS (SELECT fi.symbol, fi.dt, fi.minuto, fi.lado, fi.entrada, t.ts_ns, t.price AS p, row_number() OVER (PARTITION BY fi.symbol, fi.dt, fi.minuto ORDER BY t.ts_ns, t.ts_recv_ns, t.trade_id) AS i FROM fi JOIN tape t ON t.symbol = fi.symbol AND t.dt = fi.dt AND t.ts_ns > fi.entrada_ns AND t.ts_ns <= fi.entrada_ns + {_LEG['flat_ns']} WHERE fi.entrada IS NOT NULL),
st AS (SELECT DISTINCT symbol, dt, minuto, 0::bigint AS i, -{_LEG['stop']}::double AS l1, -{_LEG['stop']}::double AS l2, 0.0::double AS best, false AS ativo, NULL::double AS r1, NULL::double AS r2, 0 AS m1, 0 AS m2, 0.0::double AS u FROM pa
  UNION ALL SELECT st.symbol, st.dt, st.minuto, pa.i, l1,
    CASE WHEN NOT ativo AND {_X} >= {_LEG['trail_from']} THEN {_LEG['trail_to']} WHEN ativo AND {_X} - best >= {_LEG['trail_step']} THEN l2 + ({_X} - best) ELSE l2 END,
    CASE WHEN NOT ativo AND {_X} >= {_LEG['trail_from']} OR ativo AND {_X} - best >= {_LEG['trail_step']} THEN {_X} ELSE best END, ativo OR {_X} >= {_LEG['trail_from']},
    CASE WHEN r1 IS NOT NULL THEN r1 WHEN {_X} <= l1 THEN l1 WHEN {_X} >= {_LEG['targets'][0]} THEN {_LEG['targets'][0]} END, CASE WHEN r2 IS NOT NULL THEN r2 WHEN {_X} <= l2 THEN l2 WHEN {_X} >= {_LEG['targets'][1]} THEN {_LEG['targets'][1]} END,
    CASE WHEN r1 IS NOT NULL THEN m1 WHEN {_X} <= l1 THEN 2 WHEN {_X} >= {_LEG['targets'][0]} THEN 1 ELSE 0 END, CASE WHEN r2 IS NOT NULL THEN m2 WHEN {_X} <= l2 THEN 2 WHEN {_X} >= {_LEG['targets'][1]} THEN 1 ELSE 0 END, {_X}
  FROM st JOIN pa ON pa.symbol = st.symbol AND pa.dt = st.dt AND pa.minuto = st.minuto AND pa.i = st.i + 1 WHERE st.r1 IS NULL OR st.r2 IS NULL),
z AS (SELECT st.*, pa.ts_ns FROM st JOIN pa USING (symbol, dt, minuto, i) QUALIFY row_number() OVER (PARTITION BY st.symbol, st.dt, st.minuto ORDER BY st.i DESC) = 1)
SELECT fi.symbol, fi.dt, fi.minuto, fi.lado, execucao, entrada, entrada_ns, round(coalesce(r1, u), 6) + 0.0 AS p1, m1::bigint AS m1, round(coalesce(r2, u), 6) + 0.0 AS p2, m2::bigint AS m2, ts_ns AS saida_ns FROM fi LEFT JOIN z ON z.symbol = fi.symbol AND z.dt = fi.dt AND z.minuto = fi.minuto""")
def m09_tick_replay(spark, d):
    """Limit orders replayed on the tape: fill by opening or retreat, a fixed leg and a trailing one, stop before target, flat after half an hour."""
    return tick_replay(entries(spark, d), tape_once(spark, d)).select("symbol", "dt", "minuto", "lado", "execucao", "entrada", "entrada_ns", r6("p1").alias("p1"), "m1", r6("p2").alias("p2"), "m2", "saida_ns")


def tick_replay(orders: DataFrame, t: DataFrame) -> DataFrame:
    ident = ["symbol", "dt", "minuto"]
    return leg_exits(limit_fills(orders, t, ["symbol", "dt"], ident, 5 * MINUTE), t, ["symbol", "dt"], ident, **_LEG)


@R.add(f"""WITH {SQL_M1}, sg AS (SELECT *, CASE WHEN close / lag(close) OVER ({_M1W}) - 1 >= {_REL} THEN -1 WHEN close / lag(close) OVER ({_M1W}) - 1 <= -{_REL} THEN 1 ELSE 0 END AS lado, row_number() OVER ({_M1W}) AS i, count(*) OVER (PARTITION BY symbol, dt) AS n FROM m1),
f AS (SELECT s.symbol, s.dt, s.minuto, s.lado, s.close AS c, f.i - s.i AS k, f.close AS fc, CASE WHEN s.lado > 0 THEN f.low ELSE f.high END AS e, CASE WHEN s.lado > 0 THEN f.low <= s.close - 0.03 * s.lado ELSE f.high >= s.close - 0.03 * s.lado END AS t FROM sg s JOIN sg f ON f.symbol = s.symbol AND f.dt = s.dt AND f.i BETWEEN s.i + 1 AND s.i + 10 WHERE s.lado <> 0 AND s.i + 10 <= s.n),
g AS (SELECT symbol, dt, minuto, any_value(lado) AS lado, any_value(c) AS c, min({{'k': k, 'e': e}}) FILTER (WHERE t) AS x, max({{'k': k, 'c': fc}}) AS u FROM f GROUP BY ALL)
SELECT symbol, dt, minuto, lado::bigint AS lado, x['k'] AS barra, round((u['c'] - x['e']) * lado, 6) + 0.0 AS rem_pessimista, round((u['c'] - (c - 0.03 * lado)) * lado, 6) + 0.0 AS rem_otimista FROM g WHERE x IS NOT NULL""")
def m04_remaining(spark, d):
    """What is left after the price has gone three cents against an entry, filled at the level and at the bar's extreme."""
    out = remaining_after_touch(_signal(m1(spark, d)), ["symbol", "dt"], "minuto", "lado", 0.03, 10)
    return out.select("symbol", "dt", "minuto", "lado", F.col("barra").cast("bigint").alias("barra"), r6("rem_pessimista").alias("rem_pessimista"), r6("rem_otimista").alias("rem_otimista"))


@R.add(f"""WITH {SQL_TOP}, {SQL_TAPE}, {_BIG}, o AS (SELECT e.symbol, e.dt, e.trade_id, e.ts_ns, p.bid AS preco FROM ev e ASOF JOIN (SELECT symbol, dia, ts_recv_ns, max({{'a': topo_id, 'b': bid}})['b'] AS bid FROM tp GROUP BY ALL) p ON p.symbol = e.symbol AND p.dia = e.ts_ns // 86400000000000 AND e.ts_ns >= p.ts_recv_ns)
SELECT o.symbol, o.dt, o.trade_id, o.preco, min(tp.ts_recv_ns) - any_value(o.ts_ns) AS espera_ns FROM o LEFT JOIN tp ON tp.symbol = o.symbol AND tp.dia = o.ts_ns // 86400000000000 AND tp.ts_recv_ns > o.ts_ns AND tp.ts_recv_ns <= o.ts_ns + {5 * MINUTE} AND (tp.ask <= o.preco + 1e-9 OR tp.bid < o.preco - 1e-9) WHERE o.preco IS NOT NULL GROUP BY ALL""")
def m14_passive_fill(spark, d):
    """Buys resting at the bid as of a large trade: how long until the top of the book says, at its most pessimistic, that they are filled."""
    from ..operators.asof import asof_backward

    tops = top_of_book(quotes(spark, d)).select("symbol", "dia", "ts_recv_ns", "topo_id", "bid", "ask")
    e = big_buys(tape_once(spark, d)).select("symbol", "dt", "trade_id", "ts_ns", F.expr("ts_ns div 86400000000000").alias("dia"))
    path = tops.select("symbol", "dia", F.col("ts_recv_ns").alias("ts_ns"), "topo_id", F.coalesce("bid", F.lit(-1.0)).alias("preco"))
    o = asof_backward(e, path, ["symbol", "dia"], "ts_ns", ["preco"], tie=["topo_id"], slice_size=B.SLICE_NS).where("preco > 0").withColumns({"lado": F.lit(1), "em": F.col("ts_ns")})
    out = passive_fill(o, tops, ["symbol", "dia"], ["symbol", "dt", "trade_id"], 5 * MINUTE)
    return out.select("symbol", "dt", "trade_id", "preco", (F.col("execucao_ns") - F.col("ts_ns")).alias("espera_ns"))


_H3 = (5, 15, 30)


@R.add(f"WITH {SQL_M1} SELECT symbol, dt, minuto, " + ", ".join(f"round(CASE WHEN count(*) OVER w{h} = {h} THEN greatest(max(high) OVER w{h} - close, 0.0) END, 6) AS mfe_{h}, round(CASE WHEN count(*) OVER w{h} = {h} THEN least(min(low) OVER w{h} - close, 0.0) END, 6) + 0.0 AS mae_{h}, round(CASE WHEN count(*) OVER w{h} = {h} THEN greatest(max(close) OVER w{h} - close, 0.0) END, 6) AS mfe_fecho_{h}, round(CASE WHEN count(*) OVER w{h} = {h} THEN least(min(close) OVER w{h} - close, 0.0) END, 6) + 0.0 AS mae_fecho_{h}" for h in _H3) + " FROM m1 WINDOW " + ", ".join(f"w{h} AS ({_M1W} ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING)" for h in _H3))
def m01b_excursions_by_horizon(spark, d):
    """Best and worst moves within three horizons, inside bars and by closes only."""
    bars, out = m1(spark, d), {}
    for h in _H3:
        w = in_minutes().rowsBetween(1, h)
        full = F.count(F.lit(1)).over(w) == h
        for name, top, low in (("", "high", "low"), ("_fecho", "close", "close")):
            out[f"mfe{name}_{h}"] = r6(F.when(full, F.greatest(F.max(top).over(w) - F.col("close"), F.lit(0.0))))
            out[f"mae{name}_{h}"] = r6(F.when(full, F.least(F.min(low).over(w) - F.col("close"), F.lit(0.0))))
    return bars.select("symbol", "dt", "minuto", *(c.alias(n) for n, c in out.items()))


# ---- O: coefficients by fold and horizon, and the verdict -------------------------------------------------------------

_HZ = (1, 3, 10)
_FEATURES = ("imbalance", "rlp_frac", "absorcao_dir")
_IC = f"""{SQL_FLOW}, bd AS (SELECT DISTINCT symbol, bar_id, dt FROM barred), dn AS (SELECT dt, dense_rank() OVER (ORDER BY dt) AS n FROM (SELECT DISTINCT dt FROM tape)),
fo AS (SELECT dt, (n - 2)::bigint AS fold FROM dn WHERE n > 1),
fx AS (SELECT symbol, bar_id, dt, imbalance, rlp_frac, imbalance - desloc_norm AS absorcao_dir, {", ".join(f"lead(close, {h}) OVER (PARTITION BY symbol ORDER BY bar_id) / close - 1 AS r{h}" for h in _HZ)} FROM flow JOIN bd USING (symbol, bar_id)),
lg AS ({" UNION ALL ".join(f"SELECT symbol, dt, '{f}' AS feature, {h}::bigint AS horizonte, round({f}, 9) AS x, round(r{h}, 12) AS y FROM fx" for f in _FEATURES for h in _HZ)}),
lf AS (SELECT lg.*, fold FROM lg JOIN fo USING (dt) WHERE x IS NOT NULL AND y IS NOT NULL),
rk AS (SELECT *, rank() OVER (PARTITION BY symbol, feature, horizonte, fold ORDER BY x) + (count(*) OVER (PARTITION BY symbol, feature, horizonte, fold, x) - 1) / 2.0 AS a, rank() OVER (PARTITION BY symbol, feature, horizonte, fold ORDER BY y) + (count(*) OVER (PARTITION BY symbol, feature, horizonte, fold, y) - 1) / 2.0 AS b FROM lf),
ic AS (SELECT symbol, feature, horizonte, fold, count(*) AS n, round(CASE WHEN count(*) >= 10 AND stddev_samp(a) > 0 AND stddev_samp(b) > 0 THEN corr(a, b) END, 6) AS ic FROM rk GROUP BY ALL),
ag AS (SELECT symbol, feature, horizonte, count(ic) AS folds, sum(n)::bigint AS n, avg(ic) AS media, CASE WHEN count(ic) >= 2 THEN stddev_samp(ic) END AS sd, greatest(count(*) FILTER (WHERE ic > 0), count(*) FILTER (WHERE ic < 0)) / nullif(count(ic), 0) AS consistencia FROM ic GROUP BY ALL)"""


def coefficients(spark: SparkSession, d: str) -> DataFrame:
    """Spearman's coefficient per symbol, feature, horizon and fold of whole days."""
    t = tape_once(spark, d)
    rows = t.join(table(spark, d, "ativos", "symbol", "tick"), "symbol", "left")
    f = B.flow_bars(rows, 20, F.col("tick"), keep_day=True)
    ahead = {f"r{h}": F.lead("close", h).over(by_bar()) / F.col("close") - 1 for h in _HZ}
    f = f.withColumns(ahead).join(walk_forward(t.select("dt"), "dt", 1, 1).where("fold is not null"), "dt")
    rounded = [F.round(c, 9).alias(c) for c in _FEATURES]
    long = f.select("symbol", "fold", *rounded, *(F.round(f"r{h}", 12).alias(f"r{h}") for h in _HZ)).unpivot(["symbol", "fold", *(f"r{h}" for h in _HZ)], list(_FEATURES), "feature", "x")
    pairs = F.explode(F.array(*(F.struct(F.lit(h).cast("bigint").alias("h"), F.col(f"r{h}").alias("y")) for h in _HZ)))
    long = long.withColumn("_y", pairs).select("symbol", "feature", F.col("_y.h").alias("horizonte"), "fold", "x", F.col("_y.y").alias("y"))
    return information_coefficient(long, ["symbol", "feature", "horizonte", "fold"], "x", "y").withColumn("ic", r6("ic"))


def over_folds(ic: DataFrame) -> DataFrame:
    n = F.count("ic")
    same = F.greatest(F.count_if(F.col("ic") > 0), F.count_if(F.col("ic") < 0)) / F.nullif(n, F.lit(0))
    return ic.groupBy("symbol", "feature", "horizonte").agg(n.alias("folds"), F.sum("n").alias("n"), F.avg("ic").alias("media"), F.when(n >= 2, F.stddev_samp("ic")).alias("sd"), same.alias("consistencia"))


_TSTAT = "CASE WHEN folds >= 2 AND sd > 1e-12 THEN media / (sd / sqrt(folds)) END"


@R.add(f"WITH {_IC} SELECT symbol, feature, horizonte, folds, n, round(media, 5) + 0.0 AS media, round(sd, 5) AS sd, round({_TSTAT}, 4) + 0.0 AS t, round(consistencia, 6) AS consistencia FROM ag")
def o02b_coefficients_by_horizon(spark, d):
    """Mean, deviation, t and consistency of sign over folds, per feature and horizon."""
    a = over_folds(coefficients(spark, d))
    return a.select("symbol", "feature", "horizonte", "folds", "n", r6("media", 5).alias("media"), r6("sd", 5).alias("sd"), r6(F.expr(_TSTAT), 4).alias("t"), r6("consistencia").alias("consistencia"))


#: t of 3 standard errors at as many degrees of freedom as folds less one, from the normal by Cornish and Fisher: z + (z³ + z)/4ν + (5z⁵ + 16z³ + 3z)/96ν².
_Z = 3.0
_TCRIT = f"({_Z} + ({_Z ** 3} + {_Z}) / (4.0 * (folds - 1)) + (5.0 * {_Z ** 5} + 16.0 * {_Z ** 3} + 3.0 * {_Z}) / (96.0 * (folds - 1) * (folds - 1)))"


@R.add(f"WITH {_IC}, v AS (SELECT *, {_TSTAT} AS t FROM ag) SELECT symbol, feature, horizonte, CASE WHEN folds < 4 OR t IS NULL THEN 'inconclusivo' WHEN abs(media) >= 2 / sqrt(greatest(n, 1)) AND abs(t) >= {_TCRIT} AND consistencia >= 0.7 THEN 'segue' WHEN abs(media) >= 2 / sqrt(greatest(n, 1)) AND abs(t) < {_TCRIT} AND consistencia >= 0.85 THEN 'inconclusivo' ELSE 'descarta' END AS veredito FROM v")
def o03_verdict(spark, d):
    """Magnitude beyond the noise of the observations, stability over folds, one sign: all three, or a cell is dropped; lacking stability alone it stays open."""
    a = over_folds(coefficients(spark, d)).withColumn("t", F.expr(_TSTAT))
    return a.select("symbol", "feature", "horizonte", verdict(F.col("folds"), F.col("n"), F.col("media"), F.col("t"), F.col("consistencia"), F.expr(_TCRIT)).alias("veredito"))


# ---- P, Q: descriptive -----------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_M1}, r AS (SELECT symbol, abs(close / open - 1) AS m, CASE WHEN close > open THEN 'compra' ELSE 'venda' END AS lado, lead(close) OVER ({_M1W}) / close - 1 AS y FROM m1 WHERE close <> open) SELECT symbol, lado, count(*) AS n, round(1.96 * stddev_samp(y) / sqrt(count(*)), 9) AS emd, round(avg(y), 9) + 0.0 AS media, abs(avg(y)) >= 1.96 * stddev_samp(y) / sqrt(count(*)) AS detectavel FROM r WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10")
def mk20_effect_by_side(spark, d):
    """The smallest detectable next-bar return on either side, and whether the mean reaches it."""
    bars = m1(spark, d).where("close <> open").withColumns({"lado": F.when(F.col("close") > F.col("open"), "compra").otherwise("venda"), "y": F.lead("close").over(in_minutes()) / F.col("close") - 1}).where("y is not null")
    a = bars.groupBy("symbol", "lado").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("y").alias("sd"), F.avg("y").alias("m")).where("n >= 10")
    emd = 1.96 * F.col("sd") / F.sqrt("n")
    return a.select("symbol", "lado", "n", r6(emd, 9).alias("emd"), r6("m", 9).alias("media"), (F.abs("m") >= emd).alias("detectavel"))


_FLOORS = (0.01, 0.02, 0.05, 0.1)


@R.add(f"WITH {SQL_M1}, dia AS (SELECT symbol, dt, arg_min(open, minuto) AS o, arg_max(close, minuto) AS c FROM m1 GROUP BY ALL), g AS (SELECT symbol, round(abs(o - lag(c) OVER (PARTITION BY symbol ORDER BY dt)), 6) AS gap FROM dia) SELECT symbol, count(gap) AS dias, " + ", ".join(f"count(*) FILTER (WHERE gap >= {x}) AS piso_{i}" for i, x in enumerate(_FLOORS)) + " FROM g GROUP BY symbol")
def mk12_gap_floors(spark, d):
    """How many opening gaps alternative floors would leave: counts only."""
    day = m1(spark, d).groupBy("symbol", "dt").agg(F.min_by("open", "minuto").alias("o"), F.max_by("close", "minuto").alias("c"))
    g = day.withColumn("gap", r6(F.abs(F.col("o") - F.lag("c").over(Window.partitionBy("symbol").orderBy("dt")))))
    return g.groupBy("symbol").agg(F.count("gap").alias("dias"), *(F.count_if(F.col("gap") >= x).alias(f"piso_{i}") for i, x in enumerate(_FLOORS)))


@R.add(f"WITH {SQL_TAPE}, s AS (SELECT symbol, dt, max(ts_ns) - min(ts_ns) AS v FROM tape GROUP BY ALL) SELECT symbol, dt, (v // {10 * MINUTE} + 1)::bigint AS maximo FROM s")
def mk18_most_ignitions(spark, d):
    """The most events a day's span can hold with ten minutes of rest."""
    s = tape(spark, d).groupBy("symbol", "dt").agg((F.max("ts_ns") - F.min("ts_ns")).alias("_v"))
    return s.select("symbol", "dt", F.expr(f"_v div {10 * MINUTE} + 1").alias("maximo"))


@R.add(f"""WITH {_M5}, o AS (SELECT symbol, dt, count(*) AS n, sum(resultado) AS r FROM res GROUP BY ALL), t AS (SELECT symbol, sum(n)::bigint AS operacoes, count(*) AS dias, max(dt) AS ate, sum(n) / count(*) AS ritmo FROM o GROUP BY symbol),
fa AS (SELECT *, ceil((1000 - operacoes) / ritmo)::bigint AS faltam FROM t)
SELECT symbol, operacoes, dias, round(ritmo, 6) AS ritmo, greatest(faltam, 0) AS dias_uteis, strftime(list_filter(generate_series(fa.ate::date + 1, fa.ate::date + 1 + greatest(faltam, 1)::int * 2 + 7, INTERVAL 1 DAY), lambda d: isodow(d) <= 5)[greatest(faltam, 1)], '%Y-%m-%d') AS previsao FROM fa""")
def mk15_goal_progress(spark, d):
    """Operations so far, their pace a session, and the business day on which a thousand would be reached."""
    o = resolved(spark, d).groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("n"))
    t = o.groupBy("symbol").agg(F.sum("n").alias("operacoes"), F.count(F.lit(1)).alias("dias"), F.max("dt").alias("ate")).withColumn("ritmo", F.col("operacoes") / F.col("dias"))
    t = t.withColumn("_f", F.greatest(F.ceil((1000 - F.col("operacoes")) / F.col("ritmo")), F.lit(0)).cast("bigint"))
    need, start = F.greatest(F.col("_f"), F.lit(1)), F.weekday(F.to_date("ate"))
    # whole weeks carry five business days; a start at the weekend counts as Friday
    weekday, k = F.least(start, F.lit(4)), F.expr("greatest(_f, 1)")
    moved = F.expr("least(weekday(to_date(ate)), 4)") + k
    days = F.expr("(least(weekday(to_date(ate)), 4) + greatest(_f, 1)) div 5") * 7 + F.pmod(moved, F.lit(5)) - weekday - (start - weekday)
    return t.select("symbol", "operacoes", "dias", r6("ritmo").alias("ritmo"), F.col("_f").alias("dias_uteis"), F.date_format(F.date_add(F.to_date("ate"), days.cast("int")), "yyyy-MM-dd").alias("previsao"))


_PHASES = ((0, "aquecimento"), (2, "coleta"), (5, "avaliacao"))


@R.add(f"WITH s AS (SELECT DISTINCT dt FROM trades), n AS (SELECT dt, row_number() OVER (ORDER BY dt) - 1 AS k FROM s) SELECT dt, CASE WHEN k >= 5 THEN 'avaliacao' WHEN k >= 2 THEN 'coleta' ELSE 'aquecimento' END AS fase FROM n")
def mk16_plan_phase(spark, d):
    """The phase of a collection plan that each session is in, by its number."""
    s = table(spark, d, "trades", "dt").distinct().withColumn("k", F.row_number().over(Window.orderBy("dt")) - 1)  # one row a session
    phase = F.lit(None).cast("string")
    for least, name in _PHASES:
        phase = F.when(F.col("k") >= least, name).otherwise(phase)
    return s.select("dt", phase.alias("fase"))


_JUMPS = f"j AS (SELECT symbol, dt, minuto, (close - lag(close) OVER ({_M1W})) / lag(close) OVER ({_M1W}) AS rel FROM m1)"


@R.add()
def mk08_matched_events(spark, d):
    """Jumps of the most traded symbol and of each other one: same day and direction, at most two minutes apart, one to one."""
    bars = m1(spark, d)
    top = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "symbol").limit(1).select("symbol")
    before = F.lag("close").over(in_minutes())
    j = bars.withColumn("rel", (F.col("close") - before) / before).where("abs(rel) >= 0.0003").select("symbol", "dt", "minuto", F.signum("rel").cast("bigint").alias("lado"))
    j = greedy_keep(j, ["symbol", "dt", "lado"], "minuto", 5)
    others = j.join(top, "symbol", "left_anti")
    lead = j.join(top, "symbol", "left_semi").drop("symbol").join(others.select("symbol", "dt", "lado").distinct(), ["dt", "lado"])
    pairs = one_to_one(lead, others, ["symbol", "dt", "lado"], "minuto", 2)
    n = others.groupBy("symbol").agg(F.count(F.lit(1)).alias("eventos"))
    met = pairs.groupBy("symbol").agg(F.count(F.lit(1)).alias("pares"), r6(F.avg(F.col("b") - F.col("a"))).alias("atraso_medio"))
    return n.join(met, "symbol", "left").select("symbol", "eventos", F.coalesce("pares", F.lit(0)).alias("pares"), "atraso_medio")


@R.add(f"WITH {SQL_TAPE}, f AS (SELECT symbol, dt, ts_ns, quantidade, CASE WHEN coalesce(ts_ns // 1000 - lag(ts_ns // 1000) OVER w < 60000000, false) THEN 0 ELSE 1 END AS novo FROM tape WINDOW w AS (PARTITION BY symbol, dt ORDER BY ts_ns // 1000)), g AS (SELECT *, sum(novo) OVER (PARTITION BY symbol, dt ORDER BY ts_ns // 1000 RANGE UNBOUNDED PRECEDING) AS k FROM f) SELECT symbol, dt, min(ts_ns // 1000) AS de_us, count(*) AS n, sum(quantidade)::bigint AS volume FROM g GROUP BY symbol, dt, k")
def q14_activity_sessions(spark, d):
    """Bursts of trading without a pause of a minute, as session windows; the same plan runs on a stream."""
    rows = tape(spark, d).withColumn("evento", F.timestamp_micros(F.expr("ts_ns div 1000")))
    s = rows.groupBy("symbol", "dt", F.session_window("evento", "1 minute")).agg(F.count(F.lit(1)).alias("n"), F.sum("quantidade").alias("volume"))
    return s.select("symbol", "dt", F.unix_micros("session_window.start").alias("de_us"), "n", "volume")


@R.add(f"WITH {SQL_TAPE}, w AS (SELECT symbol, unnest([(ts_ns // 60000000000 - o) * 60 for o in range(0, 5)]) AS de_s, price, quantidade FROM tape) SELECT symbol, de_s, count(*) AS n, sum(quantidade)::bigint AS volume, max(price) - min(price) AS amplitude FROM w GROUP BY ALL".replace("[(ts_ns // 60000000000 - o) * 60 for o in range(0, 5)]", "list_transform(range(0, 5), lambda o: (ts_ns // 60000000000 - o) * 60)"))
def q14b_sliding_windows(spark, d):
    """Five-minute windows that start every minute."""
    rows = tape(spark, d).withColumn("evento", F.timestamp_micros(F.expr("ts_ns div 1000")))
    w = rows.groupBy("symbol", F.window("evento", "5 minutes", "1 minute")).agg(F.count(F.lit(1)).alias("n"), F.sum("quantidade").alias("volume"), (F.max("price") - F.min("price")).alias("amplitude"))
    return w.select("symbol", F.expr("unix_micros(window.start) div 1000000").alias("de_s"), "n", "volume", "amplitude")


QUERIES, ORACLES = R.queries, R.sql
