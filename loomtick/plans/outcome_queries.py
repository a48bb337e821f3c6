"""Outcomes of events, regimes, inventories and validations: further clauses, named by their inventory rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalars import nearest_wednesday
from ..operators.asof import asof_backward, first_hit, range_join
from ..operators.bars import SLICE_NS, infer_tick
from ..operators.fold import greedy_keep
from ..operators.quotes import crossed_episodes, top_of_book
from ..operators.stats import welch_t
from ..operators.tape import is_aggressor
from ..operators.windows import correlation
from ..sources.tables import table
from .registry import SQL_SYMBOL, SQL_TAPE, Registry, quotes, r6, tape, tape_once
from .research_queries import _M5, ORACLES as RESEARCH_SQL
from .research_queries import SQL_FLOW, SQL_TOP, by_bar, flow, ignitions, l06_lead_lag, resolved
from .tape_queries import _BIG, _M1W, _P, MINUTE, ORACLES as TAPE_SQL
from .tape_queries import SQL_M1, big_buys, h06_local_date, in_minutes, m1

R = Registry()
_S = 1_000_000_000

# ---- E, N: gaps and quotes --------------------------------------------------------------------------------------------


@R.add(f"""WITH t AS (SELECT DISTINCT {SQL_SYMBOL} AS symbol, dt::date AS dia FROM trades), l AS (SELECT min(dia) AS a, max(dia) AS b FROM t), c AS (SELECT d::date AS dia, row_number() OVER (ORDER BY d) AS k FROM (SELECT unnest(generate_series(l.a, l.b, INTERVAL 1 DAY)) AS d FROM l) WHERE isodow(d) <= 5),
f AS (SELECT s.symbol, c.dia, c.k, c.k - row_number() OVER (PARTITION BY s.symbol ORDER BY c.k) AS g FROM (SELECT {SQL_SYMBOL} AS symbol FROM ativos) s, c WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.symbol = s.symbol AND t.dia = c.dia))
SELECT symbol, strftime(min(dia), '%Y-%m-%d') AS de, strftime(max(dia), '%Y-%m-%d') AS ate, count(*) AS dias_uteis, count(*) >= 5 AS buraco FROM f GROUP BY symbol, g""")
def e23b_missing_runs(spark, d):
    """Runs of business days without a trade, over all listed symbols; a weekend inside doesn't break one, five days make a hole."""
    t = table(spark, d, "trades", "symbol", "dt").distinct().withColumn("dia", F.to_date("dt"))
    span = t.agg(F.min("dia").alias("a"), F.max("dia").alias("b"))
    calendar = span.select(F.explode(F.sequence("a", "b")).alias("dia")).where("weekday(dia) <= 4").withColumn("k", F.row_number().over(Window.orderBy("dia")))
    wanted = table(spark, d, "ativos", "symbol").crossJoin(F.broadcast(calendar))  # symbols × weekdays, the report's own size
    missing = wanted.join(t, ["symbol", "dia"], "left_anti").withColumn("g", F.col("k") - F.row_number().over(Window.partitionBy("symbol").orderBy("k")))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    runs = missing.groupBy("symbol", "g").agg(day(F.min("dia")).alias("de"), day(F.max("dia")).alias("ate"), F.count(F.lit(1)).alias("dias_uteis"))
    return runs.select("symbol", "de", "ate", "dias_uteis", (F.col("dias_uteis") >= 5).alias("buraco"))


@R.add(f"WITH e AS ({RESEARCH_SQL['n04_crossed_episodes']}) SELECT symbol, count(*) AS episodios, sum(n)::bigint AS cotacoes, " + ", ".join(f"round(quantile_cont(duracao_ns::double, {q}) / 1e6, 3) AS p{int(100 * q)}_ms" for q in (0.5, 0.9, 0.99)) + ", round(max(duracao_ns) / 1e6, 3) AS maior_ms FROM e GROUP BY symbol")
def n04b_crossed_durations(spark, d):
    """How long crossed books last: percentiles over a symbol's episodes."""
    e = crossed_episodes(top_of_book(quotes(spark, d)))
    at = lambda q: r6(F.percentile(F.col("duracao_ns").cast("double"), F.lit(q)) / 1e6, 3).alias(f"p{int(100 * q)}_ms")
    return e.groupBy("symbol").agg(F.count(F.lit(1)).alias("episodios"), F.sum("n").alias("cotacoes"), at(0.5), at(0.9), at(0.99), r6(F.max("duracao_ns") / 1e6, 3).alias("maior_ms"))


# ---- H: intervals and grids --------------------------------------------------------------------------------------------


@R.add(f"""WITH {_M5}, x AS (SELECT symbol, dt, round(resultado, 6) AS r FROM res), m AS (SELECT symbol, avg(r) AS m, var_samp(r) AS v, count(*) AS n FROM x GROUP BY symbol), c AS (SELECT x.symbol, x.dt, sum(r - m) AS e FROM x JOIN m USING (symbol) GROUP BY ALL),
k AS (SELECT symbol, sum(e * e) AS ss, count(*) AS dias FROM c GROUP BY symbol)
SELECT symbol, n, dias, round(m, 6) + 0.0 AS media, round(sqrt(v / n), 6) AS erro, round(sqrt(ss / (n * n) * dias / (dias - 1)), 6) AS erro_por_dia, round(ss / (n * n) * dias / (dias - 1) / (v / n), 4) AS efeito_de_desenho FROM m JOIN k USING (symbol) WHERE n >= 10 AND dias >= 2 AND v > 1e-12""")
def h16b_design_effect(spark, d):
    """The standard error of a mean result with days as clusters, over the one that takes operations as independent."""
    x = resolved(spark, d).select("symbol", "dt", r6("resultado").alias("r"))
    day = x.groupBy("symbol", "dt").agg(F.sum("r").alias("s"), F.count(F.lit(1)).alias("k"), F.sum(F.col("r") * F.col("r")).alias("q"))
    w = Window.partitionBy("symbol")
    day = day.withColumn("m", F.sum("s").over(w) / F.sum("k").over(w)).withColumn("e", F.col("s") - F.col("k") * F.col("m"))
    a = day.groupBy("symbol").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("dias"), F.first("m").alias("m"), F.sum("q").alias("q"), F.sum(F.col("e") * F.col("e")).alias("ss"))
    n = F.col("n")
    a = a.withColumns({"v": (F.col("q") - n * F.col("m") * F.col("m")) / (n - 1), "c": F.col("ss") / (n * n) * F.col("dias") / (F.col("dias") - 1)}).where("n >= 10 and dias >= 2 and v > 1e-12")
    return a.select("symbol", "n", "dias", r6("m").alias("media"), r6(F.sqrt(F.col("v") / n)).alias("erro"), r6(F.sqrt("c")).alias("erro_por_dia"), r6(F.col("c") / (F.col("v") / n), 4).alias("efeito_de_desenho"))


@R.add(f"WITH {SQL_TAPE}, p AS (SELECT DISTINCT symbol, round(price, 4) AS p FROM tape), s AS (SELECT symbol, round(lead(p) OVER (PARTITION BY symbol ORDER BY p) - p, 4) AS s FROM p), m AS (SELECT symbol, min(s) AS grao, count(*) AS passos FROM s WHERE s > 0 GROUP BY symbol) SELECT m.symbol, grao, passos, round(grao / tick, 4) AS fator, count(*) FILTER (WHERE s.s = grao) AS no_grao FROM m JOIN s ON s.symbol = m.symbol JOIN (SELECT {SQL_SYMBOL} AS symbol, tick FROM ativos) a ON a.symbol = m.symbol GROUP BY m.symbol, grao, passos, tick")
def h17b_grid_factor(spark, d):
    """The grain of the prices a symbol really had, how often neighbouring levels are one grain apart, and the grain over the official tick."""
    p = tape(spark, d).select("symbol", F.round("price", 4).alias("p")).distinct()
    s = p.withColumn("s", F.round(F.lead("p").over(Window.partitionBy("symbol").orderBy("p")) - F.col("p"), 4)).where("s > 0")
    per = s.groupBy("symbol", "s").agg(F.count(F.lit(1)).alias("n")).groupBy("symbol").agg(F.min("s").alias("grao"), F.sum("n").alias("passos"), F.min_by("n", "s").alias("no_grao"))
    return per.join(table(spark, d, "ativos", "symbol", "tick"), "symbol").select("symbol", "grao", "passos", r6(F.col("grao") / F.col("tick"), 4).alias("fator"), "no_grao")


# ---- L: outcomes and regimes -------------------------------------------------------------------------------------------

_LIM = 0.0003


@R.add(f"""WITH ev AS ({RESEARCH_SQL['l01b_trade_ignitions']}), {SQL_TAPE}, {_P}, top AS (SELECT symbol FROM tape GROUP BY symbol ORDER BY count(*) DESC, symbol LIMIT 1),
e AS (SELECT ev.*, sign(movimento)::bigint AS lado FROM ev WHERE symbol NOT IN (SELECT symbol FROM top)), lp AS (SELECT dt, ts_ns, w['p'] AS p FROM p WHERE symbol IN (SELECT symbol FROM top)),
a AS (SELECT e.*, lp.p AS l1 FROM e ASOF LEFT JOIN lp ON lp.dt = e.dt AND e.ts_ns >= lp.ts_ns), b AS (SELECT a.*, lp.p AS l0 FROM (SELECT *, ts_ns - {MINUTE} AS antes FROM a) a ASOF LEFT JOIN lp ON lp.dt = a.dt AND a.antes >= lp.ts_ns),
g AS (SELECT b.*, CASE WHEN l0 IS NULL OR l1 IS NULL THEN 'sem_lider' WHEN lado * (l1 - l0) >= {_LIM} * l0 - 1e-9 THEN 'confirma' WHEN lado * (l1 - l0) <= -{_LIM} * l0 + 1e-9 THEN 'contra' ELSE 'neutra' END AS classe FROM b),
s AS (SELECT g.symbol, g.dt, g.ts_ns, any_value(classe) AS classe, any_value(lado) AS lado, greatest(coalesce(max(round(g.lado * (t.price - g.price), 6)) FILTER (WHERE t.ts_ns > g.ts_ns), 0), 0) AS mfe, least(coalesce(min(round(g.lado * (t.price - g.price), 6)) FILTER (WHERE t.ts_ns > g.ts_ns), 0), 0) AS mae,
  coalesce(sum(CASE t.trade_type WHEN 2 THEN t.quantidade WHEN 3 THEN -t.quantidade END) FILTER (WHERE t.ts_ns <= g.ts_ns), 0)::bigint AS saldo FROM g LEFT JOIN tape t ON t.symbol = g.symbol AND t.dt = g.dt AND t.ts_ns > g.ts_ns - {MINUTE} AND t.ts_ns <= g.ts_ns + {5 * MINUTE} GROUP BY g.symbol, g.dt, g.ts_ns)
SELECT classe, count(*) AS n, round(avg(mfe), 6) AS mfe, round(avg(mae), 6) + 0.0 AS mae, count(*) FILTER (WHERE saldo * lado > 0) AS saldo_a_favor FROM s GROUP BY classe""")
def l03b_ignition_classes(spark, d):
    """Ignitions of all symbols but the most traded one, by what that one did in the same minute: best and worst moves of the next five minutes in
    the event's direction (never below, never above 0), and how often the aggressors of the minute were on its side."""
    t = tape_once(spark, d)
    top = t.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "symbol").limit(1).select("symbol")
    e = ignitions(t).join(top, "symbol", "left_anti").withColumn("lado", F.signum("movimento").cast("bigint"))
    lead = t.join(top, "symbol", "left_semi").select("dt", "ts_ns", "ts_recv_ns", F.col("trade_id").alias("_id"), F.col("price").alias("l1"))
    e = asof_backward(e, lead, ["dt"], "ts_ns", ["l1"], tie=["ts_recv_ns", "_id"], slice_size=SLICE_NS).withColumn("em", F.col("ts_ns"))
    before = lead.withColumnRenamed("l1", "l0")
    e = asof_backward(e.withColumn("ts_ns", F.col("em") - MINUTE), before, ["dt"], "ts_ns", ["l0"], tie=["ts_recv_ns", "_id"], slice_size=SLICE_NS)
    move, limit = F.col("lado") * (F.col("l1") - F.col("l0")), _LIM * F.col("l0") - 1e-9
    kind = F.when(move.isNull(), "sem_lider").when(move >= limit, "confirma").when(move <= -limit, "contra").otherwise("neutra")
    e = e.withColumn("classe", kind).select("symbol", "dt", "em", "price", "lado", "classe", F.col("ts_ns").alias("de"))
    signed = F.when(F.col("trade_type") == 2, F.col("quantidade")).when(F.col("trade_type") == 3, -F.col("quantidade"))
    path = t.select("symbol", "dt", "ts_ns", F.col("price").alias("_p"), signed.alias("_q"))
    met = range_join(e, path, ["symbol", "dt"], "de", "ts_ns", 6 * MINUTE, ["_p", "_q"])
    after, gain = F.col("_at") > F.col("em"), F.round(F.col("lado") * (F.col("_p") - F.col("price")), 6)
    per = met.groupBy("symbol", "dt", "em", "classe", "lado").agg(F.max(F.when(after, gain)).alias("x"), F.min(F.when(after, gain)).alias("i"), F.sum(F.when(~after, F.col("_q"))).alias("s"))
    zero = F.lit(0.0)
    best, worst = F.greatest(F.coalesce("x", zero), zero), F.least(F.coalesce("i", zero), zero)
    return per.groupBy("classe").agg(F.count(F.lit(1)).alias("n"), r6(F.avg(best)).alias("mfe"), r6(F.avg(worst)).alias("mae"), F.count_if(F.coalesce("s", F.lit(0)) * F.col("lado") > 0).alias("saldo_a_favor"))


@R.add(f"WITH l AS ({RESEARCH_SQL['l06_lead_lag']}) SELECT symbol, round(coalesce(sum(correlacao * correlacao) FILTER (WHERE atraso > 0), 0) - coalesce(sum(correlacao * correlacao) FILTER (WHERE atraso < 0), 0), 5) + 0.0 AS assimetria, arg_max(atraso, {{'c': round(abs(correlacao), 4), 'k': -abs(atraso), 's': atraso}}) FILTER (WHERE correlacao IS NOT NULL) AS melhor_atraso FROM l GROUP BY symbol")
def l06b_lag_asymmetry(spark, d):
    """Squared correlations at the leader's positive lags less those at negative ones, and the lag of the largest."""
    c, k = F.col("correlacao"), F.col("atraso")
    side = lambda on: F.coalesce(F.sum(F.when(on, c * c)), F.lit(0.0))
    best = F.max_by(F.when(c.isNotNull(), k), F.when(c.isNotNull(), F.struct(F.round(F.abs(c), 4).alias("c"), (-F.abs(k)).alias("k"), k.alias("s"))))
    return l06_lead_lag(spark, d).groupBy("symbol").agg(r6(side(k > 0) - side(k < 0), 5).alias("assimetria"), best.alias("melhor_atraso"))


@R.add(f"""WITH {SQL_FLOW}, {SQL_TOP.replace(SQL_TAPE + ', ', '')}, b AS (SELECT symbol, bar_id, ts_close, round(rlp_frac, 9) AS x, lead(close) OVER (PARTITION BY symbol ORDER BY bar_id) / close - 1 AS ret FROM flow),
q AS (SELECT symbol, dia, ts_recv_ns, max({{'i': topo_id, 'z': CASE WHEN bid_qtd + ask_qtd > 0 THEN (bid_qtd - ask_qtd) / (bid_qtd + ask_qtd) END}})['z'] AS z FROM tp WHERE bid_qtd IS NOT NULL AND ask_qtd IS NOT NULL GROUP BY ALL),
j AS (SELECT b.*, round(q.z, 9) AS z FROM (SELECT *, ts_close // 86400000000000 AS dia FROM b) b ASOF JOIN q ON q.symbol = b.symbol AND q.dia = b.dia AND b.ts_close >= q.ts_recv_ns), u AS (SELECT * FROM j WHERE z IS NOT NULL AND ret IS NOT NULL AND x IS NOT NULL),
m AS (SELECT symbol, median(x) AS mx, median(z) AS mz FROM u GROUP BY symbol)
SELECT symbol, x > mx AS varejo_alto, z > mz AS livro_comprado, count(*) AS n, round(avg(ret), 9) + 0.0 AS media FROM u JOIN m USING (symbol) GROUP BY ALL""")
def l24b_regimes(spark, d):
    """The next bar's return by two halves at a time: retail share and imbalance of the top of the book at the bar's close, each split at its own median."""
    b = flow(spark, d).select("symbol", "bar_id", F.col("ts_close").alias("ts_ns"), F.round("rlp_frac", 9).alias("x"), (F.lead("close").over(by_bar()) / F.col("close") - 1).alias("ret")).withColumn("dia", F.expr("ts_ns div 86400000000000"))
    bid, ask = F.col("bid_qtd"), F.col("ask_qtd")
    top = top_of_book(quotes(spark, d)).where("bid_qtd is not null and ask_qtd is not null").select("symbol", "dia", F.col("ts_recv_ns").alias("ts_ns"), "topo_id", F.round(F.when(bid + ask > 0, (bid - ask) / (bid + ask)), 9).alias("z"))
    u = asof_backward(b, top, ["symbol", "dia"], "ts_ns", ["z"], tie=["topo_id"], slice_size=SLICE_NS).where("z is not null and ret is not null and x is not null")
    w = u.groupBy("symbol").agg(F.median("x").alias("mx"), F.median("z").alias("mz"))
    return u.join(w, "symbol").groupBy("symbol", (F.col("x") > F.col("mx")).alias("varejo_alto"), (F.col("z") > F.col("mz")).alias("livro_comprado")).agg(F.count(F.lit(1)).alias("n"), r6(F.avg("ret"), 9).alias("media"))


_BARRIER = {"jump": 0.3, "share": 0.5, "rest": 30, "span": 60, "cost": 0.01}


@R.add(f"""WITH RECURSIVE {SQL_M1}, h AS (SELECT symbol, dt, minuto // 60 AS b, max(high) - min(low) AS a FROM m1 GROUP BY ALL), dia AS (SELECT symbol, dt, median(a) AS a FROM h GROUP BY ALL), am AS (SELECT symbol, dt, round(quantile_cont(a, 0.5) OVER (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 9) AS a FROM dia),
j AS (SELECT symbol, dt, minuto, close, round(close - lag(close) OVER ({_M1W}), 9) AS mov, minuto - lag(minuto) OVER ({_M1W}) AS passo FROM m1), c AS (SELECT j.*, am.a FROM j JOIN am USING (symbol, dt) WHERE passo = 1 AND am.a > 0 AND abs(mov) >= {_BARRIER['jump']}::double * am.a - 1e-9),
r AS (SELECT symbol, dt, min(minuto) AS minuto FROM c GROUP BY ALL UNION ALL SELECT r.symbol, r.dt, min(c.minuto) FROM r JOIN c ON c.symbol = r.symbol AND c.dt = r.dt AND c.minuto >= r.minuto + {_BARRIER['rest']} GROUP BY r.symbol, r.dt),
e AS (SELECT c.*, sign(mov)::bigint AS lado, {_BARRIER['share']}::double * c.a AS b FROM r JOIN c USING (symbol, dt, minuto)),
t AS (SELECT e.symbol, e.dt, e.minuto, min({{'m': f.minuto, 'alvo': CASE WHEN lado > 0 THEN round(f.high - e.close, 9) ELSE round(e.close - f.low, 9) END >= b - 1e-9, 'stop': CASE WHEN lado > 0 THEN round(e.close - f.low, 9) ELSE round(f.high - e.close, 9) END >= b - 1e-9}}) AS x FROM e JOIN m1 f ON f.symbol = e.symbol AND f.dt = e.dt AND f.minuto > e.minuto AND f.minuto <= e.minuto + {_BARRIER['span']}
  WHERE greatest(round(f.high - e.close, 9), round(e.close - f.low, 9)) >= b - 1e-9 GROUP BY ALL)
SELECT symbol, dt, minuto, lado, round(mov, 6) AS movimento, round(b, 6) AS barreira, CASE WHEN x IS NULL THEN 'sem_decisao' WHEN x['alvo'] AND x['stop'] THEN 'ambiguo' WHEN x['alvo'] THEN 'alvo' ELSE 'stop' END AS desfecho, x['m'] - minuto AS minutos, round((b + {_BARRIER['cost']}) / (2 * b), 6) AS p_equilibrio FROM e LEFT JOIN t USING (symbol, dt, minuto)""")
def l04b_minute_ignitions(spark, d):
    """Jumps between neighbouring minutes of at least 0.3 of A (the median over up to 20 previous days of their median range of an hour), half an
    hour of rest, which side of ±A/2 the next hour meets first, and the hit rate that pays for the cost."""
    bars, by_day = m1(spark, d), Window.partitionBy("symbol").orderBy("dt").rowsBetween(-20, -1)
    hour = bars.groupBy("symbol", "dt", F.expr("minuto div 60").alias("h")).agg((F.max("high") - F.min("low")).alias("a"))
    am = hour.groupBy("symbol", "dt").agg(F.median("a").alias("a")).select("symbol", "dt", F.round(F.percentile("a", F.lit(0.5)).over(by_day), 9).alias("a"))
    w = in_minutes()
    j = bars.select("symbol", "dt", "minuto", "close", F.round(F.col("close") - F.lag("close").over(w), 9).alias("mov"), (F.col("minuto") - F.lag("minuto").over(w)).alias("passo")).where("passo = 1")
    e = j.join(am, ["symbol", "dt"]).where((F.col("a") > 0) & (F.abs("mov") >= _BARRIER["jump"] * F.col("a") - 1e-9))
    e = greedy_keep(e, ["symbol", "dt"], "minuto", _BARRIER["rest"]).withColumns({"lado": F.signum("mov").cast("bigint"), "b": _BARRIER["share"] * F.col("a")})
    met = range_join(e, bars.select("symbol", "dt", "minuto", F.col("high").alias("h"), F.col("low").alias("l")), ["symbol", "dt"], "minuto", "minuto", _BARRIER["span"], ["h", "l"])
    up, down, b = F.round(F.col("h") - F.col("close"), 9), F.round(F.col("close") - F.col("l"), 9), F.col("b") - 1e-9
    buy = F.col("lado") > 0
    touch = F.struct(F.col("_at").alias("m"), (F.when(buy, up).otherwise(down) >= b).alias("alvo"), (F.when(buy, down).otherwise(up) >= b).alias("stop"))
    x = met.where(F.greatest(up, down) >= b).groupBy("symbol", "dt", "minuto").agg(F.min(touch).alias("x"))
    kind = F.when(F.col("x").isNull(), "sem_decisao").when(F.col("x.alvo") & F.col("x.stop"), "ambiguo").when(F.col("x.alvo"), "alvo").otherwise("stop")
    out = e.join(x, ["symbol", "dt", "minuto"], "left")
    return out.select("symbol", "dt", "minuto", "lado", r6("mov").alias("movimento"), r6("b").alias("barreira"), kind.alias("desfecho"), (F.col("x.m") - F.col("minuto")).alias("minutos"), r6((F.col("b") + _BARRIER["cost"]) / (2 * F.col("b"))).alias("p_equilibrio"))


_TF = (5, 15, 30)


@R.add(f"WITH {SQL_M1}, " + ", ".join(f"k{k} AS (SELECT symbol, dt, (minuto // {k} + 1) * {k} AS fim, arg_max(close, minuto) > arg_min(open, minuto) AS sobe FROM m1 GROUP BY symbol, dt, minuto // {k})" for k in _TF) + ", s AS (SELECT symbol, dt, minuto FROM m1 WHERE close > open), " + ", ".join(f"j{k} AS (SELECT p.*, coalesce(k{k}.sobe, false) AS s{k} FROM {'s' if i == 0 else f'j{_TF[i - 1]}'} p ASOF LEFT JOIN k{k} ON k{k}.symbol = p.symbol AND k{k}.dt = p.dt AND p.minuto >= k{k}.fim)" for i, k in enumerate(_TF)) + f" SELECT symbol, count(*) AS sinais, " + ", ".join(f"count(*) FILTER (WHERE {' AND '.join(f's{x}' for x in _TF[: i + 1])}) AS passa_{k}" for i, k in enumerate(_TF)) + ", count(DISTINCT dt) AS dias FROM j30 GROUP BY symbol")
def l15b_timeframe_funnel(spark, d):
    """Rising minutes of which the last *closed* bars of 5, then 15, then 30 minutes rose as well: survivors, one filter after the other."""
    bars = m1(spark, d)
    s, kept = bars.where("close > open").select("symbol", "dt", "minuto"), F.lit(True)
    aggs = [F.count(F.lit(1)).alias("sinais")]
    for k in _TF:
        b = bars.groupBy("symbol", "dt", F.expr(f"(minuto div {k} + 1) * {k}").alias("_e")).agg((F.max_by("close", "minuto") > F.min_by("open", "minuto")).alias(f"s{k}"))
        s = asof_backward(s, b.withColumnRenamed("_e", "minuto"), ["symbol", "dt"], "minuto", [f"s{k}"])
        kept = kept & F.coalesce(F.col(f"s{k}"), F.lit(False))
        aggs.append(F.count_if(kept).alias(f"passa_{k}"))
    return s.groupBy("symbol").agg(*aggs, F.count_distinct("dt").alias("dias"))


_COVER = lambda x, shift: f"(floor({x} + 0.2 - {shift}) * 0.4 + least({x} + 0.2 - {shift} - floor({x} + 0.2 - {shift}), 0.4))"


@R.add(f"""WITH {SQL_TAPE}, f AS (SELECT symbol, dt, price, quantidade, round(abs(price - round_even(price, 0)), 6) <= 0.2 AS s, round(abs(price - 0.5 - round_even(price - 0.5, 0)), 6) <= 0.2 AS p FROM tape),
g AS (SELECT symbol, dt, sum(quantidade)::bigint AS volume, coalesce(sum(quantidade) FILTER (WHERE s), 0) / sum(quantidade) AS vs, coalesce(sum(quantidade) FILTER (WHERE p), 0) / sum(quantidade) AS vp, min(price) AS lo, max(price) AS hi FROM f GROUP BY ALL)
SELECT symbol, dt, volume, round(vs, 6) AS no_strike, round(vp, 6) AS no_placebo, round(({_COVER('hi', 0)} - {_COVER('lo', 0)}) / (hi - lo), 6) AS cobertura_strike, round(({_COVER('hi', 0.5)} - {_COVER('lo', 0.5)}) / (hi - lo), 6) AS cobertura_placebo FROM g WHERE hi - lo >= 1.0""")
def l23b_strike_magnetism(spark, d):
    """Volume within a fifth of the spacing of whole prices against that of the points midway, with the share of the day's range that either kind
    of band covers: only like coverage makes the comparison fair. Days that span less than one spacing are left out."""
    price = F.col("price")
    near = lambda shift: F.round(F.abs(price - shift - F.bround(price - shift, 0)), 6) <= 0.2
    q = F.col("quantidade")
    share = lambda on: F.sum(F.when(on, q).otherwise(0)) / F.sum(q)
    g = tape(spark, d).groupBy("symbol", "dt").agg(F.sum("quantidade").alias("volume"), share(near(0.0)).alias("vs"), share(near(0.5)).alias("vp"), F.min("price").alias("lo"), F.max("price").alias("hi")).where("hi - lo >= 1.0")
    cover = lambda shift: F.expr(f"({_COVER('hi', shift)} - {_COVER('lo', shift)}) / (hi - lo)")
    return g.select("symbol", "dt", "volume", r6("vs").alias("no_strike"), r6("vp").alias("no_placebo"), r6(cover(0)).alias("cobertura_strike"), r6(cover(0.5)).alias("cobertura_placebo"))


# ---- M, O: tests ---------------------------------------------------------------------------------------------------------

_GRID = (0.01, 0.02, 0.05)


@R.add(f"""WITH {SQL_M1}, p AS (SELECT symbol, dt, minuto, close, count(*) OVER w AS n, min(low) OVER w AS l, last_value(close) OVER w AS f FROM m1 WINDOW w AS ({_M1W} ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING)), k AS (SELECT unnest({list(_GRID)}::double[]) AS x),
g AS (SELECT symbol, x, round(close - l, 6) >= x AS tocou, round(f - close, 6) AS r FROM p, k WHERE n = 10),
s AS (SELECT symbol, x, avg(r) FILTER (WHERE tocou) AS ma, var_samp(r) FILTER (WHERE tocou) AS va, count(*) FILTER (WHERE tocou) AS na, avg(r) FILTER (WHERE NOT tocou) AS mb, var_samp(r) FILTER (WHERE NOT tocou) AS vb, count(*) FILTER (WHERE NOT tocou) AS nb FROM g GROUP BY ALL)
SELECT symbol, x, na AS tocaram, nb AS nao_tocaram, round(ma, 6) + 0.0 AS media_tocou, round(mb, 6) + 0.0 AS media_nao, round(CASE WHEN na >= 2 AND nb >= 2 AND sqrt(va / na + vb / nb) > 1e-12 THEN (ma - mb) / sqrt(va / na + vb / nb) END, 4) + 0.0 AS t FROM s""")
def m03b_reversal_grid(spark, d):
    """Ten bars after a buy at the close: results of those that fell by X on the way against those that didn't, with Welch's t, per X."""
    w = in_minutes().rowsBetween(1, 10)
    p = m1(spark, d).select("symbol", F.count(F.lit(1)).over(w).alias("n"), F.round(F.col("close") - F.min("low").over(w), 6).alias("q"), F.round(F.last("close").over(w) - F.col("close"), 6).alias("r")).where("n = 10")
    p = p.withColumn("x", F.explode(F.array(*map(F.lit, _GRID))))
    of = lambda f, on: f(F.when(on, F.col("r")))
    hit = F.col("q") >= F.col("x")
    s = p.groupBy("symbol", "x").agg(*(of(f, on).alias(n) for on, e in ((hit, "a"), (~hit, "b")) for f, n in ((F.avg, f"m{e}"), (F.var_samp, f"v{e}"), (F.count, f"n{e}"))))
    t = welch_t(*(F.col(c) for c in ("ma", "va", "na", "mb", "vb", "nb")))
    return s.select("symbol", "x", F.col("na").alias("tocaram"), F.col("nb").alias("nao_tocaram"), r6("ma").alias("media_tocou"), r6("mb").alias("media_nao"), r6(t, 4).alias("t"))


@R.add(f"""WITH {SQL_TAPE}, {_BIG}, h AS (SELECT e.symbol, e.dt, e.trade_id, e.price AS nivel, min({{'at': t.ts_ns, 'r': t.ts_recv_ns, 'id': t.trade_id, 'p': t.price}}) AS w FROM ev e JOIN tape t ON t.symbol = e.symbol AND t.dt = e.dt AND t.ts_ns > e.ts_ns AND t.ts_ns <= e.ts_ns + {10 * MINUTE} AND t.price < e.price GROUP BY ALL)
SELECT h.symbol, h.dt, h.trade_id, round(nivel - h.w['p'], 6) AS gemeo, round(nivel - least(min(t.price), h.w['p']), 6) AS pior FROM h LEFT JOIN tape t ON t.symbol = h.symbol AND t.dt = h.dt AND t.ts_ns > h.w['at'] AND t.ts_ns <= h.w['at'] + {2 * _S} GROUP BY h.symbol, h.dt, h.trade_id, nivel, h.w""")
def m13b_crossing_cost(spark, d):
    """Cost against the level of selling at its first crossing (the twin), and at the worst price of the two seconds after it."""
    t, ident = tape_once(spark, d), ["symbol", "dt", "trade_id"]
    path = t.select("symbol", "dt", "ts_ns", "ts_recv_ns", F.col("trade_id").alias("id"), F.col("price").alias("p"))
    e = big_buys(t)
    hit = first_hit(e, path, ["symbol", "dt"], ident, "ts_ns", "ts_ns", 10 * MINUTE, ["ts_recv_ns", "id", "p"], F.col("p") < F.col("price"), ["ts_recv_ns", "id"])
    hit = hit.join(e.select(*ident, F.col("price").alias("nivel")), ident)
    after = range_join(hit, path, ["symbol", "dt"], "hit_at", "ts_ns", 2 * _S, ["p"]).groupBy(*ident).agg(F.min("p").alias("_m"))
    return hit.join(after, ident, "left").select(*ident, r6(F.col("nivel") - F.col("hit_p")).alias("gemeo"), r6(F.col("nivel") - F.least("_m", "hit_p")).alias("pior"))


_CUTS = (0.0001, 0.0002, 0.0005)


@R.add(f"WITH {SQL_M1}, r AS (SELECT symbol, round(close / open - 1, 9) AS m, lead(close) OVER ({_M1W}) / close - 1 AS y FROM m1), k AS (SELECT unnest({list(_CUTS)}::double[]) AS corte), s AS (SELECT symbol, corte, m > 0 AS alta, count(*) AS n, 1.96 * stddev_samp(y) / sqrt(count(*)) AS emd FROM r, k WHERE y IS NOT NULL AND abs(m) >= corte GROUP BY ALL HAVING count(*) >= 10) SELECT symbol, corte, min(n) AS n, round(max(emd), 9) AS emd_pior, count(*) AS lados FROM s GROUP BY ALL")
def o14b_worst_side(spark, d):
    """The smallest detectable effect of the worse side, as the threshold rises."""
    r = m1(spark, d).select("symbol", F.round(F.col("close") / F.col("open") - 1, 9).alias("m"), (F.lead("close").over(in_minutes()) / F.col("close") - 1).alias("y")).where("y is not null")
    r = r.withColumn("corte", F.explode(F.array(*map(F.lit, _CUTS)))).where("abs(m) >= corte")
    s = r.groupBy("symbol", "corte", (F.col("m") > 0).alias("_a")).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("y").alias("sd")).where("n >= 10")
    return s.groupBy("symbol", "corte").agg(F.min("n").alias("n"), r6(F.max(1.96 * F.col("sd") / F.sqrt("n")), 9).alias("emd_pior"), F.count(F.lit(1)).alias("lados"))


@R.add(f"WITH {SQL_FLOW}, x AS (SELECT symbol, ln(vol_compra) AS a, ln(vol_venda) AS b FROM flow WHERE vol_compra > 0 AND vol_venda > 0) SELECT symbol, count(*) AS n, round(var_pop(a), 6) AS var_numerador, round(var_pop(b), 6) AS var_denominador, round(covar_pop(a, b), 6) + 0.0 AS covariancia, round(var_pop(a - b), 6) AS var_razao FROM x GROUP BY symbol HAVING count(*) >= 10")
def o18b_ratio_variance(spark, d):
    """What the variance of a log ratio is made of: both parts and their covariance."""
    x = flow(spark, d).where("vol_compra > 0 and vol_venda > 0").select("symbol", F.log("vol_compra").alias("a"), F.log("vol_venda").alias("b"))
    return x.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), r6(F.var_pop("a")).alias("var_numerador"), r6(F.var_pop("b")).alias("var_denominador"), r6(F.covar_pop("a", "b")).alias("covariancia"), r6(F.var_pop(F.col("a") - F.col("b"))).alias("var_razao")).where("n >= 10")


@R.add(f"""WITH {SQL_TAPE}, dia AS (SELECT symbol, dt, sum(CASE trade_type WHEN 2 THEN quantidade WHEN 3 THEN -quantidade ELSE 0 END)::double AS f, arg_max(price, {{'a': ts_ns, 'b': ts_recv_ns, 'c': trade_id}}) / arg_min(price, {{'a': ts_ns, 'b': ts_recv_ns, 'c': trade_id}}) - 1 AS r FROM tape GROUP BY ALL)
SELECT dt, count(*) AS n, round(corr(f, r), 5) + 0.0 AS pearson, round(count(*) FILTER (WHERE sign(f) = sign(r)) / count(*), 6) AS mesmo_sinal, coalesce(corr(f, r) >= 0.4 AND count(*) FILTER (WHERE sign(f) = sign(r)) / count(*) >= 0.5, false) AS validada FROM dia GROUP BY dt HAVING count(*) >= 10""")
def o17_series_validation(spark, d):
    """A series against an official one, per day over symbols: signed volume against the day's return; Pearson of at least 0.4 and half the signs alike."""
    at = F.struct("ts_ns", "ts_recv_ns", "trade_id")
    signed = F.when(F.col("trade_type") == 2, F.col("quantidade")).when(F.col("trade_type") == 3, -F.col("quantidade")).otherwise(0)
    day = tape(spark, d).groupBy("symbol", "dt").agg(F.sum(signed).cast("double").alias("f"), (F.max_by("price", at) / F.min_by("price", at) - 1).alias("r"))
    c, same = correlation(F.col("f"), F.col("r")), F.count_if(F.signum("f") == F.signum("r")) / F.count(F.lit(1))
    a = day.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), c.alias("c"), same.alias("s")).where("n >= 10")
    return a.select("dt", "n", r6("c", 5).alias("pearson"), r6("s").alias("mesmo_sinal"), F.coalesce((F.col("c") >= 0.4) & (F.col("s") >= 0.5), F.lit(False)).alias("validada"))


_NOTICE = "ts_base_ns + round((t_mono - t_mono_base) * 1e9)::bigint"


@R.add(f"""WITH {SQL_TAPE}, {_P}, o AS (SELECT ev_id, upper(trim(ticker)) AS symbol, s.dt, {_NOTICE} AS em, {_NOTICE} - {2 * _S} AS antes, CASE lado WHEN 1 THEN 1 ELSE -1 END AS sinal, preco, preco_medio, executada FROM evento_ordem JOIN sessoes s USING (sessao_id) WHERE executada > 0 AND lado IN (1, 2) AND preco > 0 AND preco_medio > 0),
a AS (SELECT o.*, p.w['p'] AS agora FROM o ASOF JOIN p ON p.symbol = o.symbol AND p.dt = o.dt AND o.em >= p.ts_ns), b AS (SELECT a.*, p.w['p'] AS atras FROM a ASOF JOIN p ON p.symbol = a.symbol AND p.dt = a.dt AND a.antes >= p.ts_ns)
SELECT symbol, count(*) AS n, round(avg(sinal * (preco_medio - preco)), 6) + 0.0 AS escorregamento, round(avg(sinal * (agora - atras)), 6) + 0.0 AS custo_do_atraso, round(avg(sinal * (preco_medio - agora)), 6) + 0.0 AS residuo FROM b GROUP BY symbol""")
def m17b_attribution(spark, d):
    """Executed orders: slip against their own price, what two seconds of delay would have cost by the tape, and what is left against the tape's price of the moment."""
    e = table(spark, d, "evento_ordem", "ev_id", "ticker", "sessao_id", "t_mono", "lado", "preco", "preco_medio", "executada").where("executada > 0 and lado in (1, 2) and preco > 0 and preco_medio > 0")
    at = F.col("ts_base_ns") + F.round((F.col("t_mono") - F.col("t_mono_base")) * 1e9).cast("bigint")
    o = e.join(table(spark, d, "sessoes", "sessao_id", "dt", "t_mono_base", "ts_base_ns"), "sessao_id").select("ev_id", F.col("ticker").alias("symbol"), "dt", at.alias("ts_ns"), F.when(F.col("lado") == 1, 1).otherwise(-1).alias("sinal"), "preco", "preco_medio")
    path = tape_once(spark, d).select("symbol", "dt", "ts_ns", "ts_recv_ns", F.col("trade_id").alias("_id"), F.col("price").alias("agora"))
    o = asof_backward(o, path, ["symbol", "dt"], "ts_ns", ["agora"], tie=["ts_recv_ns", "_id"], slice_size=SLICE_NS).withColumn("ts_ns", F.col("ts_ns") - 2 * _S)
    o = asof_backward(o, path.withColumnRenamed("agora", "atras"), ["symbol", "dt"], "ts_ns", ["atras"], tie=["ts_recv_ns", "_id"], slice_size=SLICE_NS).where("agora is not null and atras is not null")
    mean = lambda a, b: r6(F.avg(F.col("sinal") * (F.col(a) - F.col(b))))
    return o.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), mean("preco_medio", "preco").alias("escorregamento"), mean("agora", "atras").alias("custo_do_atraso"), mean("preco_medio", "agora").alias("residuo"))


@R.add(f"""WITH h AS ({TAPE_SQL['h06_local_date']}), o AS (SELECT upper(trim(status)) AS situacao, e.*, h.utc_us, ({_NOTICE}) // 1000 AS em_us FROM evento_ordem e JOIN h USING (ev_id) LEFT JOIN sessoes s USING (sessao_id)),
x AS (SELECT situacao, CASE WHEN executada > 0 AND preco > 0 AND preco_medio > 0 AND lado IN (1, 2) THEN round(CASE WHEN lado = 1 THEN preco_medio - preco ELSE preco - preco_medio END, 6) END AS slip, CASE WHEN utc_us > 0 THEN (em_us - utc_us)::double END AS lat FROM o)
SELECT situacao, count(*) AS n, count(slip) AS com_preco, {", ".join(f"round(quantile_cont(slip, {q}), 6) + 0.0 AS slip_p{int(100 * q)}, round(quantile_cont(lat, {q}) / 1e3, 3) + 0.0 AS atraso_p{int(100 * q)}_ms" for q in (0.5, 0.9))} FROM x GROUP BY situacao""")
def mk13_order_diary_quantiles(spark, d):
    """By state of the order: how many, and quantiles of slippage and of the delay between an order's own clock and its notice."""
    e = table(spark, d, "evento_ordem", "ev_id", "sessao_id", "t_mono", "lado", "status", "executada", "preco", "preco_medio")
    e = e.join(h06_local_date(spark, d), "ev_id").join(table(spark, d, "sessoes", "sessao_id", "t_mono_base", "ts_base_ns"), "sessao_id", "left")
    em = F.expr("(ts_base_ns + cast(round((t_mono - t_mono_base) * 1e9) AS bigint)) div 1000")
    buy = F.col("lado") == 1
    slip = F.when(F.expr("executada > 0 and preco > 0 and preco_medio > 0 and lado in (1, 2)"), F.round(F.when(buy, F.col("preco_medio") - F.col("preco")).otherwise(F.col("preco") - F.col("preco_medio")), 6))
    x = e.select(F.upper(F.trim("status")).alias("situacao"), slip.alias("slip"), F.when(F.col("utc_us") > 0, (em - F.col("utc_us")).cast("double")).alias("lat"))
    q = [c for p in (0.5, 0.9) for c in (r6(F.percentile("slip", F.lit(p))).alias(f"slip_p{int(100 * p)}"), r6(F.percentile("lat", F.lit(p)) / 1e3, 3).alias(f"atraso_p{int(100 * p)}_ms"))]
    return x.groupBy("situacao").agg(F.count(F.lit(1)).alias("n"), F.count("slip").alias("com_preco"), *q)


# ---- P, S: inventories -----------------------------------------------------------------------------------------------------

_WED = "(make_date(year(x), month(x), 15) + ((3 - isodow(make_date(year(x), month(x), 15)) + 10) % 7 - 3)::int)"


@R.add(f"""WITH {SQL_M1}, dia AS (SELECT symbol, dt, max(high) - min(low) AS amp, sum(volume)::double AS v, sum(volume) FILTER (WHERE (minuto - 180) % 1440 >= 1020)::double AS fim FROM m1 GROUP BY ALL),
s AS (SELECT DISTINCT dt::date AS dia FROM dia), m AS (SELECT DISTINCT unnest([dia - INTERVAL 1 MONTH, dia, dia + INTERVAL 1 MONTH, dia + INTERVAL 2 MONTH])::date AS x FROM s), e AS (SELECT DISTINCT {_WED}::date AS venc FROM m WHERE month(x) % 2 = 0),
k AS (SELECT strftime(dia, '%Y-%m-%d') AS dt, arg_min(date_diff('day', venc, dia), {{'d': abs(date_diff('day', venc, dia)), 'v': venc}})::bigint AS distancia FROM s, e GROUP BY dia)
SELECT distancia, count(*) AS dias, round(median(amp), 6) AS amplitude, round(median(v), 6) AS volume, round(median(coalesce(fim, 0) / v), 6) AS parte_final FROM dia JOIN k USING (dt) GROUP BY ALL""")
def mk01b_days_by_expiry(spark, d):
    """Range, volume and the share after 17:00 local time, by signed days from the nearest expiry (negative: before it); medians over symbols and days."""
    late = F.when(F.pmod(F.col("minuto") - 180, F.lit(1440)) >= 1020, F.col("volume")).otherwise(0)
    day = m1(spark, d).groupBy("symbol", "dt").agg((F.max("high") - F.min("low")).alias("amp"), F.sum("volume").alias("v"), F.sum(late).alias("fim"))
    s = day.select("dt", F.to_date("dt").alias("dia")).distinct()
    months = F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1, 2))), lambda k: F.add_months("dia", k)))
    e = s.withColumn("x", months).where(F.month("x") % 2 == 0).withColumn("venc", nearest_wednesday(F.col("x")))
    gap = F.datediff("dia", "venc")
    k = e.groupBy("dt").agg(F.min_by(gap.cast("bigint"), F.struct(F.abs(gap), "venc")).alias("distancia"))
    return day.join(k, "dt").groupBy("distancia").agg(F.count(F.lit(1)).alias("dias"), r6(F.median("amp")).alias("amplitude"), r6(F.median("v")).alias("volume"), r6(F.median(F.col("fim") / F.col("v"))).alias("parte_final"))


@R.add(f"""WITH {SQL_TAPE}, a AS (SELECT symbol, count(DISTINCT dt) AS dias, sum(quantidade) FILTER (WHERE trade_type IN (2, 3))::bigint AS volume_agressor, count(DISTINCT (dt, ts_ns // {60 * MINUTE})) AS horas, count(DISTINCT ts_ns // {MINUTE}) FILTER (WHERE trade_type IN (2, 3)) AS barras FROM tape GROUP BY symbol),
st AS (SELECT symbol, dt, abs(price - lag(price) OVER (PARTITION BY symbol, dt ORDER BY ts_ns, ts_recv_ns, trade_id)) AS s FROM tape WHERE trade_type IN (2, 3)), tk AS (SELECT symbol, round(median(s), 6) AS tick FROM (SELECT symbol, dt, min(s) AS s FROM st WHERE s > 1e-9 GROUP BY ALL) GROUP BY symbol),
lv AS (SELECT {SQL_SYMBOL} AS symbol, count(DISTINCT dt) AS dias_livro FROM book_offer GROUP BY ALL)
SELECT a.symbol, dias, volume_agressor, round(barras / horas, 6) AS barras_por_hora, round(60.0 * horas / barras, 4) AS minutos_por_barra, tick, coalesce(dias_livro, 0) AS dias_livro, dias >= 160 AS pronto FROM a LEFT JOIN tk USING (symbol) LEFT JOIN lv USING (symbol)""")
def mk03b_session_inventory(spark, d):
    """Per symbol: sessions, aggressor volume, bars an hour and the minutes one stands for, tick, sessions with a book, and whether 160 sessions are there."""
    t = tape_once(spark, d)
    aggr = is_aggressor(F.col("trade_type"))
    a = t.groupBy("symbol").agg(F.count_distinct("dt").alias("dias"), F.sum(F.when(aggr, F.col("quantidade"))).alias("volume_agressor"), F.count_distinct("dt", F.expr(f"ts_ns div {60 * MINUTE}")).alias("horas"), F.count_distinct(F.when(aggr, F.expr(f"ts_ns div {MINUTE}"))).alias("barras"))
    books = table(spark, d, "book_offer", "symbol", "dt").groupBy("symbol").agg(F.count_distinct("dt").alias("dias_livro"))
    out = a.join(infer_tick(t), "symbol", "left").join(books, "symbol", "left")
    return out.select("symbol", "dias", "volume_agressor", r6(F.try_divide("barras", "horas")).alias("barras_por_hora"), r6(F.try_divide(60.0 * F.col("horas"), F.col("barras")), 4).alias("minutos_por_barra"), r6("tick").alias("tick"), F.coalesce("dias_livro", F.lit(0)).alias("dias_livro"), (F.col("dias") >= 160).alias("pronto"))


_LAYERS = {"fita": ("trades", "symbol"), "livro": ("book_offer", "symbol"), "topo": ("topo_livro", "symbol"), "ordens": ("evento_ordem", "ticker")}


@R.add("WITH " + ", ".join(f"{n} AS (SELECT upper(trim({c})) AS symbol, count(*) AS n FROM {t} GROUP BY ALL)" for n, (t, c) in _LAYERS.items()) + f" SELECT a.symbol, a.familia, {', '.join(f'coalesce({n}.n, 0) AS {n}' for n in _LAYERS)}, CASE WHEN fita.n IS NULL THEN 'sem_fita' WHEN livro.n IS NULL THEN 'sem_livro' ELSE 'completo' END AS situacao FROM (SELECT {SQL_SYMBOL} AS symbol, familia FROM ativos) a " + " ".join(f"LEFT JOIN {n} ON {n}.symbol = a.symbol" for n in _LAYERS))
def s08b_asset_layers(spark, d):
    """Each listed asset with the rows of every layer, and what its collection lacks."""
    out = table(spark, d, "ativos", "symbol", "familia")
    for name, (t, c) in _LAYERS.items():
        out = out.join(table(spark, d, t, c).groupBy(F.col(c).alias("symbol")).agg(F.count(F.lit(1)).alias(name)), "symbol", "left")
    state = F.when(F.col("fita").isNull(), "sem_fita").when(F.col("livro").isNull(), "sem_livro").otherwise("completo")
    return out.select("symbol", "familia", *(F.coalesce(n, F.lit(0)).alias(n) for n in _LAYERS), state.alias("situacao"))


QUERIES, ORACLES = R.queries, R.sql
