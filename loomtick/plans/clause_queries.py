"""The remaining clauses of rows that other queries answer in part: each name's number is its inventory row's."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.bars import SLICE_NS
from ..operators.quality import footers
from ..operators.series import fold_series
from ..operators.stats import quantile_bucket
from ..operators.tape import local_hhmm
from ..operators.windows import correlation, with_previous
from ..sources.tables import table, valid_ts
from .registry import SQL_SYMBOL, SQL_TAPE, SQL_VALID, Registry, r6, tape, tape_once
from .research_queries import _M5, SQL_FLOW, by_bar, flow, iceberg_runs, resolved
from .tape_queries import _M1W, MINUTE, SQL_HHMM, SQL_M1, in_minutes, m1

R = Registry()

# ---- A: footers ------------------------------------------------------------------------------------------------------

_STORED = ("trades", "book_offer", "topo_livro")


@R.add(" UNION ALL ".join(f"SELECT '{t}' AS tabela, count(*) AS linhas, 0::bigint AS ilegiveis FROM {t}" for t in _STORED))
def a06b_footer_counts(spark, d):
    """Rows of each table by the footers of its files alone, and files whose footer can't be read."""
    f = footers(spark, [f"{d}/{t}.parquet" for t in _STORED], ["ts_recv_ns"])
    name = F.regexp_extract("path", r"/([a-z_]+)\.parquet(/|$)", 1)
    files = f.groupBy("path").agg(F.max("linhas").alias("linhas"), F.max(F.col("linhas").isNull().cast("int")).alias("_x"))
    return files.groupBy(name.alias("tabela")).agg(F.sum("linhas").alias("linhas"), F.sum("_x").cast("bigint").alias("ilegiveis"))


@R.add(" UNION ALL ".join(f"SELECT '{t}' AS tabela, '{c}' AS coluna, min({c}) AS menor, max({c}) AS maior, count(*) FILTER (WHERE {c} IS NULL) AS nulos FROM {t}" for t in _STORED for c in ("ts_recv_ns", "quantidade") if (t, c) != ("topo_livro", "quantidade")))
def a07b_footer_statistics(spark, d):
    """Least and greatest value and NULLs of integer columns, by row-group statistics alone."""
    f = footers(spark, [f"{d}/{t}.parquet" for t in _STORED], ["ts_recv_ns", "quantidade"]).where("coluna is not null")
    name = F.regexp_extract("path", r"/([a-z_]+)\.parquet(/|$)", 1)
    return f.groupBy(name.alias("tabela"), "coluna").agg(F.min("menor").alias("menor"), F.max("maior").alias("maior"), F.sum("nulos").alias("nulos"))


# ---- B, D, E, I: predicates, statistics, gaps, bars -------------------------------------------------------------------

_CLOCK = "((minuto - 180) % 1440 // 60 * 100 + (minuto - 180) % 60)"


@R.add(f"WITH {SQL_M1} SELECT symbol, dt, count(*) AS barras, min({_CLOCK}) AS primeira, count(*) >= 110 AND min({_CLOCK}) = 900 AS completo FROM m1 GROUP BY ALL")
def b07b_complete_days(spark, d):
    """A day is complete if its first bar is that of 09:00 local time and it has at least 110 bars."""
    first, n = F.min(local_hhmm(F.col("minuto") * MINUTE)), F.count(F.lit(1))
    return m1(spark, d).groupBy("symbol", "dt").agg(n.alias("barras"), first.alias("primeira"), ((n >= 110) & (first == 900)).alias("completo"))


@R.add(f"WITH {SQL_FLOW}, p AS (SELECT symbol, round(imbalance, 9) AS x, round(1e4 * (lead(close) OVER (PARTITION BY symbol ORDER BY bar_id) / close - 1), 9) AS y FROM flow), q AS (SELECT * FROM p WHERE y IS NOT NULL) SELECT symbol, count(*) AS n, round(regr_slope(y, x), 5) + 0.0 AS inclinacao, round(regr_intercept(y, x), 5) + 0.0 AS intercepto, round(sqrt(greatest(regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x), 0) / (count(*) - 2)), 5) AS desvio_residual FROM q GROUP BY symbol HAVING count(*) >= 10 AND var_pop(x) > 1e-12")
def d14b_least_squares(spark, d):
    """The line of the next bar's return (in hundredths of a per cent) on imbalance: slope, intercept and residual deviation from mergeable moments."""
    y = F.round(1e4 * (F.lead("close").over(by_bar()) / F.col("close") - 1), 9)
    p = flow(spark, d).select("symbol", F.round("imbalance", 9).alias("x"), y.alias("y")).where("y is not null")
    n, sxx, syy, sxy = F.count(F.lit(1)), F.var_pop("x"), F.var_pop("y"), F.covar_pop("x", "y")
    a = p.groupBy("symbol").agg(n.alias("n"), sxx.alias("sxx"), syy.alias("syy"), sxy.alias("sxy"), F.avg("x").alias("mx"), F.avg("y").alias("my")).where("n >= 10 and sxx > 1e-12")
    slope = F.col("sxy") / F.col("sxx")
    rest = F.sqrt(F.greatest(F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx"), F.lit(0.0)) * F.col("n") / (F.col("n") - 2))
    return a.select("symbol", "n", r6(slope, 5).alias("inclinacao"), r6(F.col("my") - slope * F.col("mx"), 5).alias("intercepto"), r6(rest, 5).alias("desvio_residual"))


@R.add(f"WITH {_M5}, x AS (SELECT symbol, round(resultado, 6) AS r FROM res) SELECT symbol, count(*) AS n, round(100.0 * count(*) FILTER (WHERE r > 0) / count(*), 6) AS acerto, round(avg(r) FILTER (WHERE r > 0) / nullif(-avg(r) FILTER (WHERE r < 0), 0), 5) AS payoff, round(sum(r) FILTER (WHERE r > 0) / nullif(-sum(r) FILTER (WHERE r < 0), 0), 5) AS fator, max(r) + 0.0 AS melhor, min(r) + 0.0 AS pior FROM x GROUP BY symbol")
def d16b_profit_statistics(spark, d):
    """Share of gains, payoff (mean gain over mean loss), profit factor, best and worst operation."""
    x, n = F.col("r"), F.count(F.lit(1))
    gain, loss = F.when(x > 0, x), F.when(x < 0, -x)
    per = lambda f: r6(f(gain) / F.nullif(f(loss), F.lit(0.0)), 5)
    rows = resolved(spark, d).select("symbol", r6("resultado").alias("r"))
    return rows.groupBy("symbol").agg(n.alias("n"), r6(100.0 * F.count_if(x > 0) / n).alias("acerto"), per(F.avg).alias("payoff"), per(F.sum).alias("fator"), F.max(x).alias("melhor"), F.min(x).alias("pior"))


@R.add(f"""WITH v AS (SELECT {SQL_SYMBOL} AS symbol, dt, ts_ns, ts_recv_ns FROM trades WHERE {SQL_VALID}), g AS (SELECT symbol, dt, ts_recv_ns AS ate, lag(ts_recv_ns) OVER (PARTITION BY symbol, dt ORDER BY ts_recv_ns) AS de FROM (SELECT DISTINCT symbol, dt, ts_recv_ns FROM v)),
s AS (SELECT * FROM g WHERE ate - de >= {5 * MINUTE}), c AS (SELECT s.symbol, s.dt, s.de, s.ate, count(v.ts_ns) AS n FROM s LEFT JOIN v ON v.symbol = s.symbol AND v.dt = s.dt AND v.ts_ns > s.de AND v.ts_ns < s.ate GROUP BY ALL)
SELECT symbol, dt, CASE WHEN n = 0 THEN 'mercado' WHEN n < 5 THEN 'duvida' ELSE 'captura' END AS classe, count(*) AS silencios, max(ate - de) AS maior, sum(n)::bigint AS negocios FROM c GROUP BY ALL""")
def e22b_classified_silences(spark, d):
    """Five minutes or more without arrivals, by what happened in them: nothing (the market was quiet) or trades that arrived later (the capture was)."""
    v = table(spark, d, "trades", "symbol", "dt", "ts_ns", "ts_recv_ns").where(valid_ts(F.col("ts_ns"), F.col("dt")))
    arrivals = with_previous(v.select("symbol", "dt", "ts_recv_ns").distinct(), ["symbol", "dt"], "ts_recv_ns", SLICE_NS, ["ts_recv_ns"], ["ts_recv_ns"])
    s = arrivals.where(F.col("ts_recv_ns") - F.col("_prev.ts_recv_ns") >= 5 * MINUTE).select("symbol", "dt", F.col("_prev.ts_recv_ns").alias("de"), F.col("ts_recv_ns").alias("ate"))
    slot = s.withColumn("_m", F.explode(F.sequence(F.expr(f"de div {5 * MINUTE}"), F.expr(f"ate div {5 * MINUTE}"))))
    inside = slot.join(v.select("symbol", "dt", "ts_ns", F.expr(f"ts_ns div {5 * MINUTE}").alias("_m")), ["symbol", "dt", "_m"]).where("ts_ns > de and ts_ns < ate")
    n = inside.groupBy("symbol", "dt", "de", "ate").agg(F.count(F.lit(1)).alias("n"))
    c = s.join(n, ["symbol", "dt", "de", "ate"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    kind = F.when(F.col("n") == 0, "mercado").when(F.col("n") < 5, "duvida").otherwise("captura")
    return c.groupBy("symbol", "dt", kind.alias("classe")).agg(F.count(F.lit(1)).alias("silencios"), F.max(F.col("ate") - F.col("de")).alias("maior"), F.sum("n").alias("negocios"))


@R.add(f"""WITH {SQL_TAPE}, h AS (SELECT symbol, dt, {SQL_HHMM} // 100 * 100 + CASE WHEN {SQL_HHMM} % 100 >= 30 THEN 30 ELSE 0 END AS faixa, sum(quantidade)::bigint AS v, count(*) AS n FROM tape GROUP BY ALL),
p AS (SELECT *, v / first_value(v) OVER (PARTITION BY symbol, dt ORDER BY faixa) AS pelo_primeiro FROM h WHERE faixa >= 930) SELECT symbol, faixa, count(*) AS dias, round(median(n), 6) AS negocios, round(median(pelo_primeiro), 6) AS pelo_primeiro FROM p GROUP BY ALL""")
def i10b_half_hours_by_first(spark, d):
    """Contracts of each half hour over those of the day's first complete one, from 09:30 local time on; medians over days."""
    hhmm = local_hhmm(F.col("ts_ns"))
    slot = F.floor(hhmm / 100) * 100 + F.when(F.pmod(hhmm, F.lit(100)) >= 30, 30).otherwise(0)
    h = tape(spark, d).groupBy("symbol", "dt", slot.cast("bigint").alias("faixa")).agg(F.sum("quantidade").alias("v"), F.count(F.lit(1)).alias("n")).where("faixa >= 930")
    h = h.withColumn("_f", F.col("v") / F.first("v").over(Window.partitionBy("symbol", "dt").orderBy("faixa")))
    return h.groupBy("symbol", "faixa").agg(F.count(F.lit(1)).alias("dias"), r6(F.median("n")).alias("negocios"), r6(F.median("_f")).alias("pelo_primeiro"))


@R.add(f"WITH {SQL_M1}, tk AS (SELECT {SQL_SYMBOL} AS symbol, tick FROM ativos), g AS (SELECT symbol, dt, minuto, lead(minuto) OVER ({_M1W}) - minuto - 1 AS f, round((high - low) / tick, 6) AS t FROM m1 JOIN tk USING (symbol)) SELECT symbol, count(*) AS barras, coalesce(sum(f), 0)::bigint AS buracos, count(*) FILTER (WHERE f > 0) AS interrupcoes, round(median(t), 6) AS faixa_em_ticks FROM g GROUP BY symbol")
def i15b_holes_and_ticks(spark, d):
    """Missing minutes inside days, in how many places, and the median range in the symbol's ticks."""
    rows = m1(spark, d).join(table(spark, d, "ativos", "symbol", "tick"), "symbol").withColumn("f", F.lead("minuto").over(in_minutes()) - F.col("minuto") - 1)
    ticks = r6((F.col("high") - F.col("low")) / F.col("tick"))
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("barras"), F.coalesce(F.sum("f"), F.lit(0)).alias("buracos"), F.count_if(F.col("f") > 0).alias("interrupcoes"), r6(F.median(ticks)).alias("faixa_em_ticks"))


# ---- J, L: shapes and runs --------------------------------------------------------------------------------------------


@R.add(f"""WITH {SQL_M1}, dia AS (SELECT symbol, dt, arg_min(open, minuto) AS o, arg_max(close, minuto) AS c, max(high) AS h, min(low) AS l FROM m1 GROUP BY ALL), s AS (SELECT symbol, dt, round(CASE WHEN h > l THEN abs(c - o) / (h - l) END, 9) AS x FROM dia),
e AS (SELECT list_distinct(quantile_cont(x, [1/3, 2/3])) AS e FROM s) SELECT symbol, dt, round(x, 6) AS direcao, CASE 1 + len(list_filter(e, lambda y: x > y)) WHEN 1 THEN 'lateral' WHEN 2 THEN 'misto' ELSE 'tendencia' END AS forma FROM s, e WHERE x IS NOT NULL""")
def j15b_day_shapes(spark, d):
    """Days by terciles of |close − open| over range, across symbols."""
    day = m1(spark, d).groupBy("symbol", "dt").agg(F.min_by("open", "minuto").alias("o"), F.max_by("close", "minuto").alias("c"), F.max("high").alias("h"), F.min("low").alias("l"))
    s = day.select("symbol", "dt", F.lit(1).alias("_all"), F.round(F.when(F.col("h") > F.col("l"), F.abs(F.col("c") - F.col("o")) / (F.col("h") - F.col("l"))), 9).alias("x")).where("x is not null")
    t = quantile_bucket(s, ["_all"], "x", 3, "_t")
    return t.select("symbol", "dt", r6("x").alias("direcao"), F.when(F.col("_t") == 1, "lateral").when(F.col("_t") == 2, "misto").otherwise("tendencia").alias("forma"))


_TAILED = ("imbalance", "rlp_frac", "absorcao")


@R.add(f"""WITH {SQL_FLOW}, l AS ({" UNION ALL ".join(f"SELECT symbol, '{c}' AS feature, round({c}, 9) AS x FROM flow" for c in _TAILED)}), m AS (SELECT symbol, feature, avg(x) AS m, stddev_samp(x) AS s FROM l GROUP BY ALL)
SELECT symbol, feature, count(*) AS n, round(count(*) FILTER (WHERE round(abs(x - m) / s, 6) > 2.5) / count(*), 6) AS cauda, round(count(*) FILTER (WHERE round(abs(x - m) / s, 6) > 2.5) / count(*) / 0.0124, 4) AS pela_normal FROM l JOIN m USING (symbol, feature) WHERE s > 1e-9 GROUP BY ALL HAVING count(*) >= 10""")
def j16b_tail_shares(spark, d):
    """The share of a feature beyond 2.5 deviations, and that over the 1.24 % of a normal one."""
    x = flow(spark, d).select("symbol", *(F.round(c, 9).alias(c) for c in _TAILED)).unpivot(["symbol"], list(_TAILED), "feature", "x").where("x is not null")
    m = x.groupBy("symbol", "feature").agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s")).where("s > 1e-9")
    far = F.count_if(F.round(F.abs(F.col("x") - F.col("m")) / F.col("s"), 6) > 2.5) / F.count(F.lit(1))
    a = x.join(m, ["symbol", "feature"]).groupBy("symbol", "feature").agg(F.count(F.lit(1)).alias("n"), far.alias("f")).where("n >= 10")
    return a.select("symbol", "feature", "n", r6("f").alias("cauda"), r6(F.col("f") / 0.0124, 4).alias("pela_normal"))


@R.add(f"WITH {SQL_FLOW}, x AS (SELECT symbol, abs(vol_compra - vol_venda)::double AS a, (vol_compra + vol_venda)::double AS b, abs(imbalance) AS r FROM flow) SELECT symbol, count(*) AS n, round(corr(r, a), 5) + 0.0 AS com_numerador, round(corr(r, b), 5) + 0.0 AS com_denominador FROM x GROUP BY symbol HAVING count(*) >= 10 AND var_pop(r) > 1e-12 AND var_pop(a) > 1e-12 AND var_pop(b) > 1e-12")
def j16c_ratio_parts(spark, d):
    """Whether a ratio follows its numerator or its denominator."""
    va, dif = F.col("vol_compra") + F.col("vol_venda"), F.abs(F.col("vol_compra") - F.col("vol_venda"))
    x = flow(spark, d).select("symbol", dif.cast("double").alias("a"), va.cast("double").alias("b"), F.abs("imbalance").alias("r"))
    varies = [F.var_pop(c) > 1e-12 for c in "abr"]
    s = x.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), r6(correlation(F.col("r"), F.col("a")), 5).alias("com_numerador"), r6(correlation(F.col("r"), F.col("b")), 5).alias("com_denominador"), (varies[0] & varies[1] & varies[2]).alias("_v"))
    return s.where("n >= 10 and _v").drop("_v")


_CURVE = (2, 3, 5, 10)
_RUNS = "f{k} AS (SELECT *, CASE WHEN coalesce(ts_ns - lag(ts_ns) OVER w <= 30000000000, false) THEN 0 ELSE 1 END AS s FROM p WHERE passivo > 0 AND {where} WINDOW w AS (PARTITION BY symbol, dt, price, quantidade, passivo ORDER BY ts_ns, ts_recv_ns, trade_id)), g{k} AS (SELECT *, sum(s) OVER (PARTITION BY symbol, dt, price, quantidade, passivo ORDER BY ts_ns, ts_recv_ns, trade_id)::bigint AS ilha FROM f{k}), r{k} AS (SELECT symbol, count(*) AS n FROM g{k} GROUP BY symbol, dt, price, quantidade, passivo, ilha)"


@R.add(f"WITH {SQL_TAPE}, p AS (SELECT *, CASE trade_type WHEN 2 THEN agente_vendedor WHEN 3 THEN agente_comprador ELSE 0 END AS passivo FROM tape), {_RUNS.format(k=1, where='true')}, {_RUNS.format(k=2, where='agente_comprador <> agente_vendedor')}, u AS (SELECT 'todos' AS conjunto, symbol, n FROM r1 UNION ALL SELECT 'sem_diretos', symbol, n FROM r2) SELECT conjunto, symbol, " + ", ".join(f"count(*) FILTER (WHERE n >= {k}) AS ao_menos_{k}" for k in _CURVE) + " FROM u GROUP BY ALL HAVING count(*) FILTER (WHERE n >= 2) > 0")
def l18b_run_curve(spark, d):
    """How many runs of equal lots have at least so many trades, with and without crosses inside one broker."""
    t, parts = tape_once(spark, d), None
    for name, rows in (("todos", t), ("sem_diretos", t.where("agente_comprador <> agente_vendedor"))):
        r = iceberg_runs(rows).withColumn("conjunto", F.lit(name))
        parts = r if parts is None else parts.unionByName(r)
    return parts.groupBy("conjunto", "symbol").agg(*(F.count_if(F.col("n") >= k).alias(f"ao_menos_{k}") for k in _CURVE))


# ---- M, O: results ----------------------------------------------------------------------------------------------------


@R.add(f"""WITH {_M5}, c AS (SELECT symbol, row_number() OVER w AS i, sum(round(resultado, 6)) OVER w AS a FROM res WINDOW w AS (PARTITION BY symbol ORDER BY dt, minuto ROWS UNBOUNDED PRECEDING)),
t AS (SELECT *, greatest(max(round(a, 6)) OVER (PARTITION BY symbol ORDER BY i), 0.0) AS topo FROM c), q AS (SELECT *, round(round(a, 6) - topo, 6) AS queda FROM t),
v AS (SELECT symbol, arg_min({{'i': i, 'topo': topo, 'q': queda}}, {{'q': queda, 'i': i}}) AS x, round(arg_max(a, i), 6) AS fim, count(*) AS n FROM q GROUP BY symbol)
SELECT v.symbol, v.n, fim + 0.0 AS acumulado, x['q'] + 0.0 AS maior_queda, x['i'] AS vale, coalesce((SELECT min(q.i) FROM q WHERE q.symbol = v.symbol AND round(q.a, 6) = x['topo'] AND q.i <= x['i']), 0) AS topo, round(fim / nullif(-x['q'], 0), 5) + 0.0 AS calmar FROM v""")
def m15b_equity(spark, d):
    """The equity curve's end, its deepest fall with the operations of peak (0: the start) and trough, and their ratio."""
    x = resolved(spark, d).select("symbol", F.col("dt").alias("dt"), "minuto", r6("resultado").alias("r"))

    def fold(r: np.ndarray) -> dict:
        a = np.round(np.cumsum(r), 6)
        top = np.maximum(np.maximum.accumulate(a), 0.0)
        fall = np.round(a - top, 6)
        low = int(fall.argmin())
        peak = int(np.flatnonzero(a[: low + 1] == top[low])[0]) + 1 if top[low] in a[: low + 1] else 0
        n = len(r)
        last = np.zeros(n, bool)
        last[-1] = True
        return {"_u": last, "n": np.full(n, n), "acumulado": np.full(n, a[-1]), "maior_queda": np.full(n, fall[low]), "vale": np.full(n, low + 1), "topo": np.full(n, peak)}

    e = fold_series(x, ["symbol"], ["dt", "minuto"], ["r"], fold, "n bigint, acumulado double, maior_queda double, vale bigint, topo bigint", keep="_u")
    return e.select("symbol", "n", "acumulado", "maior_queda", "vale", "topo", r6(F.col("acumulado") / F.nullif(-F.col("maior_queda"), F.lit(0.0)), 5).alias("calmar"))


@R.add(f"""WITH {_M5}, x AS (SELECT symbol, round(resultado, 6) AS r, row_number() OVER (PARTITION BY symbol ORDER BY dt, minuto) AS i FROM res), g AS (SELECT *, i - row_number() OVER (PARTITION BY symbol, r < 0 ORDER BY i) AS k FROM x),
s AS (SELECT symbol, count(*) AS n, round(sum(r), 6) AS soma FROM g WHERE r < 0 GROUP BY symbol, k), w AS (SELECT symbol, list_sort(list(r))[1:3] AS tres FROM x GROUP BY symbol)
SELECT w.symbol, round(list_sum(tres), 6) + 0.0 AS tres_piores, coalesce(max(s.n), 0) AS maior_sequencia, coalesce(min(s.soma), 0.0) + 0.0 AS pior_sequencia FROM w LEFT JOIN s ON s.symbol = w.symbol GROUP BY w.symbol, tres""")
def m16b_losing_runs(spark, d):
    """The three worst operations together, the longest run of losses and the dearest one."""
    w = Window.partitionBy("symbol").orderBy("dt", "minuto")
    x = resolved(spark, d).select("symbol", r6("resultado").alias("r"), F.row_number().over(w).alias("i"))
    g = x.withColumn("_k", F.col("i") - F.row_number().over(Window.partitionBy("symbol", F.col("r") < 0).orderBy("i")))
    s = g.where("r < 0").groupBy("symbol", "_k").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("r")).alias("soma")).groupBy("symbol").agg(F.max("n").alias("n"), F.min("soma").alias("soma"))
    worst = x.withColumn("_w", F.row_number().over(Window.partitionBy("symbol").orderBy("r"))).where("_w <= 3").groupBy("symbol").agg(r6(F.sum("r")).alias("tres_piores"))
    return worst.join(s, "symbol", "left").select("symbol", "tres_piores", F.coalesce("n", F.lit(0)).alias("maior_sequencia"), F.coalesce("soma", F.lit(0.0)).alias("pior_sequencia"))


_COST = 0.0002


@R.add(f"""WITH {SQL_FLOW}, f2 AS (SELECT symbol, round(imbalance, 9) AS x, lead(close) OVER (PARTITION BY symbol ORDER BY bar_id) / close - 1 AS ret FROM flow), k AS (SELECT * FROM f2 WHERE ret IS NOT NULL), e AS (SELECT symbol, list_distinct(quantile_cont(x, [0.2, 0.4, 0.6, 0.8])) AS e FROM k GROUP BY symbol),
q AS (SELECT k.symbol, 1 + len(list_filter(e, lambda y: x > y)) AS quintil, ret FROM k JOIN e USING (symbol)), m AS (SELECT symbol, avg(ret) FILTER (WHERE quintil = 5) AS alto, avg(ret) FILTER (WHERE quintil = 1) AS baixo, count(*) AS n FROM q GROUP BY symbol)
SELECT symbol, n, round(alto - baixo, 8) + 0.0 AS bruto, round(abs(alto - baixo) - {2 * _COST}, 8) + 0.0 AS liquido, abs(alto - baixo) > {2 * _COST} AS vivo FROM m WHERE alto IS NOT NULL AND baixo IS NOT NULL""")
def o05b_long_short(spark, d):
    """The spread of the extreme quintiles, gross and net of two costs, and whether it is alive."""
    fr = flow(spark, d).select("symbol", F.round("imbalance", 9).alias("x"), (F.lead("close").over(by_bar()) / F.col("close") - 1).alias("ret")).where("ret is not null")
    mean = lambda k: F.avg(F.when(F.col("quintil") == k, F.col("ret")))
    m = quantile_bucket(fr, ["symbol"], "x", 5).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), (mean(5) - mean(1)).alias("b")).where("b is not null")
    return m.select("symbol", "n", r6("b", 8).alias("bruto"), r6(F.abs("b") - 2 * _COST, 8).alias("liquido"), (F.abs("b") > 2 * _COST).alias("vivo"))


_BANDS = "CASE WHEN (minuto - 180) % 1440 < 660 THEN 'manha' WHEN (minuto - 180) % 1440 < 900 THEN 'meio' ELSE 'tarde' END"


@R.add(f"WITH {_M5}, x AS (SELECT {_BANDS} AS faixa, round(resultado, 6) AS r FROM res), v AS (SELECT faixa, quantile_cont(r, 0.05) AS var FROM x GROUP BY faixa) SELECT x.faixa, count(*) AS n, round(any_value(var), 6) + 0.0 AS var, round(avg(r) FILTER (WHERE r <= var), 6) + 0.0 AS es, round(count(*) FILTER (WHERE r > -0.02) / count(*), 6) AS confianca_do_limite FROM x JOIN v USING (faixa) GROUP BY x.faixa")
def o11b_risk_by_band(spark, d):
    """Value at risk and expected shortfall by time of day, and the confidence that a limit of two cents implies."""
    clock = F.pmod(F.col("minuto") - 180, F.lit(1440))
    band = F.when(clock < 660, "manha").when(clock < 900, "meio").otherwise("tarde")
    x = resolved(spark, d).select(band.alias("faixa"), r6("resultado").alias("r"))
    v = x.groupBy("faixa").agg(F.percentile("r", F.lit(0.05)).alias("var"))
    return x.join(v, "faixa").groupBy("faixa").agg(F.count(F.lit(1)).alias("n"), r6(F.first("var")).alias("var"), r6(F.avg(F.when(F.col("r") <= F.col("var"), F.col("r")))).alias("es"), r6(F.count_if(F.col("r") > -0.02) / F.count(F.lit(1))).alias("confianca_do_limite"))


@R.add(f"WITH {_M5}, s AS (SELECT symbol, CASE WHEN lado > 0 THEN 'compra' ELSE 'venda' END AS lado, count(*) FILTER (WHERE desfecho = 'alvo')::double AS k, count(*) FILTER (WHERE desfecho IN ('alvo', 'stop'))::double AS n FROM res GROUP BY ALL), w AS (SELECT *, k / n AS p FROM s WHERE n > 0) SELECT symbol, lado, n::bigint AS n, round(p, 6) AS p1, round((p + 1.9208 / n - 1.96 * sqrt(p * (1 - p) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n), 6) AS de, round((p + 1.9208 / n + 1.96 * sqrt(p * (1 - p) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n), 6) AS ate FROM w")
def o09b_rates_with_intervals(spark, d):
    """Hit rates by symbol and side with Wilson's interval."""
    hit, done = F.count_if(F.col("desfecho") == "alvo"), F.count_if(F.col("desfecho").isin("alvo", "stop"))
    s = resolved(spark, d).groupBy("symbol", F.when(F.col("lado") > 0, "compra").otherwise("venda").alias("lado")).agg((hit / F.nullif(done, F.lit(0))).alias("p"), done.alias("n")).where("n > 0")
    p, n, z2 = F.col("p"), F.col("n"), 3.8416
    half = 1.96 * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    edge = lambda h: r6((p + z2 / (2 * n) + h) / (1 + z2 / n))
    return s.select("symbol", "lado", "n", r6("p").alias("p1"), edge(-half).alias("de"), edge(half).alias("ate"))


@R.add(f"WITH {SQL_M1}, f AS (SELECT *, row_number() OVER (PARTITION BY symbol, dt ORDER BY minuto DESC) AS k, sum(volume) OVER (PARTITION BY symbol, dt) AS tot, max(high) OVER (PARTITION BY symbol, dt) - min(low) OVER (PARTITION BY symbol, dt) AS amp FROM m1) SELECT symbol, k, substr(dt, 1, 4) AS ano, count(*) AS dias, round(median(volume / tot), 6) AS parte, round(median((high - low) / amp) FILTER (WHERE amp > 0), 6) AS amplitude FROM f WHERE k <= 5 GROUP BY ALL")
def mk02b_closing_amplitude(spark, d):
    """Volume share and range over the day's range of the last five bars, by year; medians over days."""
    end, day = Window.partitionBy("symbol", "dt").orderBy(F.desc("minuto")), Window.partitionBy("symbol", "dt")
    rows = m1(spark, d).withColumns({"k": F.row_number().over(end).cast("bigint"), "tot": F.sum("volume").over(day), "amp": F.max("high").over(day) - F.min("low").over(day)}).where("k <= 5")
    return rows.groupBy("symbol", "k", F.substring("dt", 1, 4).alias("ano")).agg(F.count(F.lit(1)).alias("dias"), r6(F.median(F.col("volume") / F.col("tot"))).alias("parte"), r6(F.median(F.when(F.col("amp") > 0, (F.col("high") - F.col("low")) / F.col("amp")))).alias("amplitude"))


QUERIES, ORACLES = R.queries, R.sql
