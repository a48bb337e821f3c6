"""More of groups J, L, M, O and P: features on time bars, barrier choice, bursts, crossings, parity, calendars."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalars import nearest_wednesday
from ..operators import bars as B
from ..operators.asof import range_join
from ..operators.labels import triple_barrier
from ..operators.quality import compare
from ..operators.tape import is_aggressor
from ..operators.windows import correlation, strict_past_z
from ..sources.tables import table
from .registry import SQL_SYMBOL, SQL_TAPE, Registry, r6, tape, tape_once
from .research_queries import _P5, ORACLES as RESEARCH_SQL
from .research_queries import SQL_TB, by_bar, iceberg_runs, k01_rsi_ema, o02_information_coefficient, sql_barrier
from .study_queries import SQL_DIA, by_day, days
from .tape_queries import _BIG, _M1W, MINUTE, SQL_M1, big_buys, in_minutes, m1, sql_z

R = Registry()

# ---- J ---------------------------------------------------------------------------------------------------------------


@R.add(f"""WITH {SQL_TB}, tk AS (SELECT {SQL_SYMBOL} AS symbol, tick FROM ativos), a AS (SELECT symbol, bar_id, max(price) FILTER (WHERE trade_type IN (2, 3)) AS h, min(price) FILTER (WHERE trade_type IN (2, 3)) AS l, coalesce(sum(quantidade) FILTER (WHERE trade_type = 2), 0) AS vc, coalesce(sum(quantidade) FILTER (WHERE trade_type = 3), 0) AS vv, coalesce(sum(quantidade) FILTER (WHERE trade_type = 13), 0) AS vr, count(*) FILTER (WHERE trade_type IN (2, 3)) AS n FROM tb GROUP BY ALL),
f AS (SELECT symbol, bar_id, (vc - vv) / (vc + vv) AS imbalance, (vc + vv) / greatest((h - l) / tick, 1.0) AS absorcao, vr / (vr + vc + vv) AS rlp_frac FROM a JOIN tk USING (symbol) WHERE n > 0)
SELECT symbol, bar_id, round(imbalance, 6) AS imbalance, round(absorcao, 4) AS absorcao, round(rlp_frac, 6) AS rlp_frac, round({sql_z('imbalance', 'PARTITION BY symbol ORDER BY bar_id', 50, 25)}, 5) + 0.0 AS z_imbalance FROM f""")
def j08_time_bar_features(spark, d):
    """Flow features of 5-minute bars in the symbol's own tick, with a score over 250 minutes of bars."""
    rows = B.time_bars(tape_once(spark, d), _P5).join(table(spark, d, "ativos", "symbol", "tick"), "symbol")
    f = B.flow_features(rows, ["symbol", "bar_id", "tick"], F.col("tick"))
    return f.select("symbol", "bar_id", r6("imbalance").alias("imbalance"), r6("absorcao", 4).alias("absorcao"), r6("rlp_frac").alias("rlp_frac"), r6(strict_past_z(F.col("imbalance"), by_bar(), 50), 5).alias("z_imbalance"))


_KS = (1.0, 2.0, 3.0)


@R.add(f"""WITH {sql_barrier(_M1W, 10)}, ks AS (SELECT unnest([1.0, 2.0, 3.0]::double[]) AS k), c AS (SELECT s.symbol, s.dt, s.i, k, s.close * (1 + k * s.sigma) AS u, s.close * (1 - k * s.sigma) AS l FROM sg s, ks WHERE s.sigma IS NOT NULL),
h AS (SELECT c.symbol, c.dt, c.i, c.k, arg_min(CASE WHEN f.high >= u AND f.low <= l THEN 0 WHEN f.high >= u THEN 1 ELSE -1 END, f.i) AS r FROM c JOIN sg f ON f.symbol = c.symbol AND f.dt = c.dt AND f.i BETWEEN c.i + 1 AND c.i + 10 WHERE f.high >= u OR f.low <= l GROUP BY ALL),
s AS (SELECT c.symbol, c.k, count(*) AS n, count(*) FILTER (WHERE h.r <> 0) AS resolvidas FROM c LEFT JOIN h USING (symbol, dt, i, k) GROUP BY ALL)
SELECT symbol, max(k) FILTER (WHERE resolvidas >= 0.6 * n) AS k, any_value(n) AS n FROM s GROUP BY symbol""")
def j13_barrier_choice(spark, d):
    """The widest barrier that still resolves 60 % of the bars."""
    bars, parts = m1(spark, d), None
    for k in _KS:
        p = triple_barrier(bars, ["symbol", "dt"], "minuto", k, 10, 20, 10).where("sigma is not null").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("rotulo") != 0).alias("r")).withColumn("k", F.lit(k))
        parts = p if parts is None else parts.unionByName(p)
    return parts.groupBy("symbol").agg(F.max(F.when(F.col("r") >= 0.6 * F.col("n"), F.col("k"))).alias("k"), F.max("n").alias("n"))


@R.add(f"WITH {SQL_TAPE}, {_BIG}, w AS (SELECT e.symbol, e.dt, e.trade_id, t.trade_id AS id, t.quantidade AS q, t.agente_comprador AS c, t.agente_vendedor AS v FROM ev e JOIN tape t ON t.symbol = e.symbol AND t.dt = e.dt AND t.ts_ns > e.ts_ns AND t.ts_ns <= e.ts_ns + 60000000000 WHERE t.trade_type IN (2, 3)), k AS (SELECT *, row_number() OVER (PARTITION BY symbol, dt, trade_id ORDER BY q DESC, id) AS k FROM w), c1 AS (SELECT symbol, dt, trade_id, sum(q) AS total, sum(q) FILTER (WHERE k <= 5) AS cinco, sum(CASE WHEN c = 0 OR v = 0 THEN q ELSE 0 END) AS anonimo FROM k GROUP BY ALL), l AS (SELECT symbol, dt, trade_id, c AS ag, q FROM w WHERE c > 0 UNION ALL SELECT symbol, dt, trade_id, v, -q FROM w WHERE v > 0), n AS (SELECT symbol, dt, trade_id, max(abs(s)) AS maior FROM (SELECT symbol, dt, trade_id, ag, sum(q) AS s FROM l GROUP BY ALL) GROUP BY ALL) SELECT c1.symbol, c1.dt, c1.trade_id, round(cinco / total, 6) AS c1, round(coalesce(maior, 0) / total, 6) AS c2, round(anonimo / total, 6) AS anonimo FROM c1 LEFT JOIN n USING (symbol, dt, trade_id)")
def j14_burst_features(spark, d):
    """Of the minute after a large buy: the five largest trades' share, the largest broker's net share, the share without brokers."""
    t = tape(spark, d)
    ident = ["symbol", "dt", "trade_id"]
    path = t.where(is_aggressor(F.col("trade_type"))).select("symbol", "dt", "ts_ns", F.col("trade_id").alias("id"), F.col("quantidade").alias("q"), F.col("agente_comprador").alias("c"), F.col("agente_vendedor").alias("v"))
    w = range_join(big_buys(t), path, ["symbol", "dt"], "ts_ns", "ts_ns", MINUTE, ["id", "q", "c", "v"]).select(*ident, "id", "q", "c", "v")
    ranked = w.withColumn("k", F.row_number().over(Window.partitionBy(*ident).orderBy(F.desc("q"), "id")))
    c1 = ranked.groupBy(*ident).agg(F.sum("q").alias("total"), F.sum(F.when(F.col("k") <= 5, F.col("q"))).alias("cinco"), F.sum(F.when((F.col("c") == 0) | (F.col("v") == 0), F.col("q")).otherwise(0)).alias("an"))
    legs = w.select(*ident, F.explode(F.array(F.struct(F.col("c").alias("a"), F.col("q").alias("s")), F.struct(F.col("v").alias("a"), (-F.col("q")).alias("s")))).alias("l")).where("l.a > 0")
    net = legs.groupBy(*ident, "l.a").agg(F.abs(F.sum("l.s")).alias("s")).groupBy(*ident).agg(F.max("s").alias("maior"))
    share = lambda c: r6(F.coalesce(F.col(c), F.lit(0)) / F.col("total"))
    return c1.join(net, ident, "left").select(*ident, share("cinco").alias("c1"), share("maior").alias("c2"), share("an").alias("anonimo"))


# ---- L ---------------------------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_DIA}, a AS (SELECT symbol, dt, CASE WHEN count(*) OVER w >= 1 THEN quantile_cont(h - l, 0.5) OVER w END AS amp FROM dia WINDOW w AS ({'PARTITION BY symbol ORDER BY dt'} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)), j AS (SELECT symbol, dt, minuto, close - lag(close) OVER ({_M1W}) AS salto, minuto - lag(minuto) OVER ({_M1W}) AS passo FROM m1) SELECT j.symbol, j.dt, j.minuto, round(salto, 6) AS salto FROM j JOIN a USING (symbol, dt) WHERE passo = 1 AND round(abs(salto) - 0.15 * amp, 9) >= 0 AND amp > 0")
def l04_amplitude_jumps(spark, d):
    """Jumps between neighbouring minutes of at least 0.15 of the median range of up to 20 previous days."""
    w = by_day().rowsBetween(-20, -1)
    amp = days(spark, d).select("symbol", "dt", F.when(F.count(F.lit(1)).over(w) >= 1, F.percentile(F.col("h") - F.col("l"), F.lit(0.5)).over(w)).alias("amp"))
    j = m1(spark, d).select("symbol", "dt", "minuto", (F.col("close") - F.lag("close").over(in_minutes())).alias("salto"), (F.col("minuto") - F.lag("minuto").over(in_minutes())).alias("passo"))
    return j.join(amp, ["symbol", "dt"]).where((F.col("passo") == 1) & (F.round(F.abs("salto") - 0.15 * F.col("amp"), 9) >= 0) & (F.col("amp") > 0)).select("symbol", "dt", "minuto", r6("salto").alias("salto"))


@R.add(f"WITH {SQL_M1}, top AS (SELECT symbol FROM m1 GROUP BY symbol ORDER BY count(*) DESC, symbol LIMIT 1), r AS (SELECT symbol, dt, minuto, ln(close / lag(close) OVER ({_M1W})) AS r FROM m1), j AS (SELECT a.symbol, a.dt, a.minuto, a.r AS x, l.r AS y FROM r a JOIN r l ON l.dt = a.dt AND l.minuto = a.minuto AND l.symbol IN (SELECT symbol FROM top) WHERE a.symbol NOT IN (SELECT symbol FROM top) AND a.r IS NOT NULL AND l.r IS NOT NULL), s AS (SELECT symbol, x, y, lead(x) OVER ({_M1W}) AS x1, lead(y) OVER ({_M1W}) AS y1 FROM j) SELECT symbol, count(*) AS n, round(CASE WHEN count(*) >= 30 AND var_pop(x) FILTER (WHERE y1 IS NOT NULL) > 1e-18 AND var_pop(y1) > 1e-18 THEN corr(x, y1) END, 5) + 0.0 AS antecede, round(CASE WHEN count(*) >= 30 AND var_pop(y) FILTER (WHERE x1 IS NOT NULL) > 1e-18 AND var_pop(x1) > 1e-18 THEN corr(y, x1) END, 5) + 0.0 AS segue FROM s GROUP BY symbol")
def l07_antecedence(spark, d):
    """Whether a symbol's return goes before the leader's next one, or after: shifted after the inner join, on common minutes."""
    bars = m1(spark, d)
    top = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "symbol").limit(1).select("symbol")
    r = bars.select("symbol", "dt", "minuto", F.log(F.col("close") / F.lag("close").over(in_minutes())).alias("x")).where("x is not null")
    lead = r.join(top, "symbol", "left_semi").select("dt", "minuto", F.col("x").alias("y"))
    s = r.join(top, "symbol", "left_anti").join(lead, ["dt", "minuto"]).withColumns({"x1": F.lead("x").over(in_minutes()), "y1": F.lead("y").over(in_minutes())})

    def pair(a: str, b: str):  # noqa: ANN202
        x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.col(b)
        return r6(F.when((F.count(F.lit(1)) >= 30) & (F.var_pop(x) > 1e-18) & (F.var_pop(y) > 1e-18), correlation(x, y)), 5)

    return s.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), pair("x", "y1").alias("antecede"), pair("y", "x1").alias("segue"))


@R.add(f"WITH k AS ({RESEARCH_SQL['k01_rsi_ema']}), l AS (SELECT *, lag(rsi) OVER ({_M1W}) AS antes, lead(minuto) OVER ({_M1W}) AS prox FROM k) SELECT symbol, dt, minuto, CASE WHEN rsi <= 10 THEN 'compra' ELSE 'venda' END AS lado FROM l WHERE prox IS NOT NULL AND ((rsi <= 10 AND (antes IS NULL OR antes > 10)) OR (rsi >= 90 AND (antes IS NULL OR antes < 90)))")
def l08_rsi_extremes(spark, d):
    """The first bar of each excursion of RSI(2) to 10 or 90, if a next bar exists."""
    k = k01_rsi_ema(spark, d).withColumns({"antes": F.lag("rsi").over(in_minutes()), "prox": F.lead("minuto").over(in_minutes())}).where("prox is not null")
    low = (F.col("rsi") <= 10) & (F.col("antes").isNull() | (F.col("antes") > 10))
    high = (F.col("rsi") >= 90) & (F.col("antes").isNull() | (F.col("antes") < 90))
    return k.where(low | high).select("symbol", "dt", "minuto", F.when(F.col("rsi") <= 10, "compra").otherwise("venda").alias("lado"))


@R.add(f"WITH {SQL_DIA}, g AS (SELECT symbol, dt, o, h, l, c, lag(c) OVER (PARTITION BY symbol ORDER BY dt) AS pc FROM dia) SELECT symbol, dt, round(o - pc, 6) AS gap, CASE WHEN o > pc THEN l <= pc WHEN o < pc THEN h >= pc ELSE true END AS fechado FROM g WHERE pc IS NOT NULL")
def l13_opening_gap(spark, d):
    """Opening gaps and whether the session closed them."""
    g = days(spark, d).withColumn("pc", F.lag("c").over(by_day())).where("pc is not null")
    closed = F.when(F.col("o") > F.col("pc"), F.col("l") <= F.col("pc")).when(F.col("o") < F.col("pc"), F.col("h") >= F.col("pc")).otherwise(True)
    return g.select("symbol", "dt", r6(F.col("o") - F.col("pc")).alias("gap"), closed.alias("fechado"))


@R.add(f"WITH {SQL_M1}, s AS (SELECT symbol, dt, ts_ns // {MINUTE} AS minuto, sum(round(price * 100)::hugeint * quantidade) AS pq, sum(quantidade)::hugeint AS q FROM tape WHERE trade_type IN (2, 3) GROUP BY ALL), v AS (SELECT m1.symbol, m1.dt, m1.minuto, round(close * 100)::hugeint * sum(q) OVER w - sum(pq) OVER w AS lado FROM m1 JOIN s USING (symbol, dt, minuto) WINDOW w AS (PARTITION BY m1.symbol, m1.dt ORDER BY m1.minuto)), c AS (SELECT *, sign(lado) AS g, lag(sign(lado)) OVER ({_M1W}) AS antes FROM v) SELECT symbol, dt, minuto, CASE WHEN g > 0 THEN 'acima' ELSE 'abaixo' END AS cruzou FROM c WHERE g <> 0 AND antes <> 0 AND g <> antes")
def l17_vwap_crossings(spark, d):
    """Minutes whose close is on the other side of the session's VWAP than the close before; in whole hundredths, so exact."""
    rows = tape(spark, d).withColumn("minuto", F.expr(f"ts_ns div {MINUTE}")).where(is_aggressor(F.col("trade_type")))
    cents = lambda c: F.round(F.col(c) * 100).cast("decimal(19,0)")
    s = rows.groupBy("symbol", "dt", "minuto").agg(F.sum(cents("price") * F.col("quantidade")).cast("decimal(30,0)").alias("pq"), F.sum("quantidade").cast("decimal(15,0)").alias("q"))
    b = B.ohlc(rows, ["symbol", "dt", "minuto"]).join(s, ["symbol", "dt", "minuto"])
    w = in_minutes().rowsBetween(Window.unboundedPreceding, 0)
    side = cents("close") * F.sum("q").over(w).cast("decimal(18,0)") - F.sum("pq").over(w).cast("decimal(37,0)")
    b = b.withColumn("g", F.when(side > 0, 1).when(side < 0, -1).otherwise(0)).withColumn("antes", F.lag("g").over(in_minutes()))
    return b.where("g <> 0 and antes <> 0 and g <> antes").select("symbol", "dt", "minuto", F.when(F.col("g") > 0, "acima").otherwise("abaixo").alias("cruzou"))


@R.add(f"WITH r AS ({RESEARCH_SQL['l18_iceberg_runs']}), {SQL_TAPE} SELECT r.symbol, r.dt, r.price, r.quantidade, r.passivo, r.ilha, count(*) FILTER (WHERE abs(t.price - r.price) > tick + 1e-9) > 0 AS saiu FROM r JOIN (SELECT {SQL_SYMBOL} AS symbol, tick FROM ativos) k USING (symbol) JOIN tape t ON t.symbol = r.symbol AND t.dt = r.dt AND t.ts_ns BETWEEN r.de AND r.ate GROUP BY ALL")
def l19_level_left(spark, d):
    """Whether the price left a run's level by more than a tick between its first and last trade."""
    t = tape(spark, d)
    runs = iceberg_runs(t).join(table(spark, d, "ativos", "symbol", "tick"), "symbol").withColumn("_m", F.explode(F.sequence(F.expr(f"de div {MINUTE}"), F.expr(f"ate div {MINUTE}"))))
    path = t.select("symbol", "dt", "ts_ns", F.col("price").alias("p"), F.expr(f"ts_ns div {MINUTE}").alias("_m"))
    met = runs.join(path, ["symbol", "dt", "_m"]).where("ts_ns >= de and ts_ns <= ate")
    return met.groupBy("symbol", "dt", "price", "quantidade", "passivo", "ilha").agg((F.count_if(F.abs(F.col("p") - F.col("price")) > F.col("tick") + 1e-9) > 0).alias("saiu"))


# ---- M, O, P ---------------------------------------------------------------------------------------------------------


@R.add(f"SELECT upper(trim(ticker)) AS symbol, count(*) AS n, round(avg(CASE WHEN lado = 1 THEN preco_medio - preco ELSE preco - preco_medio END), 6) + 0.0 AS escorregamento, sum(executada)::bigint AS executada FROM evento_ordem WHERE executada > 0 AND preco > 0 AND preco_medio > 0 AND lado IN (1, 2) GROUP BY ALL")
def m17_slippage(spark, d):
    """Mean slippage of executed orders against their own price."""
    e = table(spark, d, "evento_ordem", "ticker", "executada", "preco", "preco_medio", "lado").where("executada > 0 and preco > 0 and preco_medio > 0 and lado in (1, 2)")
    slip = F.when(F.col("lado") == 1, F.col("preco_medio") - F.col("preco")).otherwise(F.col("preco") - F.col("preco_medio"))
    return e.groupBy(F.col("ticker").alias("symbol")).agg(F.count(F.lit(1)).alias("n"), r6(F.avg(slip)).alias("escorregamento"), F.sum("executada").alias("executada"))


@R.add(f"WITH i AS ({RESEARCH_SQL['o02_information_coefficient']}) SELECT feature, count(*) AS celulas, count(*) FILTER (WHERE abs(ic) >= round(2 / sqrt(n), 5)) AS acima, round(0.0455 * count(*), 4) AS esperadas FROM i WHERE ic IS NOT NULL GROUP BY feature")
def o15_expected_by_chance(spark, d):
    """Cells beyond two standard errors against the number that chance gives."""
    i = o02_information_coefficient(spark, d).where("ic is not null")
    return i.groupBy("feature").agg(F.count(F.lit(1)).alias("celulas"), F.count_if(F.abs("ic") >= F.round(2 / F.sqrt("n"), 5)).alias("acima"), r6(0.0455 * F.count(F.lit(1)), 4).alias("esperadas"))


@R.add(f"WITH {SQL_TAPE}, b AS (SELECT symbol, dt, ts_ns // {_P5} AS bucket, trade_type IN (2, 3) AS agr, price, ts_ns, ts_recv_ns, trade_id FROM tape WHERE trade_type IN (2, 3, 13)), x AS (SELECT symbol, dt, bucket, arg_max(price, {{'a': ts_ns, 'b': ts_recv_ns, 'c': trade_id}}) AS c, max(price) AS h FROM b WHERE agr GROUP BY ALL), y AS (SELECT symbol, dt, bucket, arg_max(price, {{'a': ts_ns, 'b': ts_recv_ns, 'c': trade_id}}) AS c, max(price) AS h FROM b GROUP BY ALL) SELECT coalesce(x.symbol, y.symbol) AS symbol, count(*) FILTER (WHERE x.c IS NULL) AS so_direita, count(*) FILTER (WHERE y.c IS NULL) AS so_esquerda, count(*) FILTER (WHERE abs(x.c - y.c) > 1e-9) AS fechos_diferentes, count(*) FILTER (WHERE abs(x.h - y.h) > 1e-9) AS maximas_diferentes FROM x FULL JOIN y ON x.symbol = y.symbol AND x.dt = y.dt AND x.bucket = y.bucket GROUP BY ALL")
def mk05_bar_parity(spark, d):
    """Bars of aggressor trades against bars with retail trades: only on one side, or different fields."""
    t = tape(spark, d).withColumn("bucket", F.expr(f"ts_ns div {_P5}"))
    keys = ["symbol", "dt", "bucket"]
    left, right = B.ohlc(t, keys), B.ohlc(t.where("trade_type in (2, 3, 13)"), keys, only_aggressors=False)
    both = compare(left, right, keys, ["close", "high"])
    has = lambda f: F.count_if(F.array_contains("diferentes", f))
    return both.groupBy("symbol").agg(F.count_if(F.col("lado") == "direita").alias("so_direita"), F.count_if(F.col("lado") == "esquerda").alias("so_esquerda"), has("close").alias("fechos_diferentes"), has("high").alias("maximas_diferentes"))


_WED = "(make_date(year(x), month(x), 15) + ((3 - isodow(make_date(year(x), month(x), 15)) + 10) % 7 - 3)::int)"


@R.add(f"WITH s AS (SELECT DISTINCT dt::date AS dia FROM trades), m AS (SELECT DISTINCT unnest([dia - INTERVAL 1 MONTH, dia, dia + INTERVAL 1 MONTH, dia + INTERVAL 2 MONTH])::date AS x FROM s), e AS (SELECT DISTINCT {_WED}::date AS venc FROM m WHERE month(x) % 2 = 0) SELECT strftime(dia, '%Y-%m-%d') AS dt, strftime(min(venc), '%Y-%m-%d') AS vencimento, min(date_diff('day', dia, venc))::bigint AS dias FROM s JOIN e ON venc >= dia GROUP BY dia")
def mk01_next_expiry(spark, d):
    """Each session with the next expiry (the Wednesday nearest the 15th of an even month) and the days to it."""
    s = table(spark, d, "trades", "dt").distinct().select(F.to_date("dt").alias("dia"))
    months = F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1, 2))), lambda k: F.add_months("dia", k)))
    e = s.withColumn("x", months).where(F.month("x") % 2 == 0).withColumn("venc", nearest_wednesday(F.col("x"))).where("venc >= dia")
    return e.groupBy("dia").agg(F.min("venc").alias("v")).select(F.date_format("dia", "yyyy-MM-dd").alias("dt"), F.date_format("v", "yyyy-MM-dd").alias("vencimento"), F.datediff("v", "dia").cast("bigint").alias("dias"))


@R.add(f"WITH {SQL_M1}, g AS (SELECT symbol, dt, lead(minuto) OVER ({_M1W}) - minuto AS passo FROM m1) SELECT symbol, dt, round(median(passo), 6) AS passo_mediano, max(passo) AS maior, count(*) FILTER (WHERE passo > 10) AS falhas FROM g WHERE passo IS NOT NULL GROUP BY ALL")
def mk21_resolution(spark, d):
    """The step a series really has, its longest gap and how many are above ten minutes."""
    g = m1(spark, d).select("symbol", "dt", (F.lead("minuto").over(in_minutes()) - F.col("minuto")).alias("passo")).where("passo is not null")
    return g.groupBy("symbol", "dt").agg(r6(F.median("passo")).alias("passo_mediano"), F.max("passo").alias("maior"), F.count_if(F.col("passo") > 10).alias("falhas"))


QUERIES, ORACLES = R.queries, R.sql
