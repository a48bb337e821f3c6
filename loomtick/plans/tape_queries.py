"""Scans, predicates, joins, aggregates, windows, orderings and sets over the tape (inventory groups A to H)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalars import half_up_tick, microprice, ticker_family, wilson
from ..operators.asof import asof_backward, first_hit, has_within, path_extremes
from ..operators.bars import SLICE_NS, broker_flow, ohlc, two_digits
from ..operators.tape import TAPE_ORDER, aggressor_sign, is_aggressor, local_hhmm, passive_broker, plausible
from ..operators.windows import average_rank, carried, correlation, drawdown, full_window, islands, sliced_running_sum, strict_past_z, valid_only_z, with_previous
from ..sources.tables import table, valid_ts
from .registry import SQL_QUOTES, SQL_SYMBOL, SQL_TAPE, SQL_VALID, Registry, quotes, r6, tape, tape_once

R = Registry()
MINUTE = 60_000_000_000


def in_day() -> WindowSpec:
    return Window.partitionBy("symbol", "dt")


def in_order() -> WindowSpec:
    """A symbol's day in the tape's total order."""
    return in_day().orderBy("ts_ns", "ts_recv_ns", "trade_id")


def in_minutes() -> WindowSpec:
    return in_day().orderBy("minuto")


SQL_ORD = "PARTITION BY symbol, dt ORDER BY ts_ns, ts_recv_ns, trade_id"
SQL_HHMM = "((ts_ns // 60000000000 - 180) % 1440 // 60 * 100 + (ts_ns // 60000000000 - 180) % 60)"

#: One-minute aggressor candles, the base of many queries.
SQL_M1 = f"""{SQL_TAPE}, m1 AS (
  SELECT symbol, dt, ts_ns // {MINUTE} AS minuto, arg_min(price, {{'a': ts_ns, 'b': ts_recv_ns, 'c': trade_id}}) AS open, max(price) AS high, min(price) AS low,
    arg_max(price, {{'a': ts_ns, 'b': ts_recv_ns, 'c': trade_id}}) AS close, sum(quantidade)::bigint AS volume, count(*) AS n_trades
  FROM tape WHERE trade_type IN (2, 3) GROUP BY ALL)"""


def m1(spark: SparkSession, d: str) -> DataFrame:
    rows = tape(spark, d).withColumn("minuto", F.expr(f"ts_ns div {MINUTE}"))
    return ohlc(rows, ["symbol", "dt", "minuto"]).drop("ts_open", "ts_close")



# ---- A: scans --------------------------------------------------------------------------------------------------------


@R.add(f"SELECT DISTINCT {SQL_SYMBOL} AS symbol, dt FROM trades")
def a02_days(spark, d):
    return table(spark, d, "trades", "symbol", "dt").distinct()


@R.add(f"WITH {SQL_TAPE} SELECT symbol, dt, trade_id, ts_ns, ts_recv_ns, price, quantidade, agente_comprador, agente_vendedor, trade_type FROM tape")
def a03_curated_tape(spark, d):
    return tape(spark, d).select("symbol", "dt", "trade_id", "ts_ns", "ts_recv_ns", "price", "quantidade", "agente_comprador", "agente_vendedor", "trade_type")


@R.add(f"SELECT {SQL_SYMBOL} AS symbol, dt, seq, ts_recv_ns, row_number() OVER (PARTITION BY {SQL_SYMBOL}, dt ORDER BY ts_recv_ns, seq, file_id, coalesce(offer_id, -1), coalesce(position, -1), coalesce(action, -1), quantidade) AS ordem FROM book_offer")
def a04_book_arrival_order(spark, d):
    b = table(spark, d, "book_offer", "symbol", "dt", "seq", "ts_recv_ns", "file_id", "offer_id", "position", "action", "quantidade")
    w = in_day().orderBy("ts_recv_ns", "seq", "file_id", *(F.coalesce(F.col(c), F.lit(-1)) for c in ("offer_id", "position", "action")), "quantidade")
    return b.select("symbol", "dt", "seq", "ts_recv_ns", F.row_number().over(w).cast("bigint").alias("ordem"))


@R.add("SELECT dt, count(*) AS linhas, count(DISTINCT file_id) AS arquivos FROM trades GROUP BY dt")
def a06_rows_per_day(spark, d):
    return table(spark, d, "trades", "dt", "file_id").groupBy("dt").agg(F.count(F.lit(1)).alias("linhas"), F.count_distinct("file_id").alias("arquivos"))


@R.add("SELECT file_id, count(*) AS linhas, min(ts_recv_ns) AS de, max(ts_recv_ns) AS ate FROM trades GROUP BY file_id")
def a07_file_spans(spark, d):
    return table(spark, d, "trades", "file_id", "ts_recv_ns").groupBy("file_id").agg(F.count(F.lit(1)).alias("linhas"), F.min("ts_recv_ns").alias("de"), F.max("ts_recv_ns").alias("ate"))


@R.add("WITH w AS (SELECT DISTINCT file_id FROM capture_files) SELECT w.file_id FROM w WHERE NOT EXISTS (SELECT 1 FROM trades t WHERE t.file_id = w.file_id) AND NOT EXISTS (SELECT 1 FROM book_offer b WHERE b.file_id = w.file_id)")
def a23_files_to_fetch(spark, d):
    """Listed files of which no row has arrived: what a resumed ingest still has to read."""
    have = table(spark, d, "trades", "file_id").unionByName(table(spark, d, "book_offer", "file_id"))
    return table(spark, d, "capture_files", "file_id").distinct().join(have, "file_id", "left_anti")


# ---- B: predicates ---------------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_TAPE} SELECT symbol, dt, sum(quantidade)::bigint AS volume, sum(CASE trade_type WHEN 2 THEN quantidade ELSE -quantidade END)::bigint AS saldo FROM tape WHERE trade_type IN (2, 3) GROUP BY ALL")
def b02_signed_volume(spark, d):
    t = tape(spark, d).where(is_aggressor(F.col("trade_type")))
    return t.groupBy("symbol", "dt").agg(F.sum("quantidade").alias("volume"), F.sum(aggressor_sign(F.col("trade_type")) * F.col("quantidade")).alias("saldo"))


@R.add(f"SELECT {SQL_SYMBOL} AS symbol, dt, count(*) AS linhas, count(*) FILTER (WHERE coalesce({SQL_VALID}, false)) AS validas, count(*) FILTER (WHERE ts_ns = 0) AS zeradas, count(*) FILTER (WHERE ts_ns > ts_recv_ns - 157680000000000000 AND ts_ns <= ts_recv_ns) AS plausiveis FROM trades GROUP BY ALL")
def b03_valid_and_plausible(spark, d):
    t = table(spark, d, "trades", "ts_ns", "ts_recv_ns", "symbol", "dt")
    n = lambda c: F.count_if(c)
    return t.groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("linhas"), n(valid_ts(F.col("ts_ns"), F.col("dt"))).alias("validas"), n(F.col("ts_ns") == 0).alias("zeradas"), n(plausible(F.col("ts_ns"), F.col("ts_recv_ns"))).alias("plausiveis"))


@R.add(f"WITH {SQL_TAPE} SELECT symbol, CASE trade_type WHEN 2 THEN agente_vendedor WHEN 3 THEN agente_comprador ELSE 0 END AS passivo, sum(quantidade)::bigint AS volume FROM tape GROUP BY ALL")
def b05_passive_broker(spark, d):
    t = tape(spark, d).withColumn("passivo", passive_broker(F.col("trade_type"), F.col("agente_comprador"), F.col("agente_vendedor")).cast("bigint"))
    return t.groupBy("symbol", "passivo").agg(F.sum("quantidade").alias("volume"))


@R.add(f"WITH {SQL_TAPE} SELECT symbol, dt, {SQL_HHMM} AS hhmm, count(*) AS n FROM tape WHERE {SQL_HHMM} >= 1000 AND {SQL_HHMM} < 1100 GROUP BY ALL")
def b06_session_window(spark, d):
    t = tape(spark, d).withColumn("hhmm", local_hhmm(F.col("ts_ns"))).where("hhmm >= 1000 and hhmm < 1100")
    return t.groupBy("symbol", "dt", "hhmm").agg(F.count(F.lit(1)).alias("n"))


@R.add(f"WITH {SQL_M1}, dias AS (SELECT symbol, dt FROM m1 GROUP BY ALL HAVING count(*) >= 30) SELECT m1.symbol, m1.dt, count(*) AS barras, sum(volume)::bigint AS volume FROM m1 JOIN dias USING (symbol, dt) GROUP BY ALL")
def b07_complete_days(spark, d):
    bars = m1(spark, d)
    days = bars.groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("_n")).where("_n >= 30")
    return bars.join(days, ["symbol", "dt"], "left_semi").groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("barras"), F.sum("volume").alias("volume"))


_FUNNEL = ("close > open", "high - low > 0", "n_trades >= 2", "volume >= 10")


@R.add(f"WITH {SQL_M1} SELECT symbol, count(*) AS barras, " + ", ".join(f"count(*) FILTER (WHERE {' AND '.join(_FUNNEL[: i + 1])}) AS clausula_{i + 1}" for i in range(4)) + " FROM m1 GROUP BY symbol")
def b08_clause_funnel(spark, d):
    """Survivors of a list of clauses, one after the other."""
    kept, aggs = F.lit(True), [F.count(F.lit(1)).alias("barras")]
    for i, clause in enumerate(_FUNNEL):
        kept = kept & F.expr(clause)
        aggs.append(F.count_if(kept).alias(f"clausula_{i + 1}"))
    return m1(spark, d).groupBy("symbol").agg(*aggs)


# ---- C: joins --------------------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_M1}, dia AS (SELECT symbol, dt, sum(volume)::bigint AS total FROM m1 GROUP BY ALL) SELECT symbol, dt, minuto, round(volume / total, 6) AS parte FROM m1 JOIN dia USING (symbol, dt)")
def c01_day_share(spark, d):
    bars = m1(spark, d)
    total = bars.groupBy("symbol", "dt").agg(F.sum("volume").alias("total"))
    return bars.join(total, ["symbol", "dt"]).select("symbol", "dt", "minuto", r6(F.col("volume") / F.col("total")).alias("parte"))


@R.add(f"WITH {SQL_TAPE} SELECT t.symbol, coalesce(a.familia, 'NAO_CLASSIFICADO') AS familia, count(*) AS n FROM tape t LEFT JOIN (SELECT {SQL_SYMBOL} AS symbol, familia FROM ativos) a USING (symbol) GROUP BY ALL")
def c02_family_lookup(spark, d):
    """A left join to a lookup; Spark broadcasts it only below its size threshold."""
    n = tape(spark, d).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    return n.join(table(spark, d, "ativos", "symbol", "familia"), "symbol", "left").select("symbol", F.coalesce("familia", F.lit("NAO_CLASSIFICADO")).alias("familia"), "n")


@R.add(f"WITH a AS (SELECT {SQL_SYMBOL} AS symbol, dt, count(*) AS negocios FROM trades WHERE {SQL_VALID} GROUP BY ALL), b AS (SELECT {SQL_SYMBOL} AS symbol, dt, count(*) AS livro FROM book_offer WHERE {SQL_VALID} GROUP BY ALL) SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.dt, b.dt) AS dt, negocios, livro, CASE WHEN livro IS NULL THEN 'so_negocios' WHEN negocios IS NULL THEN 'so_livro' ELSE 'ambos' END AS lado FROM a FULL JOIN b ON a.symbol = b.symbol AND a.dt = b.dt")
def c03_reconcile_streams(spark, d):
    count = lambda name, out: table(spark, d, name, "ts_ns", "symbol", "dt").where(valid_ts(F.col("ts_ns"), F.col("dt"))).groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias(out))
    both = count("trades", "negocios").join(count("book_offer", "livro"), ["symbol", "dt"], "full_outer")
    return both.withColumn("lado", F.when(F.col("livro").isNull(), "so_negocios").when(F.col("negocios").isNull(), "so_livro").otherwise("ambos"))


@R.add(f"WITH {SQL_TAPE}, {SQL_QUOTES}, q AS (SELECT symbol, dia, ts_recv_ns AS ts_ns, max({{'topo_id': topo_id, 'b': coalesce(preco_bid, -1), 'a': coalesce(preco_ask, -1)}}) AS w FROM quotes GROUP BY ALL) SELECT t.symbol, t.dt, t.trade_id, q.w['topo_id'] AS topo_id FROM tape t ASOF LEFT JOIN q ON t.symbol = q.symbol AND t.ts_ns // 86400000000000 = q.dia AND t.ts_ns >= q.ts_ns")
def c04_asof_quote(spark, d):
    """Each trade with the day's last quote at or before it."""
    q = quotes(spark, d).select("symbol", "dia", F.col("ts_recv_ns").alias("ts_ns"), "topo_id", "preco_bid", "preco_ask")
    return asof_backward(tape(spark, d).select("symbol", "dt", "trade_id", "ts_ns", F.expr("ts_ns div 86400000000000").alias("dia")), q, ["symbol", "dia"], "ts_ns", ["topo_id"], slice_size=SLICE_NS).select("symbol", "dt", "trade_id", "topo_id")


_P = "p AS (SELECT symbol, dt, ts_ns, max({'a': ts_recv_ns, 'b': trade_id, 'p': price}) AS w FROM tape GROUP BY ALL)"


@R.add(f"WITH {SQL_TAPE}, {_P}, e AS (SELECT symbol, dt, trade_id, price, ts_ns - 60000000000 AS antes FROM tape) SELECT e.symbol, e.dt, e.trade_id, round(e.price - p.w['p'], 6) AS variacao FROM e ASOF LEFT JOIN p ON e.symbol = p.symbol AND e.dt = p.dt AND e.antes >= p.ts_ns")
def c05_price_a_minute_ago(spark, d):
    t = tape_once(spark, d)
    probe = t.select("symbol", "dt", "trade_id", "price", (F.col("ts_ns") - MINUTE).alias("ts_ns"))
    path = t.select("symbol", "dt", "ts_ns", "ts_recv_ns", "trade_id", F.col("price").alias("antes")).withColumnRenamed("trade_id", "_id")
    out = asof_backward(probe, path, ["symbol", "dt"], "ts_ns", ["antes"], tie=["ts_recv_ns", "_id"], slice_size=SLICE_NS)
    return out.select("symbol", "dt", "trade_id", r6(F.col("price") - F.col("antes")).alias("variacao"))


_BIG = "ev AS (SELECT symbol, dt, trade_id, ts_ns, price FROM tape WHERE trade_type = 2 AND quantidade >= (SELECT quantile_disc(quantidade, 0.99) FROM tape t2 WHERE t2.symbol = tape.symbol))"


def big_buys(t: DataFrame) -> DataFrame:
    """Aggressor buys of at least the symbol's 99th percentile of size."""
    limit = t.groupBy("symbol").agg(F.expr("percentile_disc(0.99) within group (order by quantidade)").alias("_q"))
    return t.join(limit, "symbol").where("trade_type = 2 and quantidade >= _q").select("symbol", "dt", "trade_id", "ts_ns", "price")


@R.add(f"WITH {SQL_TAPE}, {_BIG} SELECT e.symbol, e.dt, e.trade_id, max(round(t.price - e.price, 6)) AS melhor, min(round(t.price - e.price, 6)) AS pior, count(*) AS n FROM ev e JOIN tape t ON t.symbol = e.symbol AND t.dt = e.dt AND t.ts_ns > e.ts_ns AND t.ts_ns <= e.ts_ns + 120000000000 GROUP BY ALL")
def c07_forward_path(spark, d):
    """Excursion of the price in the two minutes after a large aggressor buy."""
    t, ident = tape_once(spark, d), ["symbol", "dt", "trade_id"]
    e = big_buys(t)
    x = path_extremes(e, t, ["symbol", "dt"], ident, "ts_ns", "ts_ns", 2 * MINUTE, "price")
    move = lambda c: r6(F.col(c) - F.col("price"))
    return e.join(x, ident).select(*ident, move("maior").alias("melhor"), move("menor").alias("pior"), "n")


@R.add(f"WITH {SQL_TAPE}, {_BIG}, h AS (SELECT e.symbol, e.dt, e.trade_id, min({{'at': t.ts_ns, 'r': t.ts_recv_ns, 'id': t.trade_id, 'p': t.price}}) AS w FROM ev e JOIN tape t ON t.symbol = e.symbol AND t.dt = e.dt AND t.ts_ns > e.ts_ns AND t.ts_ns <= e.ts_ns + 600000000000 AND t.price < e.price GROUP BY ALL) SELECT symbol, dt, trade_id, w['at'] AS tocou_ns, w['p'] AS preco FROM h")
def c08_first_touch(spark, d):
    """The first trade below the price of a large buy, within ten minutes."""
    t = tape(spark, d)
    path = t.select("symbol", "dt", "ts_ns", "ts_recv_ns", F.col("trade_id").alias("id"), F.col("price").alias("p"))
    hit = first_hit(big_buys(t), path, ["symbol", "dt"], ["symbol", "dt", "trade_id"], "ts_ns", "ts_ns", 10 * MINUTE, ["ts_recv_ns", "id", "p"], F.col("p") < F.col("price"), ["ts_recv_ns", "id"])
    return hit.select("symbol", "dt", "trade_id", F.col("hit_at").alias("tocou_ns"), F.col("hit_p").alias("preco"))


@R.add(f"WITH {SQL_TAPE}, c AS (SELECT agente_comprador AS agente, symbol, dt, trade_id, ts_ns FROM tape WHERE agente_comprador > 0), v AS (SELECT DISTINCT agente_vendedor AS agente, dt, ts_ns FROM tape WHERE agente_vendedor > 0) SELECT symbol, dt, trade_id FROM c WHERE EXISTS (SELECT 1 FROM v WHERE v.agente = c.agente AND v.dt = c.dt AND v.ts_ns BETWEEN c.ts_ns - 2000000000 AND c.ts_ns + 2000000000)")
def c09_band_two_seconds(spark, d):
    """Buys of a broker that also sold (any symbol) within two seconds either way."""
    t = tape(spark, d)
    buys = t.where("agente_comprador > 0").select(F.col("agente_comprador").alias("agente"), "dt", "ts_ns", "symbol", "trade_id")
    sells = t.where("agente_vendedor > 0").select(F.col("agente_vendedor").alias("agente"), "dt", "ts_ns")
    return has_within(buys, sells, ["agente", "dt"], "ts_ns", 2_000_000_000).select("symbol", "dt", "trade_id")


@R.add(f"WITH {SQL_TAPE} SELECT symbol, dt, count(*) AS n, sum(quantidade)::bigint AS volume FROM tape WHERE abs(price - round(price / 5) * 5) <= 0.02 + 1e-9 GROUP BY ALL")
def c10_near_levels(spark, d):
    """Volume at prices near a multiple of 5: the nearest level is computed, not joined."""
    near = F.abs(F.col("price") - F.round(F.col("price") / 5) * 5) <= 0.02 + 1e-9
    return tape(spark, d).where(near).groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("n"), F.sum("quantidade").alias("volume"))


@R.add(f"WITH t AS (SELECT DISTINCT {SQL_SYMBOL} AS symbol, dt FROM trades), b AS (SELECT DISTINCT {SQL_SYMBOL} AS symbol, dt FROM book_offer) SELECT t.*, EXISTS (SELECT 1 FROM b WHERE b.symbol = t.symbol AND b.dt = t.dt) AS tem_livro FROM t")
def c11_semi_anti(spark, d):
    t, b = (table(spark, d, n, "symbol", "dt").distinct() for n in ("trades", "book_offer"))
    return t.join(b, ["symbol", "dt"], "left_semi").withColumn("tem_livro", F.lit(True)).unionByName(t.join(b, ["symbol", "dt"], "left_anti").withColumn("tem_livro", F.lit(False)))


@R.add(f"WITH {SQL_M1}, dia AS (SELECT symbol, dt, max(high) AS maxima, min(low) AS minima, arg_max(close, minuto) AS fecho, count(*) AS barras FROM m1 GROUP BY ALL) SELECT symbol, dt, lag(maxima) OVER w AS maxima_ontem, lag(minima) OVER w AS minima_ontem, lag(fecho) OVER w AS fecho_ontem, last_value(CASE WHEN barras >= 30 THEN dt END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ultimo_completo FROM dia WINDOW w AS (PARTITION BY symbol ORDER BY dt)")
def c13_previous_session(spark, d):
    day = m1(spark, d).groupBy("symbol", "dt").agg(F.max("high").alias("maxima"), F.min("low").alias("minima"), F.max_by("close", "minuto").alias("fecho"), F.count(F.lit(1)).alias("barras"))
    w = Window.partitionBy("symbol").orderBy("dt")
    complete = carried(F.when(F.col("barras") >= 30, F.col("dt")), w, strictly=True)
    return day.select("symbol", "dt", F.lag("maxima").over(w).alias("maxima_ontem"), F.lag("minima").over(w).alias("minima_ontem"), F.lag("fecho").over(w).alias("fecho_ontem"), complete.alias("ultimo_completo"))


@R.add(f"WITH {SQL_M1}, s AS (SELECT unnest([-1, 0, 1]) AS passo), a AS (SELECT s.passo, x.symbol, count(*) AS n, sum((abs(x.close - y.open) < 1e-9)::int) AS iguais FROM m1 x CROSS JOIN s JOIN m1 y ON y.symbol = x.symbol AND y.dt = x.dt AND y.minuto = x.minuto + s.passo GROUP BY ALL) SELECT symbol, arg_max(passo, {{'i': iguais, 'p': -abs(passo), 'q': passo}})::bigint AS passo, max(iguais)::bigint AS iguais FROM a GROUP BY symbol")
def c16_shift_alignment(spark, d):
    """The shift of −1, 0 or 1 minutes at which most closes agree with opens."""
    bars = m1(spark, d)
    probe = bars.select("symbol", "dt", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("passo"), "minuto", "close").withColumn("minuto", F.col("minuto") + F.col("passo"))
    hits = probe.join(bars.select("symbol", "dt", "minuto", "open"), ["symbol", "dt", "minuto"]).groupBy("symbol", "passo").agg(F.count_if(F.abs(F.col("close") - F.col("open")) < 1e-9).alias("iguais"))
    best = F.max_by("passo", F.struct("iguais", -F.abs("passo"), "passo"))
    return hits.groupBy("symbol").agg(best.cast("bigint").alias("passo"), F.max("iguais").alias("iguais"))


# ---- D: aggregates ---------------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_TAPE} SELECT symbol, dt, round(sum(price * quantidade) / sum(quantidade), 6) AS vwap, round(median(price), 6) AS mediana, round(quantile_cont(price, 0.9), 6) AS p90, count(DISTINCT agente_comprador) AS compradores FROM tape GROUP BY ALL")
def d03_vwap_percentiles(spark, d):
    vwap = F.sum(F.col("price") * F.col("quantidade")) / F.sum("quantidade")
    return tape(spark, d).groupBy("symbol", "dt").agg(r6(vwap).alias("vwap"), r6(F.median("price")).alias("mediana"), r6(F.percentile("price", F.lit(0.9))).alias("p90"), F.count_distinct("agente_comprador").alias("compradores"))


@R.add(f"WITH {SQL_TAPE}, l AS (SELECT symbol, dt, agente_comprador AS agente, quantidade AS q FROM tape WHERE trade_type IN (2, 3) UNION ALL SELECT symbol, dt, agente_vendedor, -quantidade FROM tape WHERE trade_type IN (2, 3)) SELECT symbol, dt, agente, sum(q)::bigint AS fluxo, sum(abs(q))::bigint AS dois_lados FROM l GROUP BY ALL")
def d04_broker_flow(spark, d):
    return broker_flow(tape(spark, d), ["symbol", "dt"])


@R.add(f"WITH {SQL_TAPE} SELECT symbol, round(quantile_cont(price, 0.5), 6) AS p50, round(quantile_cont(price, 0.99), 6) AS p99 FROM tape GROUP BY symbol")
def d07_histogram_percentile(spark, d):
    """Exact percentiles from a histogram of values: prices repeat, so the histogram is what is shuffled."""
    h = tape(spark, d).groupBy("symbol", "price").agg(F.count(F.lit(1)).alias("n"))
    return h.groupBy("symbol").agg(r6(F.percentile("price", F.lit(0.5), F.col("n"))).alias("p50"), r6(F.percentile("price", F.lit(0.99), F.col("n"))).alias("p99"))


@R.add(f"SELECT {SQL_SYMBOL} AS symbol, dt, count(*) AS linhas, count(*) - count(DISTINCT trade_id) AS repetidas FROM trades WHERE trade_id > 0 GROUP BY ALL")
def d09_duplicates(spark, d):
    t = table(spark, d, "trades", "symbol", "dt", "trade_id").where("trade_id > 0")
    return t.groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("linhas"), (F.count(F.lit(1)) - F.count_distinct("trade_id")).alias("repetidas"))


@R.add(f"WITH {SQL_TAPE}, e AS (SELECT symbol, quantile_cont(quantidade, [0.2, 0.4, 0.6, 0.8]) AS b FROM tape GROUP BY symbol) SELECT symbol, (1 + len(list_filter(list_distinct(b), lambda x: quantidade > x)))::bigint AS faixa, count(*) AS n FROM tape JOIN e USING (symbol) GROUP BY ALL")
def d10_quantile_bins(spark, d):
    """Quantile bins, closed on the right, repeated edges dropped."""
    t = tape(spark, d)
    edges = t.groupBy("symbol").agg(F.percentile("quantidade", F.array(*map(F.lit, (0.2, 0.4, 0.6, 0.8)))).alias("b"))
    bin_ = 1 + F.size(F.filter(F.array_distinct("b"), lambda x: F.col("quantidade") > x))
    return t.join(edges, "symbol").groupBy("symbol", bin_.cast("bigint").alias("faixa")).agg(F.count(F.lit(1)).alias("n"))


@R.add(f"WITH {SQL_TAPE} SELECT symbol, CASE WHEN quantidade <= 1 THEN '<=1' WHEN quantidade <= 10 THEN '<=10' WHEN quantidade <= 100 THEN '<=100' ELSE '>100' END AS faixa, count(*) AS n FROM tape GROUP BY ALL")
def d11_fixed_bins(spark, d):
    q = F.col("quantidade")
    return tape(spark, d).groupBy("symbol", F.when(q <= 1, "<=1").when(q <= 10, "<=10").when(q <= 100, "<=100").otherwise(">100").alias("faixa")).agg(F.count(F.lit(1)).alias("n"))


_BOTH_VARY = "count(*) >= 10 AND var_pop(volume) > 0 AND var_pop(high - low) > 1e-18"


@R.add(f"WITH {SQL_M1} SELECT symbol, CASE WHEN {_BOTH_VARY} THEN round(corr(volume, high - low), 5) + 0.0 END AS correlacao, CASE WHEN {_BOTH_VARY} THEN round(regr_slope(high - low, volume), 9) + 0.0 END AS inclinacao, CASE WHEN {_BOTH_VARY} THEN round(regr_r2(high - low, volume), 5) END AS r2 FROM m1 GROUP BY symbol")
def d12_correlation_ols(spark, d):
    """Correlation of range and volume, and the line through them, from one pass of mergeable moments."""
    y, x = F.col("high") - F.col("low"), F.col("volume").cast("double")
    usable = (F.count(F.lit(1)) >= 10) & (F.var_pop(x) > 0) & (F.var_pop(y) > 1e-18)
    r = correlation(x, y)
    return m1(spark, d).groupBy("symbol").agg(F.when(usable, r6(r, 5)).alias("correlacao"), F.when(usable, r6(F.try_divide(F.covar_pop(x, y), F.var_pop(x)), 9)).alias("inclinacao"), F.when(usable, r6(r * r, 5)).alias("r2"))


@R.add(f"WITH {SQL_M1}, r AS (SELECT symbol, close - lag(close) OVER (PARTITION BY symbol, dt ORDER BY minuto) AS r FROM m1) SELECT symbol, count(*) AS n, round(100.0 * count(*) FILTER (WHERE r > 0) / count(*), 6) AS acerto, round(sum(r) FILTER (WHERE r > 0), 4) AS ganho, round(sum(r) FILTER (WHERE r < 0), 4) AS perda, max(round(r, 6)) AS melhor, min(round(r, 6)) AS pior FROM r WHERE r IS NOT NULL GROUP BY symbol")
def d16_profit_stats(spark, d):
    rows = m1(spark, d).withColumn("r", F.col("close") - F.lag("close").over(in_minutes())).where("r is not null")
    return rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), r6(100.0 * F.count_if(F.col("r") > 0) / F.count(F.lit(1))).alias("acerto"), r6(F.sum(F.when(F.col("r") > 0, F.col("r"))), 4).alias("ganho"),
        r6(F.sum(F.when(F.col("r") < 0, F.col("r"))), 4).alias("perda"), F.max(r6("r")).alias("melhor"), F.min(r6("r")).alias("pior"),
    )


@R.add(f"WITH {SQL_TAPE} SELECT symbol, ts_ns // {MINUTE} AS minuto, count(*) AS n, sum(quantidade) FILTER (WHERE trade_type = 2)::bigint AS compra, sum(quantidade) FILTER (WHERE trade_type = 3)::bigint AS venda FROM tape GROUP BY ALL")
def d18_flow_by_minute(spark, d):
    """The batch form of the continuous one-minute aggregate."""
    q = lambda k: F.sum(F.when(F.col("trade_type") == k, F.col("quantidade")))
    return tape(spark, d).groupBy("symbol", F.expr(f"ts_ns div {MINUTE}").alias("minuto")).agg(F.count(F.lit(1)).alias("n"), q(2).alias("compra"), q(3).alias("venda"))


@R.add(f"WITH {SQL_TAPE}, s AS (SELECT symbol, quantidade, count(*) AS n FROM tape GROUP BY ALL) SELECT symbol, quantidade, n FROM s QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY n DESC, quantidade) <= 5")
def d19_modes(spark, d):
    """The five most frequent trade sizes of a symbol."""
    n = tape(spark, d).groupBy("symbol", "quantidade").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("_r", F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("n"), "quantidade"))).where("_r <= 5").drop("_r")


@R.add(f"WITH {SQL_TAPE}, h AS (SELECT symbol, dt, {SQL_HHMM} // 100 AS hora, sum(quantidade) AS v FROM tape GROUP BY ALL) SELECT symbol, hora, round(median(v), 6) AS mediana, count(*) AS dias FROM h GROUP BY ALL")
def d20_two_level(spark, d):
    """Volume per hour of each day, then the median over days."""
    h = tape(spark, d).groupBy("symbol", "dt", F.floor(local_hhmm(F.col("ts_ns")) / 100).alias("hora")).agg(F.sum("quantidade").alias("v"))
    return h.groupBy("symbol", "hora").agg(r6(F.median("v")).alias("mediana"), F.count(F.lit(1)).alias("dias"))


@R.add(f"WITH {SQL_TAPE}, b AS (SELECT symbol, dt, ts_ns // 300000000000 AS bloco, max(price) - min(price) AS faixa FROM tape GROUP BY ALL HAVING count(*) >= 2) SELECT symbol, round(median(faixa), 6) AS faixa_mediana, count(*) AS blocos FROM b GROUP BY symbol")
def d22_block_ranges(spark, d):
    b = tape(spark, d).groupBy("symbol", "dt", F.expr(f"ts_ns div {5 * MINUTE}").alias("bloco")).agg((F.max("price") - F.min("price")).alias("faixa"), F.count(F.lit(1)).alias("_n")).where("_n >= 2")
    return b.groupBy("symbol").agg(r6(F.median("faixa")).alias("faixa_mediana"), F.count(F.lit(1)).alias("blocos"))


@R.add(f"WITH {SQL_TAPE} SELECT symbol, dt, trade_type, count(*) AS n, sum(quantidade)::bigint AS volume FROM tape GROUP BY GROUPING SETS ((symbol, dt), (symbol, trade_type), (symbol), ())")
def d23_strata(spark, d):
    """All strata in one pass."""
    t = tape(spark, d)
    sets = [[F.col("symbol"), F.col("dt")], [F.col("symbol"), F.col("trade_type")], [F.col("symbol")], []]
    return t.groupingSets(sets, "symbol", "dt", "trade_type").agg(F.count(F.lit(1)).alias("n"), F.sum("quantidade").alias("volume"))


# ---- E: windows ------------------------------------------------------------------------------------------------------


def sql_z(x: str, by: str, rows: int, least: int) -> str:
    w = f"({by} ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({x}) OVER {w} >= {least} AND stddev_samp({x}) OVER {w} > 1e-12 THEN ({x} - avg({x}) OVER {w}) / stddev_samp({x}) OVER {w} END"


_M1W = "PARTITION BY symbol, dt ORDER BY minuto"


@R.add(f"WITH {SQL_M1} SELECT symbol, dt, minuto, round({sql_z('volume', _M1W, 20, 10)}, 5) AS z, round({sql_z('volume', _M1W, 20, 20)}, 5) AS z_cheio FROM m1")
def e01_strict_past_z(spark, d):
    return m1(spark, d).select("symbol", "dt", "minuto", r6(strict_past_z(F.col("volume").cast("double"), in_minutes(), 20), 5).alias("z"), r6(strict_past_z(F.col("volume").cast("double"), in_minutes(), 20, 20), 5).alias("z_cheio"))


@R.add(f"WITH {SQL_M1}, x AS (SELECT symbol, dt, minuto, CASE WHEN high > low THEN volume / (high - low) END AS esforco FROM m1), v AS (SELECT *, {sql_z('esforco', _M1W, 10, 10)} AS z FROM x WHERE esforco IS NOT NULL) SELECT symbol, dt, minuto, round(z, 4) + 0.0 AS z FROM v UNION ALL SELECT symbol, dt, minuto, NULL FROM x WHERE esforco IS NULL")
def e03_valid_only_z(spark, d):
    x = m1(spark, d).withColumn("esforco", F.when(F.col("high") > F.col("low"), F.col("volume") / (F.col("high") - F.col("low"))))
    return valid_only_z(x, ["symbol", "dt"], ["minuto"], "esforco", 10, "z").select("symbol", "dt", "minuto", r6("z", 4).alias("z"))


@R.add(f"WITH {SQL_TAPE} SELECT symbol, dt, trade_id, coalesce(sum(quantidade) OVER ({SQL_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS antes, row_number() OVER ({SQL_ORD}) AS ordem, row_number() OVER (PARTITION BY symbol, dt ORDER BY ts_ns DESC, ts_recv_ns DESC, trade_id DESC) AS do_fim FROM tape")
def e05_exclusive_cumulative(spark, d):
    sums = {"antes": F.col("quantidade"), "_i": F.lit(1)}
    rows = sliced_running_sum(tape_once(spark, d), ["symbol", "dt"], "ts_ns", SLICE_NS, TAPE_ORDER, sums)
    return rows.select("symbol", "dt", "trade_id", "antes", (F.col("_i") + 1).cast("bigint").alias("ordem"), (F.col("_i_all") - F.col("_i")).cast("bigint").alias("do_fim"))


@R.add(f"WITH {SQL_TAPE}, f AS (SELECT *, CASE WHEN lag(trade_type) OVER w IS DISTINCT FROM trade_type OR ts_ns - lag(ts_ns) OVER w > 30000000000 THEN 1 ELSE 0 END AS s FROM tape WINDOW w AS ({SQL_ORD})), g AS (SELECT *, sum(s) OVER ({SQL_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::bigint AS ilha FROM f) SELECT symbol, dt, ilha, min(trade_type) AS trade_type, count(*) AS n, max(ts_ns) - min(ts_ns) AS duracao FROM g GROUP BY ALL")
def e06_runs(spark, d):
    """Runs of one trade type without a gap above 30 s."""
    rows = with_previous(tape_once(spark, d), ["symbol", "dt"], "ts_ns", SLICE_NS, TAPE_ORDER, ["trade_type", "ts_ns"])
    starts = F.col("_prev").isNull() | (F.col("_prev.trade_type") != F.col("trade_type")) | (F.col("ts_ns") - F.col("_prev.ts_ns") > 30_000_000_000)
    runs = sliced_running_sum(rows.withColumn("_s", starts.cast("int")).drop("_prev"), ["symbol", "dt"], "ts_ns", SLICE_NS, TAPE_ORDER, {"ilha": F.col("_s")}, before=False)
    return runs.groupBy("symbol", "dt", "ilha").agg(F.min("trade_type").alias("trade_type"), F.count(F.lit(1)).alias("n"), (F.max("ts_ns") - F.min("ts_ns")).alias("duracao"))


@R.add(f"WITH {SQL_TAPE}, h AS (SELECT symbol, dt, {SQL_HHMM} // 100 AS hora, sum(quantidade)::double AS v FROM tape GROUP BY ALL) SELECT symbol, dt, hora, CASE WHEN count(v) OVER w >= 2 THEN round(quantile_cont(v, 0.5) OVER w, 6) END AS mediana FROM h WINDOW w AS (PARTITION BY symbol, hora ORDER BY dt ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)")
def e08_trailing_median(spark, d):
    """Median of up to three previous days in the same hour, at least two."""
    h = tape(spark, d).groupBy("symbol", "dt", F.floor(local_hhmm(F.col("ts_ns")) / 100).alias("hora")).agg(F.sum("quantidade").cast("double").alias("v"))
    w = Window.partitionBy("symbol", "hora").orderBy("dt").rowsBetween(-3, -1)
    return h.select("symbol", "dt", "hora", F.when(F.count("v").over(w) >= 2, r6(F.percentile("v", F.lit(0.5)).over(w))).alias("mediana"))


def sql_full(agg: str, x: str, by: str, a: str, b: str, n: int) -> str:
    w = f"({by} ROWS BETWEEN {a} AND {b})"
    return f"CASE WHEN count({x}) OVER {w} = {n} THEN {agg} OVER {w} END"


@R.add(f"WITH {SQL_M1} SELECT symbol, dt, minuto, round({sql_full('avg(close)', 'close', _M1W, '8 PRECEDING', 'CURRENT ROW', 9)}, 6) AS media, round({sql_full('stddev_pop(close)', 'close', _M1W, '8 PRECEDING', 'CURRENT ROW', 9)}, 5) AS desvio, {sql_full('max(high)', 'high', _M1W, '1 FOLLOWING', '5 FOLLOWING', 5)} AS maxima_5, {sql_full('min(low)', 'low', _M1W, '1 FOLLOWING', '5 FOLLOWING', 5)} AS minima_5, round(lead(close, 5) OVER ({_M1W}) / close - 1, 9) AS retorno_5 FROM m1")
def e09_rolling_and_forward(spark, d):
    """Rolling mean and deviation with the current row, forward extremes and return inside the day; NULL where truncated."""
    c = F.col("close")
    return m1(spark, d).select(
        "symbol", "dt", "minuto", r6(full_window(F.avg("close"), c, in_minutes(), -8, 0)).alias("media"), r6(full_window(F.stddev_pop("close"), c, in_minutes(), -8, 0), 5).alias("desvio"),
        full_window(F.max("high"), F.col("high"), in_minutes(), 1, 5).alias("maxima_5"), full_window(F.min("low"), F.col("low"), in_minutes(), 1, 5).alias("minima_5"), r6(F.lead("close", 5).over(in_minutes()) / c - 1, 9).alias("retorno_5"),
    )


@R.add(f"WITH {SQL_M1}, a AS (SELECT symbol, dt, minuto, close - open AS r, sum(close - open) OVER ({_M1W}) AS c FROM m1) SELECT symbol, dt, minuto, round(c, 5) + 0.0 AS acumulado, round(c - greatest(max(c) OVER ({_M1W}), 0.0), 5) + 0.0 AS queda FROM a")
def e12_drawdown(spark, d):
    rows = drawdown(m1(spark, d).withColumn("r", F.col("close") - F.col("open")), ["symbol", "dt"], ["minuto"], "r")
    return rows.select("symbol", "dt", "minuto", r6("acumulado", 5).alias("acumulado"), (r6("queda", 5) + 0.0).alias("queda"))


@R.add(f"WITH {SQL_TAPE}, c AS (SELECT *, round((price - first_value(price) OVER ({SQL_ORD})) * 100)::hugeint AS dev, first_value(price) OVER ({SQL_ORD}) AS p0 FROM tape), s AS (SELECT symbol, dt, trade_id, p0, sum(quantidade) OVER w AS qi, sum(quantidade * dev) OVER w AS qdi, sum(quantidade) OVER w::double AS q, sum(quantidade * dev) OVER w::double AS qd, sum(quantidade * dev * dev) OVER w::double AS qdd FROM c WINDOW w AS ({SQL_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT symbol, dt, trade_id, ((round(p0 * 100)::hugeint * qi + qdi) * 1000 // qi)::double / 100000 AS vwap, round(sqrt(greatest(qdd / q - (qd / q) * (qd / q), 0)) / 100, 4) AS desvio FROM s")
def e13_session_vwap(spark, d):
    """Running session VWAP and volume-weighted deviation, centred on the day's first price, in whole hundredths so that sums are exact."""
    t = tape_once(spark, d)
    opening = t.groupBy("symbol", "dt").agg(F.min_by("price", F.struct(*TAPE_ORDER)).alias("_p0"))
    rows = t.join(opening, ["symbol", "dt"]).withColumn("_d", F.round((F.col("price") - F.col("_p0")) * 100).cast("decimal(19,0)"))
    sums = {"_qi": F.col("quantidade").cast("decimal(19,0)"), "_qd": F.col("quantidade") * F.col("_d"), "_qdd": F.col("quantidade") * F.col("_d") * F.col("_d")}
    rows = sliced_running_sum(rows, ["symbol", "dt"], "ts_ns", SLICE_NS, TAPE_ORDER, sums, before=False)
    qi, qdi, qddi = (F.col(c) for c in sums)
    q, qd, qdd = (x.cast("double") for x in (qi, qdi, qddi))
    sd = F.sqrt(F.greatest(qdd / q - (qd / q) * (qd / q), F.lit(0.0))) / 100
    rows = rows.withColumns({"_n": ((F.round(F.col("_p0") * 100).cast("decimal(19,0)") * qi + qdi) * 1000).cast("decimal(38,0)"), "_q": qi, "_sd": sd})
    return rows.select("symbol", "dt", "trade_id", (F.expr("_n div _q").cast("double") / 100000).alias("vwap"), r6("_sd", 4).alias("desvio"))


@R.add(f"WITH {SQL_M1}, s AS (SELECT symbol, dt, minuto, CASE WHEN close > open THEN 1 WHEN close < open THEN -1 END AS lado FROM m1) SELECT symbol, dt, minuto, last_value(lado IGNORE NULLS) OVER ({_M1W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)::bigint AS lado_antes, coalesce(minuto = min(CASE WHEN lado = 1 THEN minuto END) OVER (PARTITION BY symbol, dt), false) AS primeira_alta FROM s")
def e14_carried_side(spark, d):
    """The last signed bar before this one, and whether this is the day's first rising bar."""
    side = F.when(F.col("close") > F.col("open"), 1).when(F.col("close") < F.col("open"), -1).cast("bigint")
    rows = m1(spark, d).withColumn("lado", side)
    first = F.min(F.when(F.col("lado") == 1, F.col("minuto"))).over(in_day())
    return rows.select("symbol", "dt", "minuto", carried(F.col("lado"), in_minutes(), strictly=True).alias("lado_antes"), F.coalesce(F.col("minuto") == first, F.lit(False)).alias("primeira_alta"))


@R.add(f"WITH {SQL_M1}, x AS (SELECT *, rank() OVER (PARTITION BY symbol, dt ORDER BY volume) + (count(*) OVER (PARTITION BY symbol, dt, volume) - 1) / 2.0 AS a, rank() OVER (PARTITION BY symbol, dt ORDER BY n_trades) + (count(*) OVER (PARTITION BY symbol, dt, n_trades) - 1) / 2.0 AS b FROM m1) SELECT symbol, dt, count(*) AS n, round(CASE WHEN count(*) >= 10 AND stddev_samp(a) > 0 AND stddev_samp(b) > 0 THEN corr(a, b) END, 6) AS spearman FROM x GROUP BY ALL")
def e16_spearman(spark, d):
    x = m1(spark, d).withColumns({"a": average_rank(F.col("volume"), ["symbol", "dt"]), "b": average_rank(F.col("n_trades"), ["symbol", "dt"])})
    usable = (F.count(F.lit(1)) >= 10) & (F.stddev_samp("a") > 0) & (F.stddev_samp("b") > 0)
    return x.groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("n"), r6(F.when(usable, correlation(F.col("a"), F.col("b")))).alias("spearman"))


@R.add(f"WITH {SQL_M1} SELECT symbol, dt, minuto, round(CASE WHEN stddev_samp(volume) OVER w > 1e-12 THEN (volume - avg(volume) OVER w) / stddev_samp(volume) OVER w END, 5) AS padrao FROM m1 WINDOW w AS (PARTITION BY symbol, minuto % 1440)")
def e18_time_of_day_score(spark, d):
    w = Window.partitionBy("symbol", F.pmod("minuto", F.lit(1440)))
    v, sd = F.col("volume").cast("double"), F.stddev_samp("volume").over(w)
    return m1(spark, d).select("symbol", "dt", "minuto", r6(F.when(sd > 1e-12, (v - F.avg(v).over(w)) / sd), 5).alias("padrao"))


@R.add(f"WITH {SQL_QUOTES}, s AS (SELECT symbol, ts_recv_ns, topo_id, last_value(preco_bid IGNORE NULLS) OVER w AS b, last_value(preco_ask IGNORE NULLS) OVER w AS a FROM quotes WINDOW w AS (PARTITION BY symbol, dia ORDER BY ts_recv_ns, topo_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT symbol, topo_id, nullif(b, 0) AS bid, nullif(a, 0) AS ask FROM s")
def e20_carried_sides(spark, d):
    """Each side of the book carried forward; a price of 0 clears it, so carrying comes before the zero turns NULL."""
    w = Window.partitionBy("symbol", "dia").orderBy("ts_recv_ns", "topo_id")
    return quotes(spark, d).select("symbol", "topo_id", F.nullif(carried(F.col("preco_bid"), w), F.lit(0.0)).alias("bid"), F.nullif(carried(F.col("preco_ask"), w), F.lit(0.0)).alias("ask"))


@R.add(f"WITH {SQL_M1}, i AS (SELECT *, minuto - row_number() OVER ({_M1W}) AS g FROM m1) SELECT symbol, dt, min(minuto) AS de, max(minuto) AS ate, count(*) AS minutos FROM i GROUP BY symbol, dt, g")
def e21_minute_islands(spark, d):
    rows = m1(spark, d).withColumn("_g", F.col("minuto") - F.row_number().over(in_minutes()))
    return rows.groupBy("symbol", "dt", "_g").agg(F.min("minuto").alias("de"), F.max("minuto").alias("ate"), F.count(F.lit(1)).alias("minutos")).drop("_g")


@R.add(f"WITH r AS (SELECT {SQL_SYMBOL} AS symbol, dt, ts_recv_ns, lead(ts_recv_ns) OVER (PARTITION BY {SQL_SYMBOL}, dt ORDER BY ts_recv_ns) AS prox FROM trades) SELECT symbol, dt, count(*) AS silencios, max(prox - ts_recv_ns) AS maior FROM r WHERE prox - ts_recv_ns >= 300000000000 GROUP BY ALL")
def e22_silences(spark, d):
    w = in_day().orderBy("ts_recv_ns")
    rows = table(spark, d, "trades", "symbol", "dt", "ts_recv_ns").withColumn("_g", F.lead("ts_recv_ns").over(w) - F.col("ts_recv_ns"))
    return rows.where(f"_g >= {5 * MINUTE}").groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("silencios"), F.max("_g").alias("maior"))


@R.add(f"WITH t AS (SELECT DISTINCT {SQL_SYMBOL} AS symbol, dt::date AS dia FROM trades), l AS (SELECT min(dia) AS a, max(dia) AS b FROM t), c AS (SELECT symbol, unnest(generate_series(l.a, l.b, INTERVAL 1 DAY))::date AS dia FROM (SELECT DISTINCT symbol FROM t), l), f AS (SELECT c.* FROM c WHERE dayofweek(dia) BETWEEN 1 AND 5 AND NOT EXISTS (SELECT 1 FROM t WHERE t.symbol = c.symbol AND t.dia = c.dia)) SELECT symbol, strftime(dia, '%Y-%m-%d') AS dt FROM f")
def e23_missing_weekdays(spark, d):
    """Weekdays of the data's span on which a symbol has no trade."""
    t = table(spark, d, "trades", "symbol", "dt").distinct().withColumn("dia", F.to_date("dt"))
    span = t.agg(F.min("dia").alias("a"), F.max("dia").alias("b"))
    calendar = span.select(F.explode(F.sequence("a", "b")).alias("dia")).where(F.dayofweek("dia").between(2, 6))
    wanted = t.select("symbol").distinct().crossJoin(F.broadcast(calendar))  # symbols × weekdays, the report's own size
    return wanted.join(t, ["symbol", "dia"], "left_anti").select("symbol", F.date_format("dia", "yyyy-MM-dd").alias("dt"))


# ---- F, G: order and sets --------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_TAPE}, l AS (SELECT symbol, agente_comprador AS agente, quantidade AS q FROM tape WHERE trade_type IN (2, 3) UNION ALL SELECT symbol, agente_vendedor, quantidade FROM tape WHERE trade_type IN (2, 3)), s AS (SELECT symbol, agente, sum(q)::bigint AS volume FROM l GROUP BY ALL) SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY volume DESC, agente) <= 5")
def f02_top_brokers(spark, d):
    """The five brokers of most two-sided volume, by symbol."""
    b = broker_flow(tape(spark, d), ["symbol"]).select("symbol", "agente", F.col("dois_lados").alias("volume"))
    return b.withColumn("_r", F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("volume"), "agente"))).where("_r <= 5").drop("_r")


@R.add(f"WITH {SQL_TAPE}, r AS (SELECT symbol, dt, quantidade, row_number() OVER (PARTITION BY symbol, dt ORDER BY quantidade DESC, trade_id) AS k FROM tape) SELECT symbol, dt, round(sum(quantidade) FILTER (WHERE k <= 5) / sum(quantidade), 6) AS concentracao FROM r GROUP BY ALL")
def f03_concentration(spark, d):
    t = tape_once(spark, d)
    largest = [F.desc("quantidade"), "trade_id"]
    piece = t.withColumn("_slice", F.expr(f"ts_ns div {SLICE_NS}"))  # five per slice first, so no task ranks a whole day
    five = piece.withColumn("_k", F.row_number().over(Window.partitionBy("symbol", "dt", "_slice").orderBy(*largest))).where("_k <= 5")
    five = five.withColumn("_k", F.row_number().over(in_day().orderBy(*largest))).where("_k <= 5").groupBy("symbol", "dt").agg(F.sum("quantidade").alias("cinco"))
    total = t.groupBy("symbol", "dt").agg(F.sum("quantidade").alias("total"))
    return five.join(total, ["symbol", "dt"]).select("symbol", "dt", r6(F.col("cinco") / F.col("total")).alias("concentracao"))


@R.add(f"WITH {SQL_M1}, a AS (SELECT symbol, dt, minuto, sum(close - open) OVER (PARTITION BY symbol ORDER BY minuto) AS c FROM m1), t AS (SELECT *, greatest(max(c) OVER (PARTITION BY symbol ORDER BY minuto), 0.0) AS topo FROM a), g AS (SELECT symbol, round(topo, 6) AS topo, min(round(c - topo, 5)) AS queda, count(*) AS barras FROM t GROUP BY symbol, round(topo, 6)) SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY queda, topo) <= 3")
def f04_worst_drawdowns(spark, d):
    """The three deepest falls between running maxima."""
    rows = drawdown(m1(spark, d).withColumn("r", F.col("close") - F.col("open")), ["symbol"], ["minuto"], "r")
    g = rows.groupBy("symbol", r6("topo").alias("topo")).agg(F.min(r6("queda", 5)).alias("queda"), F.count(F.lit(1)).alias("barras"))
    return g.withColumn("_r", F.row_number().over(Window.partitionBy("symbol").orderBy("queda", "topo"))).where("_r <= 3").drop("_r").withColumn("queda", F.col("queda") + 0.0)


@R.add(f"SELECT file_id, path, n_rows FROM capture_files QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY CASE WHEN path LIKE '%.parquet' THEN 0 ELSE 1 END, CASE WHEN n_rows IS NULL THEN 1 ELSE 0 END, scan_ts DESC, path) = 1")
def f07_preferred_listing(spark, d):
    """One listing per file: closed before others, known counts before unknown, the latest."""
    w = Window.partitionBy("file_id").orderBy(F.when(F.col("path").endswith(".parquet"), 0).otherwise(1), F.when(F.col("n_rows").isNull(), 1).otherwise(0), F.desc("scan_ts"), "path")
    return table(spark, d, "capture_files", "file_id", "path", "n_rows", "scan_ts").withColumn("_r", F.row_number().over(w)).where("_r = 1").select("file_id", "path", "n_rows")


@R.add(f"WITH t AS (SELECT DISTINCT {SQL_SYMBOL} AS symbol FROM trades), q AS (SELECT DISTINCT {SQL_SYMBOL} AS symbol FROM topo_livro), b AS (SELECT DISTINCT {SQL_SYMBOL} AS symbol FROM book_offer) SELECT symbol, 'todos' AS conjunto FROM ((SELECT * FROM t) INTERSECT (SELECT * FROM q) INTERSECT (SELECT * FROM b)) UNION ALL SELECT symbol, 'sem_livro' FROM (SELECT * FROM t EXCEPT SELECT * FROM b)")
def g03_set_operations(spark, d):
    t, q, b = (table(spark, d, n, "symbol") for n in ("trades", "topo_livro", "book_offer"))
    return t.intersect(q).intersect(b).withColumn("conjunto", F.lit("todos")).unionByName(t.distinct().exceptAll(b.distinct()).withColumn("conjunto", F.lit("sem_livro")))


@R.add(f"SELECT symbol, count(*) AS distintas FROM (SELECT DISTINCT {SQL_SYMBOL} AS symbol, preco_bid, qtd_bid, preco_ask, qtd_ask, ts_recv_ns FROM topo_livro) GROUP BY symbol")
def g05_distinct_quotes(spark, d):
    q = table(spark, d, "topo_livro").drop("topo_id").dropDuplicates()
    return q.groupBy("symbol").agg(F.count(F.lit(1)).alias("distintas"))


@R.add(f"WITH {SQL_TAPE}, l AS (SELECT DISTINCT dt, agente_comprador AS agente FROM tape), d AS (SELECT DISTINCT dt FROM tape), a AS (SELECT DISTINCT agente FROM l), v AS (SELECT dt, agente_comprador AS agente, sum(quantidade)::bigint AS v FROM tape GROUP BY ALL) SELECT d.dt, a.agente, coalesce(v.v, 0) AS volume FROM d CROSS JOIN a LEFT JOIN v ON v.dt = d.dt AND v.agente = a.agente")
def g06_aligned_brokers(spark, d):
    """Every broker on every day, absent ones with 0."""
    v = tape(spark, d).groupBy("dt", F.col("agente_comprador").alias("agente")).agg(F.sum("quantidade").alias("volume"))
    days = v.agg(F.collect_set("dt").alias("_d"))  # one row: the calendar
    grid = v.select("agente").distinct().crossJoin(F.broadcast(days)).select("agente", F.explode("_d").alias("dt"))
    return grid.join(v, ["agente", "dt"], "left").select("dt", "agente", F.coalesce("volume", F.lit(0)).alias("volume"))


# ---- H: scalar functions ---------------------------------------------------------------------------------------------


@R.add(f"SELECT symbol, CASE WHEN regexp_matches(symbol, 'FUT$') THEN 'futuro' WHEN regexp_matches(symbol, '^[A-Z]{{4}}(34|35)$') THEN 'bdr' WHEN regexp_matches(symbol, '^[A-Z]{{4}}11$') THEN 'unit_etf' WHEN regexp_matches(symbol, '^[A-Z]{{4}}[3-8]$') THEN 'acao' WHEN regexp_matches(symbol, '^[A-Z]{{3}}[FGHJKMNQUVXZ][0-9]{{2}}$') THEN 'vencimento' ELSE 'outro' END AS familia FROM (SELECT DISTINCT {SQL_SYMBOL} AS symbol FROM ativos)")
def h04_ticker_family(spark, d):
    return table(spark, d, "ativos", "symbol").distinct().select("symbol", ticker_family(F.col("symbol")).alias("familia"))


@R.add(f"WITH {SQL_QUOTES} SELECT topo_id, round(CASE WHEN preco_bid > 0 AND preco_ask > 0 AND qtd_bid + qtd_ask > 0 THEN (preco_ask * qtd_bid + preco_bid * qtd_ask) / (qtd_bid + qtd_ask) END, 6) AS micro, round(CASE WHEN preco_bid > 0 AND preco_ask > 0 THEN greatest(0.01, floor((preco_ask - preco_bid) / 0.01 + 0.5) * 0.01) END, 6) AS passo FROM quotes")
def h15_microprice(spark, d):
    b, a = F.col("preco_bid"), F.col("preco_ask")
    two = (b > 0) & (a > 0)
    return quotes(spark, d).select("topo_id", r6(microprice(b, F.col("qtd_bid"), a, F.col("qtd_ask"))).alias("micro"), r6(F.when(two, half_up_tick(a - b, 0.01))).alias("passo"))


@R.add(f"WITH {SQL_M1}, s AS (SELECT symbol, count(*) AS n, count(*) FILTER (WHERE close > open) AS k FROM m1 GROUP BY symbol) SELECT symbol, round((k / n + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt((k / n) * (1 - k / n) / n + 1.96 * 1.96 / (4.0 * n * n))) / (1 + 1.96 * 1.96 / n), 6) AS de, round((k / n + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt((k / n) * (1 - k / n) / n + 1.96 * 1.96 / (4.0 * n * n))) / (1 + 1.96 * 1.96 / n), 6) AS ate FROM s")
def h14_wilson(spark, d):
    s = m1(spark, d).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("close") > F.col("open")).alias("k"))
    low, high = wilson(F.col("k"), F.col("n"))
    return s.select("symbol", r6(low).alias("de"), r6(high).alias("ate"))


@R.add(f"WITH {SQL_TAPE}, v AS (SELECT symbol, sum(quantidade) AS v FROM tape GROUP BY symbol) SELECT symbol, greatest(floor(round_even(v / pow(10, floor(log10(v)) - 1), 0) * pow(10, floor(log10(v)) - 1) + 1e-9), 1)::bigint AS arredondado FROM v")
def h12_two_digits(spark, d):
    return tape(spark, d).groupBy("symbol").agg(F.sum("quantidade").cast("double").alias("v")).select("symbol", two_digits(F.col("v")).alias("arredondado"))


_CLOCK = r"^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
_DATE = f"""CASE WHEN regexp_matches(data, '{_CLOCK}') THEN coalesce(epoch_us(try_strptime(substr(data, 1, 19), '%d/%m/%Y %H:%M:%S')) + rpad(substr(data, 21), 6, '0')::bigint, 0) ELSE 0 END"""


@R.add(f"WITH p AS (SELECT ev_id, CASE WHEN length(data) > 20 THEN data ELSE data || '.0' END AS data FROM evento_ordem) SELECT ev_id, {_DATE} AS local_us, CASE WHEN {_DATE} > 0 THEN {_DATE} + 10800000000 ELSE 0 END AS utc_us FROM p")
def h06_local_date(spark, d):
    """Dates ``DD/MM/YYYY HH:MM:SS[.mmm]`` at the fixed offset to UTC microseconds; 0 where they don't parse."""
    text = F.when(F.col("data").rlike(_CLOCK), F.substring("data", 1, 19))
    part = F.rpad(F.regexp_extract("data", r"\.([0-9]{1,6})$", 1), 6, "0").cast("bigint")
    us = F.coalesce(F.unix_micros(F.try_to_timestamp(text, F.lit("dd/MM/yyyy HH:mm:ss"))) + part, F.lit(0))
    return table(spark, d, "evento_ordem", "ev_id", "data").withColumn("local_us", us).select("ev_id", "local_us", F.when(F.col("local_us") > 0, F.col("local_us") + 10_800_000_000).otherwise(0).alias("utc_us"))


QUERIES, ORACLES = R.queries, R.sql
