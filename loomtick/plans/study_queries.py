"""Event studies, fills, inference and descriptive queries (the rest of the inventory's groups D to P)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import minimum_effect
from ..operators import bars as B
from ..operators.asof import asof_backward, first_hit, range_join
from ..operators.fold import greedy_keep
from ..operators.indicators import bollinger, stochastic
from ..operators.labels import excursions
from ..operators.resample import matched_control, permuted, persistence, random_walk_tape, sign_flip_test
from ..operators.stats import information_coefficient
from ..operators.tape import aggressor_sign, is_aggressor
from ..operators.windows import carried, correlation, full_window, strict_past_z
from ..sources.tables import table
from .registry import SQL_SYMBOL, SQL_TAPE, Registry, r6, tape, tape_once
from .research_queries import _M5, SQL_FLOW, by_bar, flow, iceberg_runs, resolved
from .tape_queries import _BIG, _M1W, _P, MINUTE, SQL_HHMM, SQL_M1, SQL_ORD, big_buys, in_day, in_minutes, in_order, m1, sql_full, sql_z

R = Registry()
_ORD = "{'a': ts_ns, 'b': ts_recv_ns, 'c': trade_id}"
_DAYW = "PARTITION BY symbol ORDER BY dt"


def by_day() -> Window:
    return Window.partitionBy("symbol").orderBy("dt")


SQL_DIA = f"{SQL_M1}, dia AS (SELECT symbol, dt, arg_min(open, minuto) AS o, max(high) AS h, min(low) AS l, arg_max(close, minuto) AS c, sum(volume)::bigint AS v, count(*) AS n, min(minuto) AS m0 FROM m1 GROUP BY ALL)"


def days(spark: SparkSession, d: str) -> DataFrame:
    """One row per symbol and day over its one-minute bars."""
    return m1(spark, d).groupBy("symbol", "dt").agg(F.min_by("open", "minuto").alias("o"), F.max("high").alias("h"), F.min("low").alias("l"), F.max_by("close", "minuto").alias("c"), F.sum("volume").alias("v"), F.count(F.lit(1)).alias("n"), F.min("minuto").alias("m0"))


# ---- D, F, G, H ------------------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_M1}, x AS (SELECT symbol, dt, volume::double AS a, lag(volume) OVER ({_M1W})::double AS b FROM m1) SELECT symbol, count(*) AS n, round(CASE WHEN var_pop(a) > 1e-12 AND var_pop(b) > 1e-12 THEN corr(a, b) END, 4) + 0.0 AS correlacao FROM x WHERE b IS NOT NULL GROUP BY symbol")
def d13_mergeable_correlation(spark, d):
    """Six sums per symbol and day, added over days, then one formula: what partial aggregation does across partitions."""
    x = m1(spark, d).withColumns({"a": F.col("volume").cast("double"), "b": F.lag("volume").over(in_minutes()).cast("double")}).where("b is not null")
    a, b = F.col("a"), F.col("b")
    day = x.groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("n"), *(F.sum(e).alias(k) for k, e in {"sa": a, "sb": b, "saa": a * a, "sbb": b * b, "sab": a * b}.items()))
    s = day.groupBy("symbol").agg(*(F.sum(k).alias(k) for k in ("n", "sa", "sb", "saa", "sbb", "sab")))
    n = F.col("n")
    cov, va, vb = F.col("sab") / n - F.col("sa") * F.col("sb") / n / n, F.col("saa") / n - F.col("sa") * F.col("sa") / n / n, F.col("sbb") / n - F.col("sb") * F.col("sb") / n / n
    return s.select("symbol", "n", r6(F.when((va > 1e-12) & (vb > 1e-12), cov / F.sqrt(va * vb)), 4).alias("correlacao"))


@R.add(f"WITH {SQL_M1}, k AS (SELECT unnest([1, 2, 5, 10, 20]) AS minimo), n AS (SELECT symbol, minimo, count(*) FILTER (WHERE n_trades >= minimo) AS n FROM m1, k GROUP BY ALL) SELECT symbol, max(minimo)::bigint AS minimo FROM n WHERE n >= 30 GROUP BY symbol")
def f06_most_restrictive(spark, d):
    """Of nested variants the most restrictive that still leaves 30 bars."""
    k = F.array(*map(F.lit, (1, 2, 5, 10, 20)))
    n = m1(spark, d).select("symbol", "n_trades", F.explode(k).alias("minimo")).where("n_trades >= minimo").groupBy("symbol", "minimo").agg(F.count(F.lit(1)).alias("n"))
    return n.where("n >= 30").groupBy("symbol").agg(F.max("minimo").cast("bigint").alias("minimo"))


@R.add(f"SELECT fluxo, count(*) AS n, count(price) AS com_preco, count(trade_id) AS com_id, count(seq) AS com_seq FROM (SELECT 'trades' AS fluxo, price, trade_id, NULL::bigint AS seq FROM trades UNION ALL SELECT 'book_offer', price, NULL, seq FROM book_offer) GROUP BY fluxo")
def g02_permissive_union(spark, d):
    t, b = table(spark, d, "trades", "price", "trade_id"), table(spark, d, "book_offer", "price", "seq")
    both = t.withColumn("fluxo", F.lit("trades")).unionByName(b.withColumn("fluxo", F.lit("book_offer")), allowMissingColumns=True)
    return both.groupBy("fluxo").agg(F.count(F.lit(1)).alias("n"), F.count("price").alias("com_preco"), F.count("trade_id").alias("com_id"), F.count("seq").alias("com_seq"))


@R.add(f"WITH t AS (SELECT {SQL_SYMBOL} AS symbol, list(DISTINCT dt) AS a FROM trades GROUP BY ALL), b AS (SELECT {SQL_SYMBOL} AS symbol, list(DISTINCT dt) AS a FROM book_offer GROUP BY ALL) SELECT t.symbol, len(list_intersect(t.a, b.a))::bigint AS dias_comuns FROM t JOIN b USING (symbol)")
def g07_common_days(spark, d):
    day = lambda name, out: table(spark, d, name, "symbol", "dt").groupBy("symbol").agg(F.collect_set("dt").alias(out))
    both = day("trades", "a").join(day("book_offer", "b"), "symbol")
    return both.select("symbol", F.size(F.array_intersect("a", "b")).cast("bigint").alias("dias_comuns"))


@R.add(f"WITH {SQL_M1}, r AS (SELECT symbol, close - lag(close) OVER ({_M1W}) AS r FROM m1) SELECT symbol, count(r) AS n, round(1.96 * stddev_samp(r) / sqrt(count(r)), 6) AS efeito_minimo, round(avg(r) / nullif(stddev_samp(r) / sqrt(count(r)), 0), 4) + 0.0 AS t FROM r GROUP BY symbol HAVING count(r) >= 10")
def h16_minimum_effect(spark, d):
    """The smallest mean move the sample could show, and the mean's t."""
    r = m1(spark, d).select("symbol", (F.col("close") - F.lag("close").over(in_minutes())).alias("r"))
    s = r.groupBy("symbol").agg(F.count("r").alias("n"), F.stddev_samp("r").alias("sd"), F.avg("r").alias("m")).where("n >= 10")
    return s.select("symbol", "n", r6(minimum_effect(F.col("sd"), F.col("n"))).alias("efeito_minimo"), r6(F.try_divide(F.col("m"), F.col("sd") / F.sqrt("n")), 4).alias("t"))


@R.add(f"WITH {SQL_TAPE}, p AS (SELECT DISTINCT symbol, round(price, 4) AS price FROM tape), s AS (SELECT symbol, lead(price) OVER (PARTITION BY symbol ORDER BY price) - price AS passo FROM p) SELECT symbol, round(min(passo), 4) AS menor, round(median(passo), 4) AS mediano, count(*) AS niveis FROM s GROUP BY symbol")
def h17_price_grid(spark, d):
    """The steps between the distinct prices of a symbol."""
    p = tape(spark, d).select("symbol", F.round("price", 4).alias("price")).distinct()
    s = p.withColumn("passo", F.lead("price").over(Window.partitionBy("symbol").orderBy("price")) - F.col("price"))
    return s.groupBy("symbol").agg(r6(F.min("passo"), 4).alias("menor"), r6(F.median("passo"), 4).alias("mediano"), F.count(F.lit(1)).alias("niveis"))


@R.add(f"WITH {SQL_DIA}, l AS (SELECT symbol, list(c ORDER BY dt) AS x FROM dia GROUP BY symbol) SELECT symbol, round(coalesce(list_sum(list_transform(range(1, len(x)), lambda i: (x[i] + x[i + 1]) / 2)), 0), 6) AS soma_meios, len(x)::bigint AS n FROM l")
def h19_midpoints(spark, d):
    """Midpoints of consecutive daily closes, by array functions."""
    l = days(spark, d).groupBy("symbol").agg(F.transform(F.array_sort(F.collect_list(F.struct("dt", "c"))), lambda s: s["c"]).alias("x"))
    mid = F.zip_with(F.slice("x", F.lit(1), F.size("x") - 1), F.slice("x", F.lit(2), F.greatest(F.size("x") - 1, F.lit(0))), lambda a, b: (a + b) / 2)
    return l.select("symbol", r6(F.aggregate(mid, F.lit(0.0), lambda a, x: a + x)).alias("soma_meios"), F.size("x").cast("bigint").alias("n"))


# ---- I, J, K ---------------------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_M1}, g AS (SELECT symbol, dt, unnest(range(min(minuto), max(minuto) + 1)) AS minuto FROM m1 GROUP BY symbol, dt), f AS (SELECT g.symbol, g.dt, g.minuto, last_value(close IGNORE NULLS) OVER (PARTITION BY g.symbol, g.dt ORDER BY g.minuto) AS preco FROM g LEFT JOIN m1 USING (symbol, dt, minuto)) SELECT symbol, dt, minuto, preco, round(preco - lag(preco) OVER ({_M1W}), 6) + 0.0 AS diferenca FROM f")
def i09_filled_grid(spark, d):
    """A minute grid with the last price carried forward, and its differences."""
    bars = m1(spark, d)
    nxt = F.lead("minuto").over(in_minutes())
    filled = bars.withColumn("_ate", F.coalesce(nxt - 1, F.col("minuto"))).withColumn("minuto2", F.explode(F.sequence("minuto", "_ate"))).select("symbol", "dt", F.col("minuto2").alias("minuto"), F.col("close").alias("preco"))
    return filled.withColumn("diferenca", r6(F.col("preco") - F.lag("preco").over(in_minutes())))


@R.add(f"WITH {SQL_M1}, x AS (SELECT *, CASE WHEN high > low THEN (close - open) / (high - low) ELSE 0.0 END AS des FROM m1), s AS (SELECT symbol, dt, ts_ns // {MINUTE} AS minuto, (sum(CASE WHEN trade_type = 2 THEN quantidade ELSE -quantidade END) / sum(quantidade)) AS imb FROM tape WHERE trade_type IN (2, 3) GROUP BY ALL), y AS (SELECT x.symbol, x.dt, x.minuto, greatest(imb, 0) * (1 - des) AS comp, greatest(-imb, 0) * (1 + des) AS vend FROM x JOIN s USING (symbol, dt, minuto)) SELECT symbol, dt, minuto, round(comp, 6) + 0.0 AS absorcao_comp, round(vend, 6) + 0.0 AS absorcao_vend, round({sql_z('comp', _M1W, 15, 15)}, 4) + 0.0 AS z_comp FROM y")
def j09_one_sided_absorption(spark, d):
    """Aggression of one side that the bar's displacement doesn't follow."""
    rows = tape(spark, d).withColumn("minuto", F.expr(f"ts_ns div {MINUTE}")).where(is_aggressor(F.col("trade_type")))
    imb = rows.groupBy("symbol", "dt", "minuto").agg((F.sum(aggressor_sign(F.col("trade_type")) * F.col("quantidade")) / F.sum("quantidade")).alias("imb"))
    b = B.ohlc(rows, ["symbol", "dt", "minuto"]).join(imb, ["symbol", "dt", "minuto"])
    des = F.when(F.col("high") > F.col("low"), (F.col("close") - F.col("open")) / (F.col("high") - F.col("low"))).otherwise(0.0)
    b = b.withColumns({"comp": F.greatest(F.col("imb"), F.lit(0)) * (1 - des), "vend": F.greatest(-F.col("imb"), F.lit(0)) * (1 + des)})
    return b.select("symbol", "dt", "minuto", r6("comp").alias("absorcao_comp"), r6("vend").alias("absorcao_vend"), r6(strict_past_z(F.col("comp"), in_minutes(), 15, 15), 4).alias("z_comp"))


@R.add(f"WITH {SQL_FLOW}, u AS (SELECT symbol, bar_id, round(imbalance, 9) AS imbalance, round(tick_imbalance, 9) AS tick_imbalance, round(rlp_frac, 9) AS rlp_frac FROM flow), p AS (SELECT symbol, 'imbalance' AS a, 'tick_imbalance' AS b, imbalance AS x, tick_imbalance AS y FROM u UNION ALL SELECT symbol, 'imbalance', 'rlp_frac', imbalance, rlp_frac FROM u UNION ALL SELECT symbol, 'rlp_frac', 'tick_imbalance', rlp_frac, tick_imbalance FROM u) SELECT symbol, a, b, count(*) AS n, round(CASE WHEN var_pop(x) > 1e-12 AND var_pop(y) > 1e-12 THEN corr(x, y) END, 5) + 0.0 AS correlacao, coalesce(CASE WHEN var_pop(x) > 1e-12 AND var_pop(y) > 1e-12 THEN abs(corr(x, y)) >= 0.95 END, false) AS redundante FROM p GROUP BY ALL")
def j16_feature_triage(spark, d):
    """Correlation of each pair of features by symbol; at least 0.95 is redundant."""
    names = ["imbalance", "rlp_frac", "tick_imbalance"]
    f = flow(spark, d).select("symbol", *(F.round(c, 9).alias(c) for c in names))
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y")) for i, a in enumerate(names) for b in names[i + 1 :]]
    long = f.select("symbol", F.explode(F.array(*pairs)).alias("p")).select("symbol", "p.*")
    r = F.when((F.var_pop("x") > 1e-12) & (F.var_pop("y") > 1e-12), correlation(F.col("x"), F.col("y")))
    s = long.groupBy("symbol", "a", "b").agg(F.count(F.lit(1)).alias("n"), r.alias("r"))
    return s.select("symbol", "a", "b", "n", r6("r", 5).alias("correlacao"), F.coalesce(F.abs("r") >= 0.95, F.lit(False)).alias("redundante"))


@R.add(f"""WITH {SQL_M1}, six AS (SELECT symbol, dt, minuto // 6 AS k, max(high) AS high, min(low) AS low, arg_max(close, minuto) AS close, (minuto // 6) * 6 + 6 AS fim FROM m1 GROUP BY symbol, dt, minuto // 6),
st AS (SELECT symbol, dt, fim, round(CASE WHEN count(high) OVER w = 14 AND max(high) OVER w > min(low) OVER w THEN 100.0 * (close - min(low) OVER w) / (max(high) OVER w - min(low) OVER w) END, 5) AS k6 FROM six WINDOW w AS (PARTITION BY symbol, dt ORDER BY k ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT m.symbol, m.dt, m.minuto, st.k6 AS estocastico_6m FROM m1 m ASOF LEFT JOIN st ON m.symbol = st.symbol AND m.dt = st.dt AND m.minuto >= st.fim""")
def k06_context_stochastic(spark, d):
    """The stochastic of the last *closed* 6-minute bar, as-of each minute."""
    bars = m1(spark, d)
    six = bars.groupBy("symbol", "dt", F.expr("minuto div 6").alias("k")).agg(F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "minuto").alias("close"))
    w = in_day().orderBy("k")
    ctx = six.select("symbol", "dt", (F.col("k") * 6 + 6).alias("minuto"), r6(stochastic(F.col("high"), F.col("low"), F.col("close"), w), 5).alias("estocastico_6m"))
    return asof_backward(bars.select("symbol", "dt", "minuto"), ctx, ["symbol", "dt"], "minuto", ["estocastico_6m"])


@R.add(f"WITH {SQL_M1}, v AS (SELECT symbol, dt, minuto, {sql_full('avg(close)', 'close', _M1W, '8 PRECEDING', 'CURRENT ROW', 9)} AS alvo, {sql_full('avg(close)', 'close', _M1W, '7 PRECEDING', 'CURRENT ROW', 8)} AS a, {sql_full('avg(open)', 'open', _M1W, '8 PRECEDING', 'CURRENT ROW', 9)} AS b, {sql_full('avg((high + low) / 2)', 'high', _M1W, '8 PRECEDING', 'CURRENT ROW', 9)} AS c FROM m1), e AS (SELECT symbol, variante, max(round(abs(x - alvo), 6)) AS erro FROM (SELECT symbol, alvo, 'oito' AS variante, a AS x FROM v UNION ALL SELECT symbol, alvo, 'abertura', b FROM v UNION ALL SELECT symbol, alvo, 'meio', c FROM v) WHERE x IS NOT NULL AND alvo IS NOT NULL GROUP BY ALL) SELECT symbol, arg_min(variante, {{'e': erro, 'v': variante}}) AS variante, min(erro) AS erro FROM e GROUP BY symbol")
def k07_closest_variant(spark, d):
    """Of several formulas of an indicator the one whose worst error is least."""
    c, o, h = F.col("close"), F.col("open"), (F.col("high") + F.col("low")) / 2
    mean = lambda x, n: full_window(F.avg(x), x, in_minutes(), 1 - n, 0)
    v = m1(spark, d).select("symbol", mean(c, 9).alias("alvo"), mean(c, 8).alias("oito"), mean(o, 9).alias("abertura"), mean(h, 9).alias("meio"))
    e = v.unpivot(["symbol", "alvo"], ["oito", "abertura", "meio"], "variante", "x").where("x is not null and alvo is not null")
    e = e.groupBy("symbol", "variante").agg(F.max(F.round(F.abs(F.col("x") - F.col("alvo")), 6)).alias("erro"))
    return e.groupBy("symbol").agg(F.min_by("variante", F.struct("erro", "variante")).alias("variante"), F.min("erro").alias("erro"))


# ---- L: event studies ------------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_TAPE}, {_BIG}, p AS (SELECT symbol, dt, ts_ns, max({{'a': ts_recv_ns, 'b': trade_id, 'p': price}}) AS w FROM tape GROUP BY ALL), h AS (SELECT e.*, hz, e.ts_ns + hz::bigint * 1000000000 AS alvo FROM ev e, (SELECT unnest([30, 120, 300]) AS hz)) SELECT h.symbol, h.dt, h.trade_id, hz::bigint AS horizonte_s, round(p.w['p'] - h.price, 6) AS movimento FROM h ASOF JOIN p ON h.symbol = p.symbol AND h.dt = p.dt AND h.alvo >= p.ts_ns")
def l03_event_outcomes(spark, d):
    """The price's move 30, 120 and 300 s after a large buy, as-of each horizon."""
    t = tape_once(spark, d)
    e = big_buys(t).withColumn("horizonte_s", F.explode(F.array(*(F.lit(h).cast("bigint") for h in (30, 120, 300))))).withColumn("ts_ns", F.col("ts_ns") + F.col("horizonte_s") * 1_000_000_000)
    path = t.select("symbol", "dt", "ts_ns", "ts_recv_ns", F.col("trade_id").alias("_id"), F.col("price").alias("depois"))
    out = asof_backward(e, path, ["symbol", "dt"], "ts_ns", ["depois"], tie=["ts_recv_ns", "_id"], slice_size=B.SLICE_NS)
    return out.select("symbol", "dt", "trade_id", "horizonte_s", r6(F.col("depois") - F.col("price")).alias("movimento"))


@R.add(f"WITH {SQL_M1}, top AS (SELECT symbol FROM m1 GROUP BY symbol ORDER BY count(*) DESC, symbol LIMIT 1), l AS (SELECT dt, minuto, sign(close / open - 1) AS lado FROM m1 JOIN top USING (symbol) WHERE abs(close / open - 1) >= 0.0002), e AS (SELECT m.symbol, l.dt, l.minuto, l.lado * (m.close / m.open - 1) AS junto, l.lado * (n.close / n.open - 1) AS depois FROM l JOIN m1 m ON m.dt = l.dt AND m.minuto = l.minuto AND m.symbol NOT IN (SELECT symbol FROM top) LEFT JOIN m1 n ON n.dt = l.dt AND n.minuto = l.minuto + 1 AND n.symbol = m.symbol) SELECT symbol, count(*) AS eventos, round(avg(junto), 8) + 0.0 AS junto, count(depois) AS seguidos, round(avg(depois), 8) + 0.0 AS depois FROM e GROUP BY symbol")
def l05_leader_events(spark, d):
    """What the others do in and after a minute in which the most traded symbol moves by at least 0.02 %."""
    bars = m1(spark, d)
    top = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "symbol").limit(1).select("symbol")
    move = F.col("close") / F.col("open") - 1
    lead = bars.join(top, "symbol", "left_semi").where(F.abs(move) >= 0.0002).select("dt", "minuto", F.signum(move).alias("lado"))
    rest = bars.join(top, "symbol", "left_anti").select("symbol", "dt", "minuto", move.alias("r"))
    nxt = rest.select("symbol", "dt", (F.col("minuto") - 1).alias("minuto"), F.col("r").alias("r1"))
    e = rest.join(lead, ["dt", "minuto"]).join(nxt, ["symbol", "dt", "minuto"], "left")
    return e.groupBy("symbol").agg(F.count(F.lit(1)).alias("eventos"), r6(F.avg(F.col("lado") * F.col("r")), 8).alias("junto"), F.count("r1").alias("seguidos"), r6(F.avg(F.col("lado") * F.col("r1")), 8).alias("depois"))


_MS = 1_000_000
_LEAD = {"ticks": 2, "window_ms": 500, "horizons_ms": (250, 500, 1000, 5000, 30000), "rest_ms": 2000}
_LAGS = [-_LEAD["window_ms"], 0, *_LEAD["horizons_ms"]]


@R.add(f"""WITH RECURSIVE {SQL_TAPE}, {_P}, tk AS (SELECT {SQL_SYMBOL} AS symbol, tick FROM ativos), top AS (SELECT symbol FROM tape GROUP BY symbol ORDER BY count(*) DESC, symbol LIMIT 1),
c AS (SELECT symbol, dt, ts_ns, price, tick, ts_ns - {_LEAD['window_ms'] * _MS} AS antes FROM tape JOIN top USING (symbol) JOIN tk USING (symbol)),
e AS (SELECT DISTINCT c.dt, c.ts_ns, sign(c.price - p.w['p'])::bigint AS lado FROM c ASOF JOIN p ON c.symbol = p.symbol AND c.dt = p.dt AND c.antes >= p.ts_ns WHERE abs(c.price - p.w['p']) >= {_LEAD['ticks']} * tick - 1e-9),
r AS (SELECT dt, lado, min(ts_ns) AS ts_ns FROM e GROUP BY ALL UNION ALL SELECT r.dt, r.lado, min(e.ts_ns) FROM r JOIN e ON e.dt = r.dt AND e.lado = r.lado AND e.ts_ns >= r.ts_ns + {_LEAD['rest_ms'] * _MS} GROUP BY r.dt, r.lado),
f AS (SELECT DISTINCT symbol, dt FROM tape WHERE symbol NOT IN (SELECT symbol FROM top)),
a AS (SELECT f.symbol, f.dt, r.lado, r.ts_ns, ms, r.ts_ns + ms::bigint * {_MS} AS alvo FROM f JOIN r ON r.dt = f.dt, (SELECT unnest({_LAGS}) AS ms)),
v AS (SELECT a.symbol, a.dt, a.lado, a.ts_ns, a.ms, p.w['p'] AS preco FROM a ASOF JOIN p ON a.symbol = p.symbol AND a.dt = p.dt AND a.alvo >= p.ts_ns),
b AS (SELECT symbol, dt, lado, ts_ns, max(preco) FILTER (WHERE ms = 0) AS agora, round((max(preco) FILTER (WHERE ms = 0) - max(preco) FILTER (WHERE ms < 0)) * lado * 1e6)::bigint AS pre FROM v GROUP BY symbol, dt, lado, ts_ns HAVING count(*) FILTER (WHERE ms < 0) > 0),
m AS (SELECT b.symbol, v.ms, pre, round((preco - agora) * b.lado * 1e6)::bigint AS pos, coalesce(abs(pre) < tick * 1e6 - 1e-3, false) AS parado FROM b JOIN v USING (symbol, dt, lado, ts_ns) LEFT JOIN tk ON tk.symbol = b.symbol WHERE v.ms > 0),
s AS (SELECT 'todos' AS subconjunto, * FROM m UNION ALL SELECT 'parado', * FROM m WHERE parado)
SELECT symbol, subconjunto, ms::bigint AS horizonte_ms, count(*) AS n, sum(pre)::bigint / 1e6 / count(*) AS pre_media, sum(pos)::bigint / 1e6 / count(*) AS media, 100.0::double * count(*) FILTER (WHERE pos > 0) / count(*) AS pct_a_favor, 100.0::double * count(*) FILTER (WHERE pos < 0) / count(*) AS pct_contra FROM s GROUP BY ALL""")
def l05b_leader_trade_events(spark, d):
    """Moves of the most traded symbol by two ticks within 500 ms, resting two seconds a side: how far each other symbol had gone
    the same way before and goes after, by horizon; for all events and for those of a still follower.

    The whole of L5: l05_leader_events looks at whole minutes.
    """
    t, ticks = tape_once(spark, d), table(spark, d, "ativos", "symbol", "tick")
    top = t.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "symbol").limit(1).select("symbol")
    events = leader_moves(t.join(top, "symbol", "left_semi").join(ticks, "symbol"), _LEAD["ticks"], _LEAD["window_ms"], _LEAD["rest_ms"])
    return followers(events, t.join(top, "symbol", "left_anti"), ticks, _LEAD["window_ms"], _LEAD["horizons_ms"])


def leader_moves(t: DataFrame, ticks: int, window_ms: int, rest_ms: int) -> DataFrame:
    """Instants (dt, lado, ts_ns) at which a leader's trade is that many ticks away from its price as of the window before."""
    probe = t.select("symbol", "dt", "price", "tick", F.col("ts_ns").alias("em"), (F.col("ts_ns") - window_ms * _MS).alias("ts_ns"))
    path = t.select("symbol", "dt", "ts_ns", "ts_recv_ns", F.col("trade_id").alias("_id"), F.col("price").alias("antes"))
    move = F.col("price") - F.col("antes")
    e = asof_backward(probe, path, ["symbol", "dt"], "ts_ns", ["antes"], tie=["ts_recv_ns", "_id"], slice_size=B.SLICE_NS).where(F.abs(move) >= ticks * F.col("tick") - 1e-9)
    e = e.select("dt", F.signum(move).cast("bigint").alias("lado"), F.col("em").alias("ts_ns")).distinct()
    return greedy_keep(e, ["dt", "lado"], "ts_ns", rest_ms * _MS)


def followers(events: DataFrame, t: DataFrame, ticks: DataFrame, window_ms: int, horizons_ms: Sequence[int]) -> DataFrame:
    """As-of moves of each symbol of ``t`` around the events, in their direction.

    A symbol's day meets the day's events once and is searched as sorted arrays, so no probe per event, symbol and horizon
    is shuffled; sums are of millionths, thus exact in any order.
    """
    path = t.groupBy("symbol", "dt", "ts_ns").agg(F.max(F.struct("ts_recv_ns", "trade_id", "price")).alias("w")).select(F.col("symbol").alias("quem"), F.col("dt").alias("dia"), "ts_ns", "w.price")
    pairs = t.select("symbol", "dt").distinct().join(ticks, "symbol", "left").join(events.withColumnRenamed("ts_ns", "em"), "dt").select("symbol", "dt", "tick", "lado", "em")

    def day(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            ts, px = right["ts_ns"].to_numpy(), right["price"].to_numpy()
            order = np.argsort(ts)
            ts, px = ts[order], px[order]
            at, side = left["em"].to_numpy(), left["lado"].to_numpy()
            tick = left["tick"][0].as_py()
            first = np.searchsorted(ts, at - window_ms * _MS, side="right") - 1
            at, side, first = at[first >= 0], side[first >= 0], first[first >= 0]
            now = px[np.searchsorted(ts, at, side="right") - 1]
            pre = np.rint((now - px[first]) * side * 1e6).astype(np.int64)
            still = np.abs(pre) < tick * 1e6 - 1e-3 if tick is not None else np.zeros(len(pre), bool)
            for h in horizons_ms:
                pos = np.rint((px[np.searchsorted(ts, at + h * _MS, side="right") - 1] - now) * side * 1e6).astype(np.int64)
                for name, of in (("todos", np.ones(len(pre), bool)), ("parado", still)):
                    if of.any():
                        rows.append((left["symbol"][0].as_py(), name, h, int(of.sum()), int(pre[of].sum()), int(pos[of].sum()), int((pos[of] > 0).sum()), int((pos[of] < 0).sum())))
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 8, (pa.string(), pa.string(), *[pa.int64()] * 6), strict=True)], ["symbol", "subconjunto", "horizonte_ms", "n", "pre", "pos", "favor", "contra"])

    per = pairs.groupBy("symbol", "dt").cogroup(path.groupBy("quem", "dia")).applyInArrow(day, "symbol string, subconjunto string, horizonte_ms long, n long, pre long, pos long, favor long, contra long")
    s = per.groupBy("symbol", "subconjunto", "horizonte_ms").agg(*(F.sum(c).alias(c) for c in ("n", "pre", "pos", "favor", "contra")))
    n = F.col("n")
    return s.select("symbol", "subconjunto", "horizonte_ms", "n", (F.col("pre") / 1e6 / n).alias("pre_media"), (F.col("pos") / 1e6 / n).alias("media"), (100.0 * F.col("favor") / n).alias("pct_a_favor"), (100.0 * F.col("contra") / n).alias("pct_contra"))


@R.add(f"WITH {SQL_M1}, h AS (SELECT symbol, dt, minuto, volume, CASE WHEN count(volume) OVER w >= 2 THEN quantile_cont(volume::double, 0.5) OVER w END AS med FROM m1 WINDOW w AS (PARTITION BY symbol, minuto % 1440 ORDER BY dt ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)) SELECT symbol, count(*) FILTER (WHERE volume >= med) AS passa, count(*) FILTER (WHERE volume < med) AS complemento, count(*) FILTER (WHERE med IS NULL) AS indefinido FROM h GROUP BY symbol")
def l10_volume_gate(spark, d):
    """Bars against the trailing median volume of their minute of day; undefined ones are counted."""
    w = Window.partitionBy("symbol", F.pmod("minuto", F.lit(1440))).orderBy("dt").rowsBetween(-20, -1)
    h = m1(spark, d).withColumn("med", F.when(F.count("volume").over(w) >= 2, F.percentile(F.col("volume").cast("double"), F.lit(0.5)).over(w)))
    return h.groupBy("symbol").agg(F.count_if(F.col("volume") >= F.col("med")).alias("passa"), F.count_if(F.col("volume") < F.col("med")).alias("complemento"), F.count_if(F.col("med").isNull()).alias("indefinido"))


@R.add(f"WITH {SQL_DIA}, o AS (SELECT symbol, dt, o, m0, lag(h) OVER ({_DAYW}) AS ph, lag(l) OVER ({_DAYW}) AS pl, lag(c) OVER ({_DAYW}) AS pc FROM dia), t AS (SELECT m1.symbol, m1.dt, min(minuto) FILTER (WHERE high > ph) AS alta, min(minuto) FILTER (WHERE low < pl) AS baixa FROM m1 JOIN o USING (symbol, dt) WHERE ph IS NOT NULL GROUP BY ALL) SELECT o.symbol, o.dt, round(o.o - o.pc, 6) AS gap, CASE WHEN o.o > ph OR o.o < pl THEN 'gap_fora' WHEN alta IS NULL AND baixa IS NULL THEN 'nenhum' WHEN alta = baixa THEN 'duplo' WHEN baixa IS NULL OR alta < baixa THEN 'alta' ELSE 'baixa' END AS rompimento FROM o LEFT JOIN t ON t.symbol = o.symbol AND t.dt = o.dt WHERE ph IS NOT NULL")
def l12_previous_day_breakout(spark, d):
    """The first passage of yesterday's extremes, opening gaps beyond them apart; the gap itself is L13's input."""
    day = days(spark, d)
    prev = day.select("symbol", "dt", "o", F.lag("h").over(by_day()).alias("ph"), F.lag("l").over(by_day()).alias("pl"), F.lag("c").over(by_day()).alias("pc")).where("ph is not null")
    t = m1(spark, d).join(prev, ["symbol", "dt"])
    t = t.groupBy("symbol", "dt", "o", "ph", "pl", "pc").agg(F.min(F.when(F.col("high") > F.col("ph"), F.col("minuto"))).alias("a"), F.min(F.when(F.col("low") < F.col("pl"), F.col("minuto"))).alias("b"))
    kind = F.when((F.col("o") > F.col("ph")) | (F.col("o") < F.col("pl")), "gap_fora").when(F.col("a").isNull() & F.col("b").isNull(), "nenhum").when(F.col("a") == F.col("b"), "duplo").when(F.col("b").isNull() | (F.col("a") < F.col("b")), "alta").otherwise("baixa")
    return t.select("symbol", "dt", r6(F.col("o") - F.col("pc")).alias("gap"), kind.alias("rompimento"))


@R.add(f"WITH {SQL_M1}, b AS (SELECT *, {sql_full('avg(close)', 'close', _M1W, '20 PRECEDING', 'CURRENT ROW', 21)} AS m, {sql_full('stddev_pop(close)', 'close', _M1W, '20 PRECEDING', 'CURRENT ROW', 21)} AS s FROM m1), l AS (SELECT symbol, dt, minuto, lag(close) OVER ({_M1W}) < round(lag(m - 2 * s) OVER ({_M1W}), 6) AS fora, close > round(m - 2 * s, 6) AS volta, s FROM b) SELECT symbol, dt, minuto FROM l WHERE fora AND volta")
def l14_band_return(spark, d):
    """A close below the lower band followed by one above it."""
    c = F.col("close")
    mean, sd = full_window(F.avg(c), c, in_minutes(), -20, 0), full_window(F.stddev_pop(c), c, in_minutes(), -20, 0)
    b = m1(spark, d).withColumn("banda", F.round(mean - 2 * sd, 6))
    b = b.withColumns({"fora": F.lag("close").over(in_minutes()) < F.lag("banda").over(in_minutes()), "volta": c > F.col("banda")})
    return b.where("fora and volta").select("symbol", "dt", "minuto")


_SCALP_WIDTH = 0.38
_BARW = "PARTITION BY symbol ORDER BY dt, minuto"


@R.add(f"""WITH {SQL_M1}, b AS (SELECT *, {sql_full('avg(close)', 'close', _BARW, '20 PRECEDING', 'CURRENT ROW', 21)} AS m, {sql_full('stddev_pop(close)', 'close', _BARW, '20 PRECEDING', 'CURRENT ROW', 21)} AS s FROM m1),
k AS (SELECT *, close > round(m + {_SCALP_WIDTH} * s, 6) AS acima, close < round(m - {_SCALP_WIDTH} * s, 6) AS abaixo FROM b),
x AS (SELECT *, lag(close < open AND acima, 2) OVER w AND lag(close > open AND acima, 1) OVER w AS compra, lag(close > open AND abaixo, 2) OVER w AND lag(close < open AND abaixo, 1) OVER w AS venda,
  lag(high, 2) OVER w AS h2, lag(high, 1) OVER w AS h1, lag(low, 2) OVER w AS l2, lag(low, 1) OVER w AS l1, row_number() OVER w > 21 AS quente FROM k WINDOW w AS ({_M1W})),
v AS (SELECT symbol, dt, minuto, 'compra' AS lado, 'retorno' AS variante, h2 AS limite, open, high, low FROM x WHERE quente AND compra UNION ALL SELECT symbol, dt, minuto, 'compra', 'rompimento', h1, open, high, low FROM x WHERE quente AND compra
  UNION ALL SELECT symbol, dt, minuto, 'venda', 'retorno', l2, open, high, low FROM x WHERE quente AND venda UNION ALL SELECT symbol, dt, minuto, 'venda', 'rompimento', l1, open, high, low FROM x WHERE quente AND venda)
SELECT symbol, dt, minuto, lado, variante, limite, CASE WHEN lado = 'compra' THEN low <= limite ELSE high >= limite END AS tocou,
  CASE WHEN lado = 'compra' AND low <= limite THEN CASE WHEN open <= limite THEN 'abertura' ELSE 'recuo' END WHEN lado = 'venda' AND high >= limite THEN CASE WHEN open >= limite THEN 'abertura' ELSE 'recuo' END END AS tipo FROM v""")
def l14b_band_scalp(spark, d):
    """Two bars of opposite colours that both close outside one band, then the entry bar: the limit at the extreme of the first
    ("retorno") or second ("rompimento") one, whether it was touched, and if so at the open or on a pull-back.

    The whole clause of L14 but for stops and targets; l14_band_return is another pattern. Bands go on over days, the three
    bars are of one day, and its first 21 bars give no entry.
    """
    return band_scalp(m1(spark, d))


def band_scalp(bars: DataFrame, n: int = 21, width: float = _SCALP_WIDTH) -> DataFrame:
    c, o = F.col("close"), F.col("open")
    lower, _, upper = bollinger(c, Window.partitionBy("symbol").orderBy("dt", "minuto"), n, width)
    above, below = c > F.round(upper, 6), c < F.round(lower, 6)
    was = lambda x, k: F.coalesce(F.lag(x, k).over(in_minutes()), F.lit(False))
    x = bars.withColumns({"_ra": (c < o) & above, "_wa": (c > o) & above, "_wb": (c > o) & below, "_rb": (c < o) & below})
    x = x.withColumns({"_buy": was("_ra", 2) & was("_wa", 1), "_sell": was("_wb", 2) & was("_rb", 1)} | {f"_{v[0]}{k}": F.lag(v, k).over(in_minutes()) for v in ("high", "low") for k in (1, 2)} | {"_i": F.row_number().over(in_minutes())})
    entry = lambda side, kind, at: F.struct(F.lit(side).alias("lado"), F.lit(kind).alias("variante"), F.col(at).alias("limite"))
    both = lambda side, v: F.array(entry(side, "retorno", f"_{v}2"), entry(side, "rompimento", f"_{v}1"))
    x = x.where((F.col("_buy") | F.col("_sell")) & (F.col("_i") > n)).withColumn("_e", F.explode(F.when(F.col("_buy"), both("compra", "h")).otherwise(both("venda", "l")))).select("symbol", "dt", "minuto", "open", "high", "low", "_e.*")
    buy, at = F.col("lado") == "compra", F.col("limite")
    x = x.withColumn("tocou", F.when(buy, F.col("low") <= at).otherwise(F.col("high") >= at))
    kind = F.when(F.when(buy, o <= at).otherwise(o >= at), "abertura").otherwise("recuo")
    return x.select("symbol", "dt", "minuto", "lado", "variante", "limite", "tocou", F.when(F.col("tocou"), kind).alias("tipo"))


@R.add(f"WITH {SQL_M1}, z AS (SELECT *, round({sql_z('volume', _M1W, 15, 15)}, 6) AS zv, round({sql_z('(high - low)', _M1W, 15, 15)}, 6) AS za, close - lag(close, 6) OVER ({_M1W}) AS ctx FROM m1) SELECT symbol, dt, minuto, round(lag(ctx) OVER ({_M1W}), 6) + 0.0 AS contexto FROM z QUALIFY zv >= 1.5 AND za <= 0.5")
def l16_absorption_bars(spark, d):
    """Much volume in a small range, with the move of the six bars before."""
    z = m1(spark, d).withColumn("faixa", F.col("high") - F.col("low"))
    z = z.withColumns({"zv": r6(strict_past_z(F.col("volume").cast("double"), in_minutes(), 15, 15)), "za": r6(strict_past_z(F.col("faixa"), in_minutes(), 15, 15)), "ctx": F.col("close") - F.lag("close", 6).over(in_minutes())})
    z = z.withColumn("contexto", r6(F.lag("ctx").over(in_minutes())))
    return z.where("zv >= 1.5 and za <= 0.5").select("symbol", "dt", "minuto", "contexto")


@R.add(f"WITH {SQL_TAPE}, n AS (SELECT symbol, price, quantidade FROM tape), k AS (SELECT symbol, CASE WHEN abs(price - round(price)) <= 0.02 + 1e-9 THEN 'nivel' WHEN abs(price - (floor(price) + 0.5)) <= 0.02 + 1e-9 THEN 'placebo' END AS onde, quantidade FROM n) SELECT symbol, coalesce(sum(quantidade) FILTER (WHERE onde = 'nivel'), 0)::bigint AS nos_niveis, coalesce(sum(quantidade) FILTER (WHERE onde = 'placebo'), 0)::bigint AS no_placebo FROM k GROUP BY symbol")
def l23_level_magnetism(spark, d):
    """Volume near whole prices against the midpoints between them."""
    p, q = F.col("price"), F.col("quantidade")
    at = F.abs(p - F.round(p)) <= 0.02 + 1e-9
    mid = ~at & (F.abs(p - (F.floor(p) + 0.5)) <= 0.02 + 1e-9)
    return tape(spark, d).groupBy("symbol").agg(F.coalesce(F.sum(F.when(at, q)), F.lit(0)).alias("nos_niveis"), F.coalesce(F.sum(F.when(mid, q)), F.lit(0)).alias("no_placebo"))


@R.add(f"WITH {SQL_FLOW}, m AS (SELECT symbol, median(round(rlp_frac, 9)) AS med FROM flow GROUP BY symbol), x AS (SELECT f.symbol, round(rlp_frac, 9) > med AS alto, lead(close) OVER (PARTITION BY f.symbol ORDER BY bar_id) / close - 1 AS ret FROM flow f JOIN m USING (symbol)) SELECT symbol, alto, count(*) AS n, round(avg(ret), 9) + 0.0 AS media FROM x WHERE ret IS NOT NULL AND alto IS NOT NULL GROUP BY ALL")
def l24_regime_split(spark, d):
    """Next-bar returns above and below the symbol's own median retail share."""
    f = flow(spark, d).withColumns({"r": F.round("rlp_frac", 9), "ret": F.lead("close").over(by_bar()) / F.col("close") - 1})
    med = f.groupBy("symbol").agg(F.median("r").alias("med"))
    return f.join(med, "symbol").withColumn("alto", F.col("r") > F.col("med")).where("ret is not null and alto is not null").groupBy("symbol", "alto").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("ret"), 9).alias("media"))


# ---- M: fills and probes ---------------------------------------------------------------------------------------------


@R.add(f"WITH {_M5}, x AS (SELECT r.symbol, r.dt, r.minuto, r.resultado, min(f.low) AS pior FROM res r JOIN m1 f ON f.symbol = r.symbol AND f.dt = r.dt AND f.minuto > r.minuto AND f.minuto <= r.minuto + 10 JOIN m1 e ON e.symbol = r.symbol AND e.dt = r.dt AND e.minuto = r.minuto WHERE r.lado > 0 GROUP BY ALL), k AS (SELECT unnest([0.01, 0.02, 0.05]) AS corte) SELECT x.symbol, k.corte, (m.close - x.pior >= k.corte - 1e-9) AS tocou, count(*) AS n, round(avg(resultado), 6) + 0.0 AS media FROM x JOIN m1 m ON m.symbol = x.symbol AND m.dt = x.dt AND m.minuto = x.minuto, k GROUP BY ALL")
def m03_conditional_reversal(spark, d):
    """Results of buys that first went against by each cut, and of those that didn't, within ten minutes."""
    r = resolved(spark, d).where("lado > 0").select("symbol", "dt", "minuto", "close", "resultado")
    path = m1(spark, d).select("symbol", "dt", F.col("minuto").alias("m"), F.col("low").alias("baixo"))
    x = range_join(r, path, ["symbol", "dt"], "minuto", "m", 10, ["baixo"]).groupBy("symbol", "dt", "minuto", "close", "resultado").agg(F.min("baixo").alias("pior"))
    x = x.withColumn("corte", F.explode(F.array(*map(F.lit, (0.01, 0.02, 0.05))))).withColumn("tocou", F.col("close") - F.col("pior") >= F.col("corte") - 1e-9)
    return x.groupBy("symbol", "corte", "tocou").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("resultado")).alias("media"))


@R.add(f"WITH {SQL_TAPE}, {_BIG}, x AS (SELECT e.symbol, e.dt, e.trade_id, hz, max(t.price - e.price) AS mfe, min(t.price - e.price) AS mae, min(t.ts_ns - e.ts_ns) FILTER (WHERE t.price > e.price) AS alta_ns FROM ev e, (SELECT unnest([60, 300]) AS hz) h JOIN tape t ON t.symbol = e.symbol AND t.dt = e.dt AND t.ts_ns > e.ts_ns AND t.ts_ns <= e.ts_ns + hz::bigint * 1000000000 GROUP BY ALL) SELECT symbol, dt, trade_id, hz::bigint AS horizonte_s, round(greatest(mfe, 0), 6) AS mfe, round(least(mae, 0), 6) + 0.0 AS mae, alta_ns FROM x")
def m12_forward_probe(spark, d):
    """Excursions and the time to the first higher trade, for two horizons, from the tape itself."""
    t = tape_once(spark, d)
    path = range_join(big_buys(t), t.withColumnRenamed("price", "p"), ["symbol", "dt"], "ts_ns", "ts_ns", 300 * 10**9, ["p"])
    move, gone = F.col("p") - F.col("price"), F.col("_at") - F.col("ts_ns")
    of = lambda h: F.struct(
        F.lit(h).cast("bigint").alias("horizonte_s"), F.max(F.when(gone <= h * 10**9, move)).alias("x"), F.min(F.when(gone <= h * 10**9, move)).alias("i"),
        F.min(F.when((gone <= h * 10**9) & (F.col("p") > F.col("price")), gone)).alias("alta_ns"),
    )
    g = path.groupBy("symbol", "dt", "trade_id").agg(F.array(of(60), of(300)).alias("_h")).select("symbol", "dt", "trade_id", F.explode("_h").alias("_h")).select("symbol", "dt", "trade_id", "_h.*").where("x is not null")
    return g.select("symbol", "dt", "trade_id", "horizonte_s", r6(F.greatest("x", F.lit(0.0))).alias("mfe"), r6(F.least("i", F.lit(0.0))).alias("mae"), "alta_ns")


@R.add(f"WITH {SQL_TAPE}, {_BIG} SELECT e.symbol, e.dt, e.trade_id, round(max(t.price) - e.price, 6) AS pior_compra, round(min(t.price) - e.price, 6) + 0.0 AS melhor_compra FROM ev e JOIN tape t ON t.symbol = e.symbol AND t.dt = e.dt AND t.ts_ns > e.ts_ns AND t.ts_ns <= e.ts_ns + 2000000000 GROUP BY e.symbol, e.dt, e.trade_id, e.price")
def m13_execution_window(spark, d):
    """Worst and best price within two seconds of an event."""
    t = tape_once(spark, d)
    path = range_join(big_buys(t), t.withColumnRenamed("price", "p"), ["symbol", "dt"], "ts_ns", "ts_ns", 2 * 10**9, ["p"])
    return path.groupBy("symbol", "dt", "trade_id", "price").agg(F.max("p").alias("x"), F.min("p").alias("i")).select("symbol", "dt", "trade_id", r6(F.col("x") - F.col("price")).alias("pior_compra"), r6(F.col("i") - F.col("price")).alias("melhor_compra"))


@R.add(f"WITH {_M5}, dd AS (SELECT symbol, dt, sum(resultado) AS s, count(*) AS n FROM res GROUP BY ALL), t AS (SELECT symbol, sum(s) AS ts, sum(n) AS tn, count(*) AS k, min(round(s, 6)) AS pior_dia FROM dd GROUP BY symbol), j AS (SELECT dd.symbol, min(round((ts - s) / nullif(tn - n, 0), 6)) AS sem_um_dia_min, max(round((ts - s) / nullif(tn - n, 0), 6)) AS sem_um_dia_max FROM dd JOIN t USING (symbol) GROUP BY ALL) SELECT symbol, k AS dias, pior_dia + 0.0 AS pior_dia, sem_um_dia_min + 0.0 AS sem_um_dia_min, sem_um_dia_max + 0.0 AS sem_um_dia_max FROM t JOIN j USING (symbol)")
def m16_jackknife_by_day(spark, d):
    """The worst day, and the mean result without each day in turn: totals minus the day, no replicas."""
    dd = resolved(spark, d).groupBy("symbol", "dt").agg(F.sum("resultado").alias("s"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("symbol")
    without = F.round((F.sum("s").over(w) - F.col("s")) / F.nullif(F.sum("n").over(w) - F.col("n"), F.lit(0)), 6)
    return dd.withColumn("x", without).groupBy("symbol").agg(F.count(F.lit(1)).alias("dias"), F.min(F.round("s", 6)).alias("pior_dia"), F.min("x").alias("sem_um_dia_min"), F.max("x").alias("sem_um_dia_max"))


# ---- O: inference ----------------------------------------------------------------------------------------------------


@R.add(f"WITH {_M5}, q AS (SELECT symbol, CASE WHEN lado > 0 THEN 'compra' ELSE 'venda' END AS lado, dt, desfecho FROM res) SELECT symbol, lado, dt, count(*) AS n, count(*) FILTER (WHERE desfecho = 'alvo') AS alvos, round(count(*) FILTER (WHERE desfecho = 'alvo') / nullif(count(*) FILTER (WHERE desfecho IN ('alvo', 'stop')), 0), 6) AS p1 FROM q GROUP BY GROUPING SETS ((symbol, lado), (symbol, dt), (lado), ())")
def o09_score_card(spark, d):
    """Hit rates over several strata in one pass."""
    q = resolved(spark, d).select("symbol", F.when(F.col("lado") > 0, "compra").otherwise("venda").alias("lado"), "dt", "desfecho")
    hits, done = F.count_if(F.col("desfecho") == "alvo"), F.count_if(F.col("desfecho").isin("alvo", "stop"))
    sets = [[F.col("symbol"), F.col("lado")], [F.col("symbol"), F.col("dt")], [F.col("lado")], []]
    return q.groupingSets(sets, "symbol", "lado", "dt").agg(F.count(F.lit(1)).alias("n"), hits.alias("alvos"), r6(hits / F.nullif(done, F.lit(0))).alias("p1"))


@R.add(f"WITH {SQL_M1}, r AS (SELECT symbol, abs(close / open - 1) AS m, lead(close) OVER ({_M1W}) / close - 1 AS y FROM m1), k AS (SELECT unnest([0.0001, 0.0002, 0.0005]) AS corte) SELECT symbol, corte, count(*) AS n, round(1.96 * stddev_samp(y) / sqrt(count(*)), 9) AS emd FROM r, k WHERE y IS NOT NULL AND m >= corte GROUP BY ALL HAVING count(*) >= 10")
def o14_power_curve(spark, d):
    """The smallest detectable next-bar return as the threshold rises."""
    r = m1(spark, d).select("symbol", F.abs(F.col("close") / F.col("open") - 1).alias("m"), (F.lead("close").over(in_minutes()) / F.col("close") - 1).alias("y")).where("y is not null")
    r = r.withColumn("corte", F.explode(F.array(*map(F.lit, (0.0001, 0.0002, 0.0005))))).where("m >= corte")
    return r.groupBy("symbol", "corte").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("y").alias("sd")).where("n >= 10").select("symbol", "corte", "n", r6(minimum_effect(F.col("sd"), F.col("n")), 9).alias("emd"))


@R.add(f"WITH {SQL_FLOW}, x AS (SELECT symbol, round(imbalance, 9) AS a, round(tick_imbalance, 9) AS b FROM flow), q AS (SELECT symbol, quantile_cont(a, [0.1, 0.9]) AS qa, quantile_cont(b, [0.1, 0.9]) AS qb FROM x GROUP BY symbol) SELECT symbol, count(*) AS n, count(*) FILTER (WHERE a >= qa[2] AND b >= qb[2]) AS juntos_acima, count(*) FILTER (WHERE a <= qa[1] AND b <= qb[1]) AS juntos_abaixo, count(*) FILTER (WHERE sign(a) = sign(b)) AS mesmo_sinal FROM x JOIN q USING (symbol) GROUP BY symbol")
def o18_decile_agreement(spark, d):
    """How often a proxy is in the same extreme decile as what it stands for, and of the same sign."""
    x = flow(spark, d).select("symbol", F.round("imbalance", 9).alias("a"), F.round("tick_imbalance", 9).alias("b"))
    edge = F.array(F.lit(0.1), F.lit(0.9))
    q = x.groupBy("symbol").agg(F.percentile("a", edge).alias("qa"), F.percentile("b", edge).alias("qb"))
    a, b, qa, qb = (F.col(c) for c in ("a", "b", "qa", "qb"))
    return x.join(q, "symbol").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.count_if((a >= qa[1]) & (b >= qb[1])).alias("juntos_acima"), F.count_if((a <= qa[0]) & (b <= qb[0])).alias("juntos_abaixo"), F.count_if(F.signum(a) == F.signum(b)).alias("mesmo_sinal"))


# ---- P: descriptions -------------------------------------------------------------------------------------------------


@R.add(f"WITH {SQL_TAPE}, k AS (SELECT unnest([1000, 1200, 1500]) AS hhmm), s AS (SELECT t.symbol, t.dt, k.hhmm, CASE WHEN trade_type IN (2, 3) THEN true ELSE false END AS agr, price, quantidade FROM tape t, k WHERE {SQL_HHMM} < k.hhmm) SELECT symbol, dt, hhmm::bigint AS hhmm, round(sum(price * quantidade) / sum(quantidade), 5) AS vwap_todos, round(sum(price * quantidade) FILTER (WHERE agr) / sum(quantidade) FILTER (WHERE agr), 5) AS vwap_agressao FROM s GROUP BY ALL")
def mk06_vwap_checkpoints(spark, d):
    """VWAP up to some clocks, for two sets of trade types."""
    from ..operators.tape import local_hhmm

    t = tape(spark, d).withColumn("_h", local_hhmm(F.col("ts_ns")))
    t = t.withColumn("hhmm", F.explode(F.array(*(F.lit(h).cast("bigint") for h in (1000, 1200, 1500))))).where("_h < hhmm")
    pq, q, ag = F.col("price") * F.col("quantidade"), F.col("quantidade"), is_aggressor(F.col("trade_type"))
    return t.groupBy("symbol", "dt", "hhmm").agg(r6(F.sum(pq) / F.sum(q), 5).alias("vwap_todos"), r6(F.sum(F.when(ag, pq)) / F.sum(F.when(ag, q)), 5).alias("vwap_agressao"))


@R.add(f"WITH {SQL_M1} SELECT symbol, dt, count(*) AS barras, (max(minuto) - min(minuto) + 1 - count(*))::bigint AS faltam, max(minuto) - min(minuto) + 1 AS vao FROM m1 GROUP BY ALL")
def mk07_m1_inventory(spark, d):
    span = F.max("minuto") - F.min("minuto") + 1
    return m1(spark, d).groupBy("symbol", "dt").agg(F.count(F.lit(1)).alias("barras"), (span - F.count(F.lit(1))).alias("faltam"), span.alias("vao"))


@R.add(f"WITH {SQL_DIA}, x AS (SELECT symbol, count(*) AS pregoes, round(median(v), 6) AS volume_mediano, round(median(n), 6) AS barras_medianas FROM dia GROUP BY symbol), b AS (SELECT {SQL_SYMBOL} AS symbol, count(*) AS deltas FROM book_offer GROUP BY ALL) SELECT x.*, coalesce(deltas, 0) AS deltas, CASE WHEN pregoes >= 160 THEN 'fase_2' ELSE 'fase_1' END AS fase FROM x LEFT JOIN b USING (symbol)")
def mk03_session_inventory(spark, d):
    """What the data of each symbol allows: sessions, volume, bars, book."""
    x = days(spark, d).groupBy("symbol").agg(F.count(F.lit(1)).alias("pregoes"), r6(F.median("v")).alias("volume_mediano"), r6(F.median("n")).alias("barras_medianas"))
    b = table(spark, d, "book_offer", "symbol").groupBy("symbol").agg(F.count(F.lit(1)).alias("deltas"))
    return x.join(b, "symbol", "left").withColumns({"deltas": F.coalesce("deltas", F.lit(0)), "fase": F.when(F.col("pregoes") >= 160, "fase_2").otherwise("fase_1")})


@R.add(f"WITH {SQL_M1} SELECT symbol, round(quantile_cont(high - low, 0.25), 6) AS p25, round(quantile_cont(high - low, 0.5), 6) AS p50, round(quantile_cont(high - low, 0.75), 6) AS p75, count(*) FILTER (WHERE high - low >= 0.02) AS com_2, count(*) FILTER (WHERE high - low >= 0.05) AS com_5 FROM m1 GROUP BY symbol")
def mk11_range_quantiles(spark, d):
    reach = F.col("high") - F.col("low")
    q = lambda p: r6(F.percentile(reach, F.lit(p)))
    return m1(spark, d).groupBy("symbol").agg(q(0.25).alias("p25"), q(0.5).alias("p50"), q(0.75).alias("p75"), F.count_if(reach >= 0.02).alias("com_2"), F.count_if(reach >= 0.05).alias("com_5"))


@R.add(f"SELECT strftime(make_timestamp((ts_recv_ns // 1000)::bigint), '%H') AS hora, count(*) AS linhas, count(*) FILTER (WHERE is_edit) AS edicoes FROM trades GROUP BY ALL")
def mk19_rows_by_hour(spark, d):
    hour = F.date_format(F.timestamp_micros(F.expr("ts_recv_ns div 1000")), "HH")
    return table(spark, d, "trades", "ts_recv_ns", "is_edit").groupBy(hour.alias("hora")).agg(F.count(F.lit(1)).alias("linhas"), F.count_if("is_edit").alias("edicoes"))


@R.add(f"WITH {SQL_TAPE}, l AS (SELECT dt, agente_comprador AS agente, quantidade AS q FROM tape WHERE agente_comprador <> agente_vendedor UNION ALL SELECT dt, agente_vendedor, -quantidade FROM tape WHERE agente_comprador <> agente_vendedor), g AS (SELECT dt, agente, sum(q)::bigint AS v FROM l WHERE agente > 0 GROUP BY ALL), v AS (SELECT *, dense_rank() OVER (ORDER BY dt) AS k FROM g), p AS (SELECT a.agente, b.k, least(abs(a.v), abs(b.v)) * sign(a.v) * sign(b.v) AS casado FROM v a JOIN v b ON a.agente = b.agente AND b.k = a.k + 1) SELECT agente, k, casado::double AS casado FROM p")
def o12_matched_flows(spark, d):
    """Each broker's net flow matched with the next session's: the statistic of the persistence test."""
    return persistence(net_flows(spark, d), [], "agente", "dt", "v")


def net_flows(spark, d):
    """Signed flow per broker and day, without trades a broker did with itself."""
    t = tape(spark, d).where("agente_comprador <> agente_vendedor")
    legs = F.array(F.struct(F.col("agente_comprador").alias("a"), F.col("quantidade").alias("q")), F.struct(F.col("agente_vendedor").alias("a"), (-F.col("quantidade")).alias("q")))
    return t.select("dt", F.explode(legs).alias("l")).where("l.a > 0").groupBy("dt", F.col("l.a").alias("agente")).agg(F.sum("l.q").alias("v"))


@R.add()
def o12_sign_flip(spark, d):
    """The persistence test itself, against 500 sign draws."""
    return sign_flip_test(persistence(net_flows(spark, d), [], "agente", "dt", "v"), [], "agente", 500)


@R.add()
def l20_permuted_runs(spark, d):
    """Repeated equal lots, really and with size and brokers permuted, and the smoothed ratio of both."""
    keys, order = ["symbol", "dt"], ["ts_ns", "ts_recv_ns", "trade_id"]
    t = tape_once(spark, d)
    shuffled = permuted(t, keys, order, ["quantidade", "agente_comprador", "agente_vendedor"])
    n = lambda rows, name: iceberg_runs(rows).groupBy("symbol").agg(F.count(F.lit(1)).alias(name))
    both = n(t, "observadas").join(n(shuffled, "base"), "symbol", "full_outer").fillna(0)
    return both.withColumn("razao", r6((F.col("observadas") + 1) / (F.col("base") + 1)))


@R.add()
def l25_matched_direction(spark, d):
    """The next minute's return after a jump against time-matched minutes without one."""
    move = F.col("close") / F.lag("close").over(in_minutes()) - 1
    rows = m1(spark, d).withColumns({"sinal": F.coalesce(F.abs(move) >= 0.0003, F.lit(False)), "ret": F.abs(F.lead("close").over(in_minutes()) / F.col("close") - 1), "hora": F.expr("minuto % 1440 div 60")}).where("ret is not null")
    both = matched_control(rows, ["symbol", "hora"], "sinal", ["symbol", "dt", "minuto"])
    return both.groupBy("symbol", "grupo").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("ret"), 9).alias("media"))


@R.add()
def o13_honesty_gate(spark, d):
    """The flow pipeline over a tape without information: the coefficient with the next return, and whether noise is refused."""
    t = random_walk_tape(spark, 10, 3000)
    f = B.flow_features(B.volume_bars(t, 200), ["symbol", "bar_id"], 5.0)
    x = f.withColumn("ret", F.lead("close").over(by_bar()) / F.col("close") - 1).where("ret is not null")
    ic = information_coefficient(x, ["symbol"], "imbalance", "ret")
    return ic.select("symbol", "n", r6("ic").alias("ic"), (F.abs("ic") < 2 / F.sqrt("n")).alias("recusado"))


QUERIES, ORACLES = R.queries, R.sql
