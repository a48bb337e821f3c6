"""The queries p3, p7, p8, p9 and p10 over whole tables, and their SQL where it can be written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from ..sources.tables import table, valid_ts
from .mixing import mix_report, mix_sources
from .nearest import nearest_by_ticks
from .percentiles import digests, merge_digests, percentiles
from .subjects import assign_subjects, spoken_of, train
from .tokens import VOCABULARY, count_tokens, encode_corpus

SQL_SYMBOL = "upper(trim(symbol))"
SQL_VALID = "(ts_ns >= epoch_ns(try_cast(dt AS timestamp)) AND ts_ns < epoch_ns(try_cast(dt AS timestamp)) + 86400000000000)"


def source_name(c):  # noqa: ANN001, ANN201
    """Trimmed, lower case."""
    return F.lower(F.trim(c))


# ---- p3: percentiles -------------------------------------------------------------------------------------------------

P3_ERROR = 0.002
_SHARES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


def daily_digests(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "trades", "ts_ns", "ts_recv_ns", "symbol", "dt", "price", "quantidade")
    measures = {"atraso": F.when(valid_ts(F.col("ts_ns"), F.col("dt")), F.col("ts_recv_ns") - F.col("ts_ns")), "quantidade": F.col("quantidade"), "price": F.col("price")}
    return digests(t, ["symbol", "dt"], measures, P3_ERROR)


def weekly_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Days' digests joined into weeks."""
    days = daily_digests(spark, d).withColumn("semana", F.date_format(F.date_trunc("week", F.col("dt").try_cast("date")), "yyyy-MM-dd"))
    return percentiles(merge_digests(days, ["symbol", "semana"], P3_ERROR), ["symbol", "semana"], _SHARES)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    p50, p90, p99 = (F.col(c) for c in _SHARES)
    over = F.when(F.col("medida") == "atraso", p50 > 5e8).when(F.col("medida") == "quantidade", p90 > 20 * p50).otherwise(p99 > 1.5 * p50)
    return weekly_percentiles(spark, d).where((F.col("n") >= 100) & over).select("symbol", "semana", "medida")


def p3_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return weekly_percentiles(spark, d)


P3_FOUND_SQL = f"""
WITH r AS (
  SELECT {SQL_SYMBOL} AS symbol, strftime(date_trunc('week', dt::date), '%Y-%m-%d') AS semana, price, quantidade,
         CASE WHEN {SQL_VALID} THEN ts_recv_ns - ts_ns END AS atraso FROM trades),
m AS (
  SELECT symbol, semana, 'atraso' AS medida, atraso::double AS v FROM r UNION ALL SELECT symbol, semana, 'quantidade', quantidade::double FROM r
  UNION ALL SELECT symbol, semana, 'price', price FROM r),
q AS (SELECT symbol, semana, medida, count(v) AS n, quantile_disc(v, 0.5) AS p50, quantile_disc(v, 0.9) AS p90, quantile_disc(v, 0.99) AS p99 FROM m WHERE v IS NOT NULL GROUP BY ALL)
SELECT symbol, semana, medida FROM q
WHERE n >= 100 AND CASE medida WHEN 'atraso' THEN p50 > 5e8 WHEN 'quantidade' THEN p90 > 20 * p50 ELSE p99 > 1.5 * p50 END"""


# ---- p7: nearest quote and trade -------------------------------------------------------------------------------------

TOLERANCE_NS, TICK_NS = 200_000_000, 20_000_000


def notices(spark: SparkSession, d: str) -> DataFrame:
    """Order notices on the wall clock, to whole microseconds."""
    e = table(spark, d, "evento_ordem", "ev_id", "sessao_id", "t_mono", "ticker")
    s = table(spark, d, "sessoes", "sessao_id", "t_mono_base", "ts_base_ns")
    since = F.round((F.col("t_mono") - F.col("t_mono_base")) * 1e9).cast("bigint")
    at = F.expr("(at + 500 - pmod(at + 500, 1000))")
    return e.join(s, "sessao_id").withColumn("at", F.col("ts_base_ns") + since).select(F.col("ticker").alias("entity"), at.alias("at"), F.col("ev_id").alias("left_id"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Quotes and trades in one run: the target is part of the entity."""
    of = lambda kind, symbol: F.concat_ws(":", F.lit(kind), symbol)
    quotes = table(spark, d, "topo_livro", "topo_id", "symbol", "ts_recv_ns").where("ts_recv_ns > 0 and symbol is not null").select(of("topo", F.col("symbol")).alias("entity"), F.col("ts_recv_ns").alias("at"), F.col("topo_id").alias("right_id"))
    trades = table(spark, d, "trades", "ts_ns", "symbol", "dt", "trade_id").where(valid_ts(F.col("ts_ns"), F.col("dt")) & (F.col("trade_id") > 0) & F.col("symbol").isNotNull())
    right = quotes.unionByName(trades.select(of("trade", F.col("symbol")).alias("entity"), F.col("ts_ns").alias("at"), F.col("trade_id").alias("right_id")))
    left = notices(spark, d).where("left_id is not null and entity is not null").withColumn("alvo", F.explode(F.array(F.lit("topo"), F.lit("trade"))))
    left = left.select(F.concat_ws(":", "alvo", "entity").alias("entity"), "at", F.struct(F.col("left_id").alias("ev_id"), "alvo").alias("left_id"))
    return nearest_by_ticks(left, right, TOLERANCE_NS, TICK_NS).select("left_id.ev_id", "left_id.alvo", F.col("right_id").alias("alvo_id"))


P7_FOUND_SQL = f"""
WITH n AS (
  SELECT ev_id, upper(trim(ticker)) AS symbol, ((ts_base_ns + round((t_mono - t_mono_base) * 1e9)::bigint + 500) // 1000) * 1000 AS at
  FROM evento_ordem JOIN sessoes USING (sessao_id)),
r AS (
  SELECT 'topo' AS alvo, {SQL_SYMBOL} AS symbol, ts_recv_ns AS at, topo_id AS id FROM topo_livro WHERE ts_recv_ns > 0
  UNION ALL SELECT 'trade', {SQL_SYMBOL}, ts_ns, trade_id FROM trades WHERE {SQL_VALID} AND trade_id > 0)
SELECT ev_id, alvo, min({{'d': abs(r.at - n.at), 'id': id}})['id'] AS alvo_id
FROM n JOIN r ON n.symbol = r.symbol AND r.at BETWEEN n.at - {TOLERANCE_NS} AND n.at + {TOLERANCE_NS} GROUP BY ev_id, alvo"""


# ---- p8: token ids ---------------------------------------------------------------------------------------------------


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents", "doc_id", "text"), path=VOCABULARY)


# ---- p9: mixing ------------------------------------------------------------------------------------------------------


def sized_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents with their tokens; the quality weight is the characters a token stands for, which noise and keys keep low."""
    docs = table(spark, d, "documents", "doc_id", "source", "text").withColumn("source", source_name(F.col("source")))
    sized = count_tokens(docs, ["doc_id", "source"])
    weight = F.when(F.col("tokens") > 0, F.least(F.greatest(F.col("chars") / F.col("tokens") / 4, F.lit(0.05)), F.lit(1.0))).otherwise(0.05)
    return stored(sized.select("doc_id", "source", "tokens", weight.alias("weight")), "tamanhos")


def targets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mix_targets").withColumn("source", source_name(F.col("source")))


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return mix_report(sized_documents(spark, d), targets(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_report(spark, d).where("limited").select("source")


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(sized_documents(spark, d), targets(spark, d))


# ---- p10: subjects ---------------------------------------------------------------------------------------------------


def subjects(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text", "source").withColumn("source", source_name(F.col("source")))
    areas = sorted(r[0] for r in table(spark, d, "subject_areas", "subject").where("subject is not null").select(F.lower(F.trim("subject"))).distinct().collect())
    sources = sorted(r[0] for r in targets(spark, d).where("source is not null").select("source").distinct().collect())
    return assign_subjects(docs, train(docs, table(spark, d, "subject_labels"), areas, sources))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spoken_of(subjects(spark, d)).select("doc_id", "subject")


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    """The corpus by area: documents and mentions."""
    return spoken_of(subjects(spark, d)).groupBy("subject").agg(F.count(F.lit(1)).alias("docs"), F.sum("mentions").alias("mentions"))


QUERIES = {f.__name__: f for f in (p3_found, p3_percentiles, p7_found, p8_ids, p9_found, p9_report, p9_mixture, p10_found, p10_composition)}
ORACLES = {"p3_found": P3_FOUND_SQL, "p7_found": P7_FOUND_SQL}
