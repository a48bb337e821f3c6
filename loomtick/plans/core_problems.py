"""The queries p1, p2, p4, p5 and p6 over whole tables, and their SQL where it can be written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import book_at_close
from ..operators.dedupe import DeliveryStore
from ..operators.grid import missing_cells, regular_grid
from ..operators.late import LateAggregates
from ..session import work_folder
from ..sources.tables import DAY_NS, MINUTE_NS, day_number, table, valid_ts
from ..streaming.compactor import StreamingCompactor

SECOND_NS = 1_000_000_000

#: SQL counterparts of ``table`` and ``valid_ts``.
SQL_SYMBOL = "upper(trim(symbol))"
SQL_VALID = "(ts_ns >= epoch_ns(try_cast(dt AS timestamp)) AND ts_ns < epoch_ns(try_cast(dt AS timestamp)) + 86400000000000)"


# ---- p1: regular one-minute series -----------------------------------------------------------------------------------


def usable_trades(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "trades", "ts_ns", "symbol", "dt", "trade_id", "price", "quantidade")
    return t.where(valid_ts(F.col("ts_ns"), F.col("dt")) & (F.col("price") > 0) & (F.col("quantidade") > 0))


def minute_grid(spark: SparkSession, d: str, gap_minutes: int = 30) -> DataFrame:
    return regular_grid(usable_trades(spark, d), ["symbol", "dt"], "ts_ns", MINUTE_NS, ["price"], ["quantidade"], gap_minutes * MINUTE_NS, ["trade_id"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return missing_cells(minute_grid(spark, d), MINUTE_NS).select("symbol", F.col("cell").alias("minuto"))


def p1_series(spark: SparkSession, d: str) -> DataFrame:
    g = minute_grid(spark, d)
    return g.select("symbol", "dt", F.col("cell").alias("minuto"), "n", F.round("price_grid", 6).alias("price"), F.col("quantidade_sum").alias("quantidade"), F.col("state").alias("estado"))


_P1_CELLS = f"""
WITH usable AS (
  SELECT {SQL_SYMBOL} AS symbol, dt, ts_ns, trade_id, price, quantidade, ts_ns // {MINUTE_NS} AS c
  FROM trades WHERE {SQL_VALID} AND price > 0 AND quantidade > 0),
cells AS (
  SELECT symbol, dt, c, count(*) AS n, sum(quantidade)::bigint AS q,
         min({{'at': ts_ns, 'id': trade_id, 'v': price}}) AS f, max({{'at': ts_ns, 'id': coalesce(trade_id, -9223372036854775808), 'v': price}}) AS l
  FROM usable GROUP BY ALL),
grid AS (
  SELECT symbol, dt, unnest(range(min(c), max(c) + 1)) AS minuto FROM cells GROUP BY symbol, dt)"""

P1_FOUND_SQL = f"{_P1_CELLS} SELECT symbol, minuto FROM grid g WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.symbol = g.symbol AND c.dt = g.dt AND c.c = g.minuto)"

P1_SERIES_SQL = f"""{_P1_CELLS},
joined AS (SELECT g.symbol, g.dt, g.minuto, c.n, c.q, c.f, c.l FROM grid g LEFT JOIN cells c ON c.symbol = g.symbol AND c.dt = g.dt AND c.c = g.minuto),
near AS (
  SELECT *, last_value(l IGNORE NULLS) OVER (PARTITION BY symbol, dt ORDER BY minuto ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
            first_value(f IGNORE NULLS) OVER (PARTITION BY symbol, dt ORDER BY minuto ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM joined)
SELECT symbol, dt, minuto, coalesce(n, 0) AS n,
  round(CASE WHEN a['at'] = minuto * {MINUTE_NS} THEN a['v']
       WHEN a['at'] - b['at'] <= 30 * {MINUTE_NS} THEN b['v'] + (a['v'] - b['v']) * ((minuto * {MINUTE_NS} - b['at'])::double / (a['at'] - b['at'])::double) END, 6) AS price,
  q AS quantidade,
  CASE WHEN n IS NOT NULL THEN 'observado' WHEN a['at'] - b['at'] <= 30 * {MINUTE_NS} THEN 'interpolado' ELSE 'lacuna' END AS estado
FROM near"""


# ---- p2: the book at the end of each day -----------------------------------------------------------------------------


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    changes = table(spark, d, "book_offer", "ts_recv_ns", "symbol", "seq", "action", "side", "position", "offer_id", "quantidade", "dt")
    return book_at_close(changes, ["symbol", "dt"])


#: The same replay in SQL: one recursion step per change of a side, the book a list.
_P2_BOOK = f"""
WITH RECURSIVE copies AS (
  SELECT {SQL_SYMBOL} AS symbol, dt, seq, max({{'r': ts_recv_ns, 'a': action::bigint, 's': side::bigint, 'p': position::bigint, 'o': offer_id, 'q': quantidade}}) AS w
  FROM book_offer WHERE seq IS NOT NULL GROUP BY ALL),
ch AS (
  SELECT symbol, dt, w['s'] AS side, w['a'] AS a, w['p'] AS p, w['o'] AS o, w['q'] AS q, row_number() OVER (PARTITION BY symbol, dt, w['s'] ORDER BY seq) AS i
  FROM copies WHERE w['a'] IN (0, 1, 2, 3) AND w['p'] >= 0),
last AS (SELECT symbol, dt, side, max(i) AS n FROM ch GROUP BY ALL),
r AS (
  SELECT symbol, dt, side, 0::bigint AS i, []::STRUCT(o BIGINT, q BIGINT)[] AS b FROM last
  UNION ALL
  SELECT r.symbol, r.dt, r.side, ch.i,
    CASE WHEN a = 0 THEN list_concat(list_concat(b[1:p], [{{'o': ch.o, 'q': ch.q}}]), b[p + 1:])
         WHEN a = 1 AND p < len(b) THEN list_concat(list_concat(b[1:p], [{{'o': b[p + 1].o, 'q': ch.q}}]), b[p + 2:])
         WHEN a = 2 AND p < len(b) THEN list_concat(b[1:p], b[p + 2:])
         WHEN a = 3 THEN b[p + 2:] ELSE b END
  FROM r JOIN ch ON ch.symbol = r.symbol AND ch.dt = r.dt AND ch.side = r.side AND ch.i = r.i + 1),
book AS (
  SELECT symbol, dt, side, unnest(range(0, len(b))) AS position, unnest(b) AS w FROM r JOIN last USING (symbol, dt, side) WHERE r.i = last.n)"""
P2_FOUND_SQL = f"{_P2_BOOK} SELECT symbol, dt, side, position, w.o AS offer_id, w.q AS quantidade FROM book"
P2_DEPTH_SQL = f"{_P2_BOOK} SELECT symbol, dt, side, count(*) AS ofertas, sum(w.q)::bigint AS quantidade FROM book GROUP BY ALL"


def p2_depth(spark: SparkSession, d: str) -> DataFrame:
    """Offers and quantity left by side."""
    return p2_found(spark, d).groupBy("symbol", "dt", "side").agg(F.count(F.lit(1)).alias("ofertas"), F.sum("quantidade").alias("quantidade"))


# ---- p4: the small files ---------------------------------------------------------------------------------------------


def compactor(spark: SparkSession, d: str) -> StreamingCompactor:
    streams = {name: table(spark, d, name) for name in ("trades", "book_offer")}
    return StreamingCompactor(spark, work_folder(spark, "compactador"), streams).run(f"{d}/capture_files.parquet")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return compactor(spark, d).merged_files().select("file_id")


def p4_sizes(spark: SparkSession, d: str) -> DataFrame:
    """By stream: files and rows merged, and the rows found in the well-sized files written."""
    c = compactor(spark, d)
    planned = c.merged_files().groupBy("fluxo").agg(F.count(F.lit(1)).alias("arquivos"), F.sum("linhas").alias("linhas"))
    written = None
    for name in c.streams:
        n = c.compacted(name).select(F.lit(name).alias("fluxo"), "file_id").groupBy("fluxo").agg(F.count(F.lit(1)).alias("linhas_gravadas"), F.count_distinct("file_id").alias("arquivos_gravados"))
        written = n if written is None else written.unionByName(n)
    return planned.join(written, "fluxo", "left")


_P4_CASES = f"""
WITH latest AS (SELECT file_id, max({{'t': scan_ts, 'p': path}})['p'] AS path FROM capture_files GROUP BY file_id),
files AS (
  SELECT 'trades' AS fluxo, {SQL_SYMBOL} AS symbol, dt, file_id FROM trades
  UNION ALL SELECT 'book_offer', {SQL_SYMBOL}, dt, file_id FROM book_offer),
small AS (SELECT fluxo, file_id, count(*) AS linhas FROM files WHERE file_id IS NOT NULL GROUP BY ALL HAVING count(*) < 40),
placed AS (
  SELECT DISTINCT f.fluxo, f.symbol, f.dt, f.file_id, s.linhas FROM files f JOIN small s USING (fluxo, file_id) JOIN latest l USING (file_id)
  WHERE l.path LIKE '%.parquet'),
cases AS (SELECT * FROM placed QUALIFY count(*) OVER (PARTITION BY fluxo, symbol, dt) >= 4)"""
P4_FOUND_SQL = f"{_P4_CASES} SELECT file_id FROM cases"
P4_SIZES_SQL = f"""{_P4_CASES} SELECT fluxo, count(*) AS arquivos, sum(linhas)::bigint AS linhas, sum(linhas)::bigint AS linhas_gravadas,
 count(DISTINCT file_id) AS arquivos_gravados FROM cases GROUP BY fluxo"""


# ---- p5: one copy of each message ------------------------------------------------------------------------------------

_P5_IDENT, _P5_KEEP = ["symbol", "dt", "trade_id"], ["ts_ns", "price", "quantidade", "agente_comprador", "agente_vendedor", "trade_type", "is_edit", "file_id"]


#: Deliveries that the capture files are fed in. A file belongs to one of them, and one without a number to the first.
DELIVERIES = 3


def delivered(spark: SparkSession, d: str) -> DeliveryStore:
    """The capture files (``file_id`` is the batch of delivery) in three groups, one merge each, over the whole table.

    Numbers of files tell nothing of the order in which they came within a day (measured), and the store needs none: a copy of
    a message from another file may meet its partition in any of the later merges. ``overwritten`` on the store says how
    many historical partitions each merge replaced.
    """
    rows = table(spark, d, "trades", *_P5_IDENT, "ts_recv_ns", *_P5_KEEP).where(F.col("trade_id") > 0)
    store = DeliveryStore(spark, work_folder(spark, "entregas"), rows.schema, _P5_IDENT, "dt", ["ts_recv_ns"], _P5_KEEP)
    group = F.coalesce(F.pmod("file_id", F.lit(DELIVERIES)), F.lit(0))
    store.overwritten = []
    for k in range(DELIVERIES):
        store.overwritten.append(store.merge(f"entrega/{k}", rows.where(group == k)))
        store.data.vacuum()  # nobody else reads this store
    return store


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return delivered(spark, d).read().where(F.col("copias") > 1).select("symbol", "dt", "trade_id", "ts_recv_ns")


def p5_single(spark: SparkSession, d: str) -> DataFrame:
    """Every named trade once: the copy that stays."""
    return delivered(spark, d).read().select("symbol", "dt", "trade_id", "ts_recv_ns", "copias")


_P5 = f"SELECT {SQL_SYMBOL} AS symbol, dt, trade_id, max(ts_recv_ns) AS ts_recv_ns{{}} FROM trades WHERE trade_id > 0 AND dt IS NOT NULL AND symbol IS NOT NULL GROUP BY ALL"
P5_FOUND_SQL = _P5.format("") + " HAVING count(*) > 1"
P5_SINGLE_SQL = _P5.format(", count(*) AS copias")


# ---- p6: late rows ---------------------------------------------------------------------------------------------------

WINDOW_NS, CORRECT_NS, CUT_NS = 300 * SECOND_NS, 30 * SECOND_NS, 600 * SECOND_NS

#: The second arrival batch of each day begins at this instant of it.
NOON_NS = 17 * 3600 * SECOND_NS


def five_minutes(spark: SparkSession, d: str) -> DataFrame:
    """Five-minute sums of both streams from two arrival batches: what came in the first half of each session, then the rest."""
    rows = None
    for name, ident in (("trades", "trade_id"), ("book_offer", "seq")):
        t = table(spark, d, name, "ts_ns", "ts_recv_ns", "symbol", "dt", ident, "quantidade")
        t = t.where(valid_ts(F.col("ts_ns"), F.col("dt"))).withColumnRenamed(ident, "ident").withColumn("fluxo", F.lit(name))
        rows = t if rows is None else rows.unionByName(t)
    store = LateAggregates(spark, work_folder(spark, "atrasos"), rows.schema, ["fluxo", "symbol"], ["fluxo", "symbol", "dt", "ident"], "dt", "ts_ns", "ts_recv_ns", WINDOW_NS, CORRECT_NS, CUT_NS, ["quantidade"])
    second = F.coalesce(F.col("ts_recv_ns") >= day_number(F.col("dt")) * F.lit(DAY_NS) + F.lit(NOON_NS), F.lit(False))
    store.merge("chegada/0", rows.where(~second), F.col("ident") > 0)
    store.merge("chegada/1", rows.where(second), F.col("ident") > 0)
    return store.read().withColumn("janela", F.expr(f"janela div {SECOND_NS}"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    marks = F.array_compact(F.array(F.when(F.col("n_corrigida") > 0, F.lit("corrigida")), F.when(F.col("n_cortada") > 0, F.lit("cortada"))))
    return five_minutes(spark, d).select("fluxo", "symbol", "janela", F.explode(marks).alias("situacao"))


def p6_sums(spark: SparkSession, d: str) -> DataFrame:
    return five_minutes(spark, d).select("fluxo", "symbol", "janela", "n", "n_corrigida", "n_cortada", "quantidade")


_P6_ROWS = f"""
WITH every AS (
  SELECT 'trades' AS fluxo, {SQL_SYMBOL} AS symbol, dt, trade_id AS id, ts_ns, ts_recv_ns, quantidade FROM trades WHERE {SQL_VALID}
  UNION ALL SELECT 'book_offer', {SQL_SYMBOL}, dt, seq, ts_ns, ts_recv_ns, quantidade FROM book_offer WHERE {SQL_VALID}),
single AS (
  SELECT fluxo, symbol, min({{'r': ts_recv_ns, 'e': ts_ns, 'q': quantidade}}) AS w FROM every WHERE id > 0 GROUP BY fluxo, symbol, dt, id
  UNION ALL SELECT fluxo, symbol, {{'r': ts_recv_ns, 'e': ts_ns, 'q': quantidade}} FROM every WHERE id IS NULL OR id <= 0),
timed AS (SELECT fluxo, symbol, w['e'] // 300000000000 * 300 AS janela, w['q'] AS q, coalesce(w['r'] - (w['e'] // 300000000000 + 1) * 300000000000, 0) AS late FROM single)"""
P6_SUMS_SQL = f"""{_P6_ROWS} SELECT fluxo, symbol, janela, count(*) FILTER (WHERE late <= 600000000000) AS n,
 count(*) FILTER (WHERE late > 30000000000 AND late <= 600000000000) AS n_corrigida, count(*) FILTER (WHERE late > 600000000000) AS n_cortada,
 (sum(q) FILTER (WHERE late <= 600000000000))::bigint AS quantidade FROM timed GROUP BY ALL"""
P6_FOUND_SQL = f"""{_P6_ROWS} SELECT DISTINCT fluxo, symbol, janela, CASE WHEN late > 600000000000 THEN 'cortada' ELSE 'corrigida' END AS situacao
 FROM timed WHERE late > 30000000000"""


QUERIES = {f.__name__: f for f in (p1_found, p1_series, p2_found, p2_depth, p4_found, p4_sizes, p5_found, p5_single, p6_found, p6_sums)}
ORACLES = {
    "p1_found": P1_FOUND_SQL,
    "p1_series": P1_SERIES_SQL,
    "p2_found": P2_FOUND_SQL,
    "p2_depth": P2_DEPTH_SQL,
    "p4_found": P4_FOUND_SQL,
    "p4_sizes": P4_SIZES_SQL,
    "p5_found": P5_FOUND_SQL,
    "p5_single": P5_SINGLE_SQL,
    "p6_found": P6_FOUND_SQL,
    "p6_sums": P6_SUMS_SQL,
}
