"""Queries of contents lists and of tables from the text layer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions import text as X
from quire.operators import contents as K
from quire.operators import tables as T
from quire.plans.fixtures import doc_lines, lines_boxed, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
C = F.col


def _query(name: str, sql: str | None = None, *fixtures: str):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_fixtures(sql, *fixtures)
        return f

    return keep


@_query("c2_assign_numbers")
def _c2(s, d):
    """Every fourth line is an anchor, the two after it are numbers, some printed twice."""
    li = lines_boxed(s, d)
    return K.assign_numbers(li.where("line_idx % 4 = 0"), li.where("line_idx % 4 in (1, 2)").withColumn("value", F.length("text") % 7))


def spread(s, d) -> DataFrame:
    """Lines as a contents spread: a large number, a small one, and two fragments of a title."""
    kind = C("line_idx") % 4
    text = F.when(kind == 0, (C("line_idx") % 50 + 1).cast("string")).when(kind == 1, (C("line_idx") % 9 + 1).cast("string")).otherwise(F.concat(F.lit("فصل "), F.regexp_replace("text", r"\d", "")))
    return lines_boxed(s, d).withColumns({"text": text, "y1": C("y0") + F.when(kind == 0, 60.0).otherwise(10.0)})


@_query("c3_decorative_toc")
def _c3(s, d):
    li = spread(s, d)
    return K.decorative_toc(li, li.select("doc_id", F.lit(45).alias("page_count")).distinct())


def columns(s, d) -> DataFrame:
    """Lines as fragments of a contents page: two columns, two fragments to a row, a page number behind each odd one."""
    at = C("x0") + F.expr("line_idx div 2 % 2") * 300 + C("line_idx") % 2 * 110
    top = F.expr("cast(40 + 60 * (line_idx % 12 div 4) as double)")
    text = F.when(C("line_idx") % 2 == 0, F.concat(F.lit("... "), (C("line_idx") % 90).cast("string"))).otherwise(C("text"))
    return lines_boxed(s, d).withColumns({"text": text, "x0": at, "x1": at + 100, "y0": top, "y1": top + 10})


@_query("c4_contents_rows")
def _c4(s, d):
    return K.contents_rows(columns(s, d)).select("doc_id", "page_id", "row_id", "text", "title", "printed_page", "fragments", "x0", "y0", "x1", "y1")


_ORD = sorted(X.ordinals().items())
_ROWS = f""", r AS (SELECT doc_id, page_id, line_idx AS row_id, line_idx % 5 AS kind, line_idx, CASE WHEN line_idx % 3 = 0 THEN NULL ELSE line_idx + 1 END AS printed, x0 + line_idx % 2 * 300 AS x0, x1 + line_idx % 2 * 300 AS x1 FROM lines_boxed),
k AS (SELECT *, CASE kind WHEN 0 THEN 'درس' WHEN 3 THEN 'نگاره' WHEN 1 THEN CASE WHEN bool_or(kind = 0) OVER (PARTITION BY doc_id, page_id) THEN 'درس' END END AS word,
  CASE kind WHEN 0 THEN [{", ".join(str(n) for _, n in _ORD)}][line_idx * 7 % {len(_ORD)} + 1] WHEN 3 THEN line_idx % 100 END AS number FROM r),
fl AS (SELECT u.doc_id, u.row_id, min(f.row_id) AS fr
  FROM k u JOIN k f ON u.doc_id = f.doc_id AND u.page_id = f.page_id AND f.row_id > u.row_id AND least(u.x1, f.x1) > greatest(u.x0, f.x0) AND least(u.x1 - u.x0, f.x1 - f.x0) > 0
  AND (least(u.x1, f.x1) - greatest(u.x0, f.x0)) / least(u.x1 - u.x0, f.x1 - f.x0) >= 0.5 WHERE u.word IS NOT NULL AND u.printed IS NULL GROUP BY ALL),
lb AS (SELECT k.doc_id, k.page_id, k.row_id, k.word, k.number, coalesce(k.printed, CASE WHEN f.word IS NULL THEN f.printed END) AS printed FROM k LEFT JOIN fl ON fl.doc_id = k.doc_id AND fl.row_id = k.row_id LEFT JOIN k f ON f.doc_id = fl.doc_id AND f.row_id = fl.fr)
"""


def _rows(s, d) -> DataFrame:
    kind = C("line_idx") % 5
    bare = F.regexp_replace("text", r"\p{N}", "")
    ordinal = F.get(F.array(*[F.lit(w) for w, _ in _ORD]), (C("line_idx") * 7 % len(_ORD)).cast("int"))
    title = F.when(kind == 0, F.concat(F.lit("درس "), ordinal)).when(kind == 1, "درس آزاد").when(kind == 3, F.concat(F.lit("نگاره "), (C("line_idx") % 100).cast("string"), F.lit(" "), bare)).otherwise(bare)
    shift = C("line_idx") % 2 * 300
    return lines_boxed(s, d).select("doc_id", "page_id", C("line_idx").alias("row_id"), title.alias("title"), F.when(C("line_idx") % 3 != 0, C("line_idx") + 1).alias("printed_page"), (C("x0") + shift).alias("x0"), (C("x1") + shift).alias("x1"))


@_query("c5_label_units", _ROWS + "SELECT doc_id, page_id, row_id, word AS unit_word, number AS unit_index, printed AS printed_page FROM lb", "lines_boxed")
def _c5(s, d):
    return K.label_units(_rows(s, d)).select("doc_id", "page_id", "row_id", "unit_word", "unit_index", "printed_page")


@_query(
    "c6_plain_toc",
    _ROWS + """, pc AS (SELECT doc_id, count(*) * 2 AS pages FROM lines_boxed GROUP BY ALL),
un AS (SELECT lb.*, pages FROM lb JOIN pc USING (doc_id) WHERE word IS NOT NULL AND printed BETWEEN 1 AND pages),
ok AS (SELECT doc_id, page_id FROM un GROUP BY ALL HAVING count(*) >= 5 AND count(DISTINCT printed) >= 0.9 * count(*) AND max(printed) >= 0.4 * max(pages))
SELECT un.doc_id, un.page_id, row_id, printed AS printed_page, number, 'plain' AS toc_source FROM un JOIN ok USING (doc_id, page_id)""",
    "lines_boxed",
)
def _c6(s, d):
    """No book has a decorative list here, so the plain one counts."""
    rows = _rows(s, d)
    counts = rows.groupBy("doc_id").agg((F.count("*") * 2).alias("page_count"))
    toc = K.plain_toc(K.label_units(rows), counts)
    decorative = s.createDataFrame([], "doc_id long, page_id int, line_idx int, title string, printed_page long, number long")
    return K.choose_toc(decorative, toc).select("doc_id", "page_id", "row_id", "printed_page", "number", "toc_source")


# --- tables


@_query(
    "r1_table_tokens",
    r""", li AS (SELECT *, line_idx % 7 = 0 AS bare FROM lines_boxed),
ch AS (SELECT doc_id, page_id, line_idx, y0, y1, i AS k, cs[i] AS c, x0 + 10 * (i - 1) AS cx FROM (SELECT *, string_split(text, '') AS cs, unnest(range(1, length(text) + 1)) AS i FROM li WHERE NOT bare)),
ins AS (SELECT *, cx + 9.5 AS cx1 FROM ch WHERE c <> ' ' AND (cx + cx + 9.5) / 2 BETWEEN 60 AND 900 AND (y0 + y1) / 2 BETWEEN 0 AND 500),
fr AS (SELECT *, CASE WHEN cx - lag(cx1) OVER (PARTITION BY doc_id, line_idx ORDER BY k) <= 0.5 * greatest(y1 - y0, 1.0) THEN 0 ELSE 1 END AS f FROM ins),
tk AS (SELECT *, sum(f) OVER (PARTITION BY doc_id, line_idx ORDER BY k) AS token FROM fr),
w AS (SELECT doc_id, page_id, line_idx, token, string_agg(c, '' ORDER BY k) AS text, min(cx) AS x0, max(cx1) AS x1, min(y0) AS y0, min(y1) AS y1 FROM tk GROUP BY doc_id, page_id, line_idx, token
  UNION ALL SELECT doc_id, page_id, line_idx, 1, text, x0, x1, y0, y1 FROM li WHERE bare AND (x0 + x1) / 2 BETWEEN 60 AND 900 AND (y0 + y1) / 2 BETWEEN 0 AND 500),
t AS (SELECT *, regexp_replace(text, '^\s+|\s+$', '', 'g') AS word FROM w)
SELECT doc_id, page_id, line_idx, row_number() OVER (PARTITION BY doc_id, line_idx ORDER BY token) - 1 AS seq, word AS text, round(x0, 1) AS x0, round(x1, 1) AS x1, round(y0, 1) AS y0 FROM t WHERE word <> '' AND NOT regexp_matches(word, '^[.·•…_\-\s]+$')""",
    "lines_boxed",
)
def _r1(s, d):
    """Lines of characters without the spaces between them, every seventh without characters, and a table over part of each page."""
    li = lines_boxed(s, d)
    dealt = li.repartition("doc_id", "page_id")  # before the characters are made, which take many times the text's room
    char = lambda c, i: F.struct(c.alias("c"), (C("x0") + 10 * i).alias("x0"), C("y0").alias("y0"), (C("x0") + 10 * i + 9.5).alias("x1"), C("y1").alias("y1"))
    chars = F.filter(F.transform(F.split(F.when(C("line_idx") % 7 == 0, "").otherwise(C("text")), ""), char), lambda x: (x["c"] != " ") & (x["c"] != ""))
    span = F.struct(C("text"), C("x0"), C("y0"), C("x1"), C("y1"), chars.alias("chars"))
    wide = C("x1") + 10 * F.char_length("text")
    lines = dealt.select("doc_id", "page_id", "line_idx", "x0", "y0", wide.alias("x1"), "y1", F.array(span).alias("spans"))
    tables = li.select("doc_id", "page_id").distinct().select("*", F.lit(0).alias("pos"), F.lit(60.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(900.0).alias("x1"), F.lit(500.0).alias("y1"))
    return T.table_tokens(lines, tables).select("doc_id", "page_id", "line_idx", "seq", "text", "x0", "x1", "y0")


def word_tables(s, d) -> DataFrame:
    """A table a page from all its words, four to a row, with their lengths as numbers between."""
    words = doc_lines(s, d).select("doc_id", "page_id", "line_idx", F.array_remove(F.split("text", r"\s+"), "").alias("words")).where(F.size("words") > 0)
    fours = F.transform(F.sequence(F.lit(0), F.expr("(size(words) - 1) div 4").cast("int")), lambda k: F.slice("words", 4 * k + 1, 4))
    rows = words.select("doc_id", "page_id", F.lit(0).alias("pos"), "line_idx", F.posexplode(fours).alias("k", "four")).withColumn("line_idx", (C("line_idx") * 10000 + C("k")).cast("int"))
    row = F.dense_rank().over(W.partitionBy(*T.TABLE).orderBy("line_idx"))  # as the rows go to their tables
    top = rows.select(*T.TABLE, "line_idx", "four", (12.0 * row).alias("y0"))

    def token(seq: int, text: Column) -> Column:
        left = 72 + 70 * seq + F.char_length(text) % 3
        return F.struct(F.lit(seq).alias("seq"), text.alias("text"), left.cast("double").alias("x0"), (left + 4 * F.char_length(text)).cast("double").alias("x1"))

    word = lambda i: F.get("four", F.lit(i))
    eight = F.array(*[token(2 * i + j, text) for i in range(4) for j, text in enumerate((word(i), F.char_length(word(i)).cast("string")))])
    return top.select(*T.TABLE, "line_idx", "y0", F.slice(eight, 1, 2 * F.size("four")).alias("tokens"))


@_query("r3_reconstruct_table")
def _r3(s, d):
    return T.reconstruct_lines(word_tables(s, d)).select("doc_id", "page_id", F.md5("html").alias("html"), F.round("score", 6).alias("score"))
