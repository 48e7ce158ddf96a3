"""Queries of the operators with a running state; SQL can express some of them, tests cover the others by brute force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions.similarity import fuzz_ratio
from quire.operators import books as K
from quire.operators import grouped as G
from quire.operators.benchmarks import check_rules
from quire.plans.fixtures import blocks, doc_lines, layout, lines_boxed, with_fixtures
from quire.plans.queries_rules import FIXTURES, books
from quire.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None, *fixtures: str):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_fixtures(sql, *fixtures) if fixtures else sql
        return f

    return keep


@_query("w3_rtl_reading_order")
def _w3(s, d):
    return G.rtl_reading_order(lines_boxed(s, d).withColumn("y0", F.col("y0") - F.col("line_idx") % 2 * 58).withColumn("y1", F.col("y1") - F.col("line_idx") % 2 * 58)).select("doc_id", "line_idx", "row", "new_pos")


@_query("w6_heading_levels")
def _w6(s, d):
    heads = blocks(s, d).where("block_type = 'SectionHeader'").select("doc_id", "pos", (F.col("y1") - F.col("y0")).alias("height"))
    return G.heading_levels(heads)


@_query(
    "w11_blockquotes",
    """, l AS (SELECT *, lag(pos) OVER w AS pp, lag(x0) OVER w AS ax0, lag(x1) OVER w AS ax1, lag(y1) OVER w AS ay1 FROM blocks WHERE block_type IN ('Text', 'ListItem') WINDOW w AS (PARTITION BY doc_id, page_id ORDER BY pos)),
m AS (SELECT *, coalesce(pos = pp + 1 AND x0 > ax0 + 0.1 * (ax1 - ax0) AND y0 > ay1, false) AS inn, coalesce(pos = pp + 1 AND abs(x0 - ax0) < 0.01 * (ax1 - ax0) AND abs(x1 - ax1) < 0.01 * (ax1 - ax0), false) AS al FROM l),
r AS (SELECT *, sum(CASE WHEN inn OR al THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, page_id ORDER BY pos) AS run FROM m)
SELECT doc_id, pos, CAST(sum(inn::INT) OVER (PARTITION BY doc_id, page_id, run ORDER BY pos) AS INT) AS level FROM r""",
    "blocks",
)
def _w11(s, d):
    return G.blockquotes(blocks(s, d).where("block_type in ('Text', 'ListItem')")).select("doc_id", "pos", "level")


@_query("w14_list_indent")
def _w14(s, d):
    return G.list_indent(blocks(s, d).where("block_type = 'ListItem'"), 612.0).select("doc_id", "pos", "level")


@_query(
    "j10_group_captions",
    """, k AS (SELECT *, block_type IN ('Table', 'Figure', 'Picture') AS ow, block_type IN ('Caption', 'Footnote') AS ca,
  coalesce(sqrt(greatest(0.0, x0 - lead(x1) OVER w, lead(x0) OVER w - x1) ** 2 + greatest(0.0, y0 - lead(y1) OVER w, lead(y0) OVER w - y1) ** 2) < 60, false) AS cl FROM blocks WINDOW w AS (PARTITION BY doc_id, page_id ORDER BY pos)),
t AS (SELECT *, lag(pos) OVER w AS bp, lead(pos) OVER w AS np, coalesce(lag(ca) OVER w AND lag(cl) OVER w, false) AND NOT coalesce(lag(ow, 2) OVER w AND lag(cl, 2) OVER w, false) AS tb, coalesce(lead(ca) OVER w, false) AND cl AS ta FROM k WINDOW w AS (PARTITION BY doc_id, page_id ORDER BY pos))
SELECT doc_id, page_id, pos, block_type || 'Group' AS block_type, concat_ws(',', CASE WHEN tb THEN bp END, pos, CASE WHEN ta THEN np END) AS members FROM t WHERE ow AND (tb OR ta)""",
    "blocks",
)
def _j10(s, d):
    return G.group_captions(blocks(s, d), 1200.0).select("doc_id", "page_id", "pos", "block_type", "members")


@_query("w17_merge_math_lines")
def _w17(s, d):
    li = lines_boxed(s, d).withColumns({"y0": F.expr("cast(40 + 60 * ((line_idx % 12) div 2) as double)"), "y1": F.expr("cast(50 + 60 * ((line_idx % 12) div 2) as double)")})
    return G.merge_math_lines(li).select("doc_id", "line_idx", "run", "math")


@_query("w21_lesson_numbers")
def _w21(s, d):
    return G.lesson_numbers(books(s, d, "lessons").selectExpr("package_id", "id", "pdf_start AS first_page", "cast(nullif(lesson_number % 30, 0) as int) AS printed"))


@_query("t29_fuzz_ratio")
def _t29(s, d):
    w = W.partitionBy("doc_id").orderBy("line_idx")
    li = doc_lines(s, d).withColumn("before", F.coalesce(F.lag("text").over(w), F.lit("")))
    return li.select("doc_id", "line_idx", F.round(fuzz_ratio("text", "before"), 4).alias("ratio"))


@_query(
    "r6_html_to_cells",
    """, c AS (SELECT doc_id, page_id, (line_idx % 12) // 3 AS r, line_idx % 3 AS c, regexp_replace(text, '[^a-zA-Z ]', '', 'g') AS text FROM doc_lines)
SELECT doc_id, page_id, CAST(r AS INT) AS row_id, c AS col_id, trim(text) AS text FROM c""",
    "doc_lines",
)
def _r6(s, d):
    """Tables written as html, then read back to cells."""
    cell = F.concat(F.lit("<td>"), F.regexp_replace("text", "[^a-zA-Z ]", ""), F.lit("</td>"))
    rows = doc_lines(s, d).selectExpr("*", "cast((line_idx % 12) div 3 as int) AS r").groupBy("doc_id", "page_id", "r").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_idx", cell.alias("c")))), lambda x: x["c"]), "").alias("tds"))
    pages = rows.groupBy("doc_id", "page_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "tds"))), lambda x: F.concat(F.lit("<tr>"), x["tds"], F.lit("</tr>"))), "").alias("trs"))
    html = F.concat(F.lit("<table>"), "trs", F.lit("</table>"))
    return pages.select("doc_id", "page_id", F.explode(G.html_to_cells(html)).alias("x")).select("doc_id", "page_id", "x.row_id", "x.col_id", "x.text")


@_query("j25_check_rules")
def _j25(s, d):
    """Every document against one benchmark passage, as a rule of one of four kinds: its text is there, isn't, its halves
    come in order, or the page isn't blank. One character in ten may differ."""
    items = table(s, d, "benchmark").select((F.row_number().over(W.orderBy("item_id")) - 1).alias("rank"), "item_id", "text")  # a small table by its nature
    n = items.count()
    docs = table(s, d, "documents")
    kind = F.element_at(F.array(*map(F.lit, ("present", "absent", "order", "baseline"))), (F.col("doc_id") % 4 + 1).cast("int"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    rules = docs.select("doc_id", (F.col("doc_id") % n).alias("rank")).join(items, "rank").select(
        "doc_id", "item_id", kind.alias("type"), "text", F.left("text", half).alias("before"), F.expr("substr(text, cast(floor(char_length(text) / 2) as int) + 1)").alias("after"),
        F.lit(None).cast("int").alias("first_n"), F.lit(None).cast("int").alias("last_n"), F.floor(F.char_length("text") / 10).alias("max_diffs"),
    )
    return check_rules(rules, docs.select("doc_id", F.col("text").alias("md")), "doc_id").select("doc_id", "item_id", "type", "passed", "reason")


def _packages(sql: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURES[n]})" for n in FIXTURES if n in sql) + "\n" + sql


#: Up to four tables a page: one tall table, a row of tables, or two stacked tables and two more in a second column.
_TABLES = """doc_id, page_id, pos, 700.0 AS page_height, 3 + pos % 7 AS n_rows, 2 + pos % 3 AS n_cols,
  CASE WHEN page_id % 4 < 2 THEN 50 WHEN page_id % 4 = 2 THEN 50 + 150 * (pos % 4) + (pos % 5) * 3 WHEN pos % 4 < 2 THEN 50 + (pos % 3) * 4 ELSE 285 + pos % 3 * 4 END + 0.0 AS x0,
  CASE WHEN page_id % 4 < 2 THEN 50 WHEN page_id % 4 = 2 THEN 100 + (pos % 3) * 8 ELSE 100 + 210 * (pos % 2) END + 0.0 AS y0,
  CASE WHEN page_id % 4 < 2 THEN 550 WHEN page_id % 4 = 2 THEN 190 + 150 * (pos % 4) + (pos % 5) * 3 WHEN pos % 4 < 2 THEN 250 + (pos % 3) * 4 ELSE 485 + pos % 3 * 4 + pos % 2 * 60 END + 0.0 AS x1,
  CASE WHEN page_id % 4 < 2 THEN 450 + pos * 37 % 200 WHEN page_id % 4 = 2 THEN 300 + (pos % 3) * 8 + (pos % 4) * 30 ELSE 305 + 210 * (pos % 2) END + 0.0 AS y1"""


@_query(
    "w18_table_merge_candidates",
    f""", tb AS (SELECT {_TABLES} FROM layout WHERE page_id % 4 > 1 OR pos % 4 = 0),
g AS (SELECT *, y1 - y0 AS h, x1 - x0 AS wd, count(*) OVER (PARTITION BY doc_id, page_id) AS n FROM tb),
p AS (SELECT *, lag(page_id) OVER w AS pp, lag(x0) OVER w AS px0, lag(y0) OVER w AS py0, lag(x1) OVER w AS px1, lag(y1) OVER w AS py1, lag(h) OVER w AS ph, lag(wd) OVER w AS pw, lag(n) OVER w AS pn,
  abs(lag(n_rows) OVER w - n_rows) < 5 AS rm, abs(lag(n_cols) OVER w - n_cols) < 2 AS cm FROM g WINDOW w AS (PARTITION BY doc_id ORDER BY page_id, pos)),
k AS (SELECT *, CASE WHEN pp = page_id - 1 AND greatest(ph, h) / page_height > 0.6 AND (n = 1 OR pn = 1) AND (rm OR cm) THEN 'page'
  WHEN pp = page_id AND ph / h > 0.75 AND ph / h < 1.25 AND abs(x0 - px1) < 20 AND abs(y0 - py0) < 20 AND rm THEN 'beside'
  WHEN pp = page_id AND pw / wd > 0.75 AND pw / wd < 1.25 AND abs(y0 - py1) < 10 AND abs(x0 - px0) < 10 AND cm THEN 'below'
  WHEN pp = page_id AND abs(x0 - px1) < 50 AND y0 < py1 AND wd * 0.75 < pw AND pw < wd * 1.25 AND cm THEN 'column' END AS how FROM p),
r AS (SELECT *, sum(CASE WHEN how IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY page_id, pos) AS run FROM k)
SELECT doc_id, min(pos) AS first_pos, count(*) AS n_tables, string_agg(coalesce(how, 'start'), ',' ORDER BY page_id, pos) AS how FROM r GROUP BY doc_id, run HAVING count(*) > 1""",
    "layout",
)
def _w18(s, d):
    """Runs of tables that go on in each other, by all four cases."""
    tables = layout(s, d).where("page_id % 4 > 1 OR pos % 4 = 0").selectExpr(*_split(_TABLES))
    runs = K.table_runs(K.table_merge_candidates(tables))
    return runs.select("doc_id", F.array_min(F.transform("tables", lambda t: t["pos"])).alias("first_pos"), F.col("n_tables").cast("long").alias("n_tables"), F.array_join(F.transform("tables", lambda t: F.coalesce(t["how"], F.lit("start"))), ",").alias("how"))


def _split(columns: str) -> list[str]:
    """Columns of a list, at the commas that end one."""
    return [c.strip() for c in columns.replace("\n", " ").replace(", ", ",").split(",")]
