"""Queries of the block, page and aggregation operators over the whole derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import aggregates as A
from quire.operators import blocks as B
from quire.operators import pages as P
from quire.plans.fixtures import blocks, doc_lines, layout, lines_boxed, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
KEY = ["doc_id", "page_id", "pos"]


def _query(name: str, sql: str | None = None, *fixtures: str):
    """Register a query with its DuckDB text, if it has one (after the fixtures it names)."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_fixtures(sql, *fixtures) if fixtures else sql
        return f

    return keep


@_query("f1_blocks_of_type", "SELECT doc_id, pos, block_type FROM blocks WHERE NOT removed AND block_type IN ('Table', 'Picture')", "blocks")
def _f1(s, d):
    return B.blocks_of_type(blocks(s, d), ["Table", "Picture"]).select("doc_id", "pos", "block_type")


@_query("f2_tables_only", "SELECT doc_id, block_id FROM blocks WHERE block_type IN ('Table', 'Form', 'TableOfContents')", "blocks")
def _f2(s, d):
    return B.tables_only(blocks(s, d)).select("doc_id", "block_id")


@_query(
    "f3_relabel_blocks",
    """SELECT doc_id, pos, CASE WHEN block_type = 'Table' AND conf / 100.0 <= 0.5 THEN 'Form' WHEN block_type = 'Caption' AND conf / 100.0 <= 0.3 THEN 'Text' ELSE block_type END AS block_type,
CASE WHEN (block_type = 'Table' AND conf / 100.0 <= 0.5) OR (block_type = 'Caption' AND conf / 100.0 <= 0.3) THEN 'heuristics' ELSE 'layout' END AS source FROM blocks""",
    "blocks",
)
def _f3(s, d):
    return B.relabel_blocks(blocks(s, d), "Table:Form:0.5,Caption:Text:0.3,bad:rule", F.col("conf") / 100).select("doc_id", "pos", "block_type", "source")


@_query("f4_visible_blocks", "SELECT doc_id, pos FROM blocks WHERE NOT removed AND block_type <> 'PageHeader'", "blocks")
def _f4(s, d):
    return B.visible_blocks(blocks(s, d), keep_footer=True).select("doc_id", "pos")


@_query("f5_usable_lines", "SELECT doc_id, line_idx FROM lines_boxed WHERE length(trim(text)) > 0 AND y1 - y0 >= 12", "lines_boxed")
def _f5(s, d):
    return B.usable_lines(lines_boxed(s, d), 12.0).select("doc_id", "line_idx")


@_query("f6_citable_blocks", "SELECT doc_id, pos FROM blocks WHERE block_type IN ('Text', 'SectionHeader', 'ListItem', 'Table', 'Caption', 'Footnote') AND length(trim(text)) > 0", "blocks")
def _f6(s, d):
    return B.citable_blocks(blocks(s, d)).select("doc_id", "pos")


@_query("f8_headers_first", "SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, page_id ORDER BY CASE block_type WHEN 'PageHeader' THEN 0 WHEN 'Footnote' THEN 2 ELSE 1 END, pos) - 1 AS new_pos FROM blocks", "blocks")
def _f8(s, d):
    return B.headers_first_footnotes_last(blocks(s, d)).select("doc_id", "pos", "new_pos")


@_query("f9_footnote_superscripts", r"SELECT doc_id, pos, regexp_matches(t, '^[0-9\W]+') AS superscript FROM (SELECT *, CASE WHEN pos % 2 = 0 THEN '1 ' || text ELSE 'x' || text END AS t FROM blocks WHERE block_type = 'Footnote')", "blocks")
def _f9(s, d):
    marked = blocks(s, d).withColumn("text", F.concat(F.when(F.col("pos") % 2 == 0, "1 ").otherwise("x"), F.col("text")))
    return B.footnote_marks(marked).select("doc_id", "pos", "superscript")


@_query(
    "f10_line_number_blocks",
    r"""SELECT doc_id, pos, len(w) >= 4 AND len(list_filter(w, lambda x: regexp_matches(x, '^[0-9]+$'))) > 0.6 * len(w) AND y1 - y0 > 4 AS ignored
FROM (SELECT *, list_filter(regexp_split_to_array(CASE WHEN pos % 3 = 0 THEN '1 2 3 4 5 6 ' || substr(text, 1, 9) ELSE text END, '\s+'), lambda x: x <> '') AS w FROM blocks)""",
    "blocks",
)
def _f10(s, d):
    b = blocks(s, d).withColumns({"text": F.when(F.col("pos") % 3 == 0, F.concat(F.lit("1 2 3 4 5 6 "), F.substring("text", 1, 9))).otherwise(F.col("text")), "x1": F.col("x0") + 4})
    return B.line_number_blocks(b).select("doc_id", "pos", "ignored")


@_query(
    "f11_model_queue",
    """SELECT doc_id, block_id, CASE WHEN block_type = 'Text' THEN 'handwriting' WHEN block_type = 'Table' THEN 'form' ELSE 'image' END AS task,
'{"id":"' || block_id || '","type":"' || block_type || '"}' AS request FROM blocks WHERE (block_type = 'Text' AND pos % 5 = 0) OR (block_type = 'Text' AND length(trim(text)) = 0) OR (block_type = 'Table' AND length(trim(text)) > 0 AND pos % 5 <> 0) OR block_type = 'Picture'""",
    "blocks",
)
def _f11(s, d):
    b = blocks(s, d).withColumn("text", F.when(F.col("pos") % 5 == 0, "").otherwise(F.col("text")))
    return B.model_queue(b, 792.0).select("doc_id", "block_id", "task", "request")


# --- windows


@_query(
    "w1_next_prev_block",
    """, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_id, pos) AS rn, CASE WHEN block_type NOT IN ('PageHeader', 'PageFooter') THEN block_id END AS seen FROM blocks)
SELECT doc_id, pos, first_value(seen IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_id,
last_value(seen IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_id FROM k""",
    "blocks",
)
def _w1(s, d):
    return B.neighbours(blocks(s, d), ["PageHeader", "PageFooter"]).select("doc_id", "pos", "next_id", "prev_id")


@_query(
    "w2_reading_order",
    """, c AS (SELECT *, CASE WHEN block_type <> 'Picture' THEN 1000 - (pos * 37) % 101 END AS ch FROM blocks),
a AS (SELECT *, coalesce(last_value(ch IGNORE NULLS) OVER (PARTITION BY doc_id, page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS at_ FROM c)
SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, page_id ORDER BY at_, pos) - 1 AS new_pos FROM a""",
    "blocks",
)
def _w2(s, d):
    first = F.when(F.col("block_type") != "Picture", 1000 - (F.col("pos") * 37) % 101)
    return B.reading_order(blocks(s, d), first).select("doc_id", "pos", "new_pos")


@_query("w4_ltr_line_order", "SELECT doc_id, line_idx, row_number() OVER (PARTITION BY doc_id, page_id ORDER BY round_even(y0 / 120, 0), x0, line_idx) - 1 AS new_pos FROM lines_boxed", "lines_boxed")
def _w4(s, d):
    return B.ltr_line_order(lines_boxed(s, d), 120.0).select("doc_id", "line_idx", "new_pos")


@_query(
    "w5_section_hierarchy",
    """, n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_id, pos) AS rn FROM blocks),
h AS (SELECT doc_id, pos, """
    + ", ".join(f"max(CASE WHEN heading_level = {i} THEN rn END) OVER w AS h{i}, max(CASE WHEN heading_level = {i} THEN rn * 100000 + pos END) OVER w AS p{i}" for i in range(1, 5))
    + """ FROM n WINDOW w AS (PARTITION BY doc_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT doc_id, pos, concat_ws(',', CASE WHEN h1 > 0 THEN '1:' || p1 % 100000 END, CASE WHEN h2 > coalesce(h1, 0) THEN '2:' || p2 % 100000 END,
CASE WHEN h3 > greatest(coalesce(h1, 0), coalesce(h2, 0)) THEN '3:' || p3 % 100000 END, CASE WHEN h4 > greatest(coalesce(h1, 0), coalesce(h2, 0), coalesce(h3, 0)) THEN '4:' || p4 % 100000 END) AS hierarchy FROM h""",
    "blocks",
)
def _w5(s, d):
    out = B.section_hierarchy(blocks(s, d), 4)
    each = F.transform(F.array_sort(F.map_entries("hierarchy")), lambda e: F.concat_ws(":", e["key"].cast("string"), F.element_at(F.split(e["value"], "/"), -1)))
    return out.select("doc_id", "pos", F.array_join(each, ",").alias("hierarchy"))


#: A document's running titles: the first block of a page says its source and, now and then, one letter less; the last one is a number with a word.
_RUNNING = """CASE WHEN line_idx % 12 = 0 AND page_id % 5 = 4 THEN concat(page_id, ' Notes on ', source, ' and othr matters')
  WHEN line_idx % 12 = 0 AND page_id % 7 <> 5 THEN concat(page_id, ' Notes on ', source, ' and other matters ', page_id) WHEN line_idx % 12 = 11 THEN concat(CASE WHEN page_id % 3 = 2 THEN 'pagge' ELSE 'page' END, ' of chapter ', page_id) ELSE text END"""
_CLEAN = r"regexp_replace(regexp_replace(trim(text), '^\d+\s*', ''), '\s*\d+$', '')"


def _running(s, d):
    return doc_lines(s, d).selectExpr("doc_id", "page_id", "line_idx AS pos", "'Text' AS block_type", f"{_RUNNING} AS text")


@_query(
    "w7_repeated_headers",
    rf""", e AS (SELECT doc_id, page_id, line_idx, min(line_idx) OVER w AS lo, max(line_idx) OVER w AS hi, {_CLEAN} AS clean FROM (SELECT * REPLACE ({_RUNNING} AS text) FROM doc_lines) WINDOW w AS (PARTITION BY doc_id, page_id)),
b AS (SELECT doc_id, page_id, clean, true AS at_top FROM e WHERE line_idx = lo UNION ALL SELECT doc_id, page_id, clean, false FROM e WHERE line_idx = hi),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, at_top ORDER BY page_id) - row_number() OVER (PARTITION BY doc_id, at_top, clean ORDER BY page_id) AS island, count(*) OVER (PARTITION BY doc_id, at_top) AS total FROM b),
g AS (SELECT *, count(*) OVER (PARTITION BY doc_id, at_top, clean) AS n, count(*) OVER (PARTITION BY doc_id, at_top, clean, island) AS streak FROM f)
SELECT doc_id, at_top, clean, max(n) AS n, max(streak) AS streak FROM g GROUP BY ALL HAVING max(n) > 3 AND (max(n) >= 0.2 * max(total) OR max(streak) >= 3)""",
    "doc_lines",
)
def _w7(s, d):
    """Common first and last texts of the pages of each document."""
    return B.repeated_headers(_running(s, d))


@_query("w7_ignored_headers")
def _w7i(s, d):
    """The blocks that are like a common text."""
    return B.ignored_headers(_running(s, d))


@_query(
    "w8_marginalia",
    """, m AS (SELECT *, block_type IN ('Text', 'SectionHeader', 'ListItem') AS t, (y1 - y0) <= 0.035 * 700 AND length(text) <= 90 AND (y1 <= 0.16 * 700 OR y0 >= 0.87 * 700) AS sm FROM blocks),
p AS (SELECT *, min(CASE WHEN t AND NOT (t AND sm) THEN y0 END) OVER w AS bt, max(CASE WHEN t AND NOT (t AND sm) THEN y1 END) OVER w AS bb, count(CASE WHEN t THEN 1 END) OVER w AS n FROM m WINDOW w AS (PARTITION BY doc_id, page_id))
SELECT doc_id, pos, coalesce(t AND sm AND n >= 2 AND (y1 <= bt OR y0 >= bb), false) AS ignored FROM p""",
    "blocks",
)
def _w8(s, d):
    return B.marginalia(blocks(s, d), 700.0, top=0.16, most_chars=90).select("doc_id", "pos", "ignored")


@_query("w9_document_toc", "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY page_id, pos) - 1 AS seq, trim(text) AS title, heading_level, page_id FROM blocks WHERE block_type = 'SectionHeader' AND NOT removed", "blocks")
def _w9(s, d):
    return B.document_toc(blocks(s, d)).select("doc_id", "seq", "title", "heading_level", "page_id")


_SPANS = """doc_id, page_id, cast(line_idx % 12 >= 6 as int) AS block, line_idx, length(text) + 3 AS n_chars,
  CASE WHEN page_id % 3 = 0 AND length(text) % 4 > 0 THEN concat(' ', line_idx, ' ') WHEN page_id % 3 = 1 AND line_idx % 12 < 6 AND length(text) % 3 > 0 THEN concat(line_idx, '') ELSE 'word' END AS first,
  CASE WHEN page_id % 3 = 2 AND line_idx % 12 >= 6 AND length(text) % 5 > 0 THEN concat(line_idx, ' ') ELSE 'word' END AS last"""


@_query(
    "w10_line_number_spans",
    rf""", sp AS (SELECT {_SPANS} FROM doc_lines), n AS (SELECT *, regexp_matches(first, '^\s*\d+\s*$') AS nf, regexp_matches(last, '^\s*\d+\s*$') AS nl FROM sp),
m AS (SELECT *, nf AND n_chars - length(trim(first)) > 10 AS df, nl AND n_chars - length(trim(last)) > 10 AS dl FROM n),
k AS (SELECT *, avg(nf::INT) OVER (PARTITION BY doc_id, page_id) AS pg, count(*) OVER b AS c, avg(df::INT) OVER b AS bf, avg(dl::INT) OVER b AS bl FROM m WINDOW b AS (PARTITION BY doc_id, page_id, block))
SELECT doc_id, line_idx, CASE WHEN nf AND pg > 0.6 THEN 'first' WHEN df AND c >= 4 AND bf > 0.6 THEN 'first' WHEN dl AND c >= 4 AND bl > 0.6 THEN 'last' END AS dropped FROM k""",
    "doc_lines",
)
def _w10(s, d):
    """Pages of two blocks of six lines: numbers before most lines of the page, of the first block, or behind those of the second."""
    spans = doc_lines(s, d).selectExpr("*", "cast(line_idx % 12 >= 6 as int) AS block", "length(text) + 3 AS n_chars").drop("source")
    spans = spans.selectExpr("doc_id", "page_id", "block", "line_idx", "n_chars", f"{_SPANS.split('n_chars,')[1].split(' AS first')[0]} AS first", f"{_SPANS.split('AS first,')[1].split(' AS last')[0]} AS last")
    return B.line_number_spans(spans).select("doc_id", "line_idx", "dropped")


#: Pages of four blocks of three lines in two columns; a block's last line is full, short or ends in a hyphen.
_COLUMNS = """cast(CASE WHEN line_idx % 12 < 6 THEN 60 ELSE 330 END + CASE WHEN line_idx % 3 = 0 AND length(text) % 4 = 0 THEN 12 ELSE 0 END as double) AS x0,
  cast(CASE WHEN line_idx % 12 < 6 THEN 290 ELSE 560 END - CASE WHEN line_idx % 3 = 2 AND length(text) % 3 = 0 THEN 80 ELSE 0 END as double) AS x1, cast(60 + 100 * (line_idx % 6) as double) AS y0, cast(80 + 100 * (line_idx % 6) as double) AS y1"""
_KIND = "CASE pos % 9 WHEN 5 THEN 'PageFooter' WHEN 7 THEN 'Picture' ELSE 'Text' END"


@_query(
    "w12_text_continuation",
    rf""", ln AS (SELECT doc_id, page_id, line_idx, line_idx // 3 AS pos, CASE WHEN length(text) % 5 = 0 THEN text || 'a-' ELSE text END AS text, {_COLUMNS} FROM doc_lines),
sh AS (SELECT doc_id, page_id, pos, count(*) AS n, floor(max(CASE WHEN x1 - x0 > 1 THEN x1 END)) AS reach, arg_max(x1, line_idx) AS lx, arg_max(text, line_idx) AS lt, arg_min(x0, line_idx) AS fx, ceil(min(x0)) AS lf, min(x0) AS x0, max(x1) AS x1, min(y0) AS y0, max(y1) AS y1 FROM ln GROUP BY ALL),
bk AS (SELECT *, {_KIND} AS kind, pos % 11 = 3 AS removed FROM sh WHERE {_KIND} <> 'PageFooter'),
nx AS (SELECT *, lead(page_id) OVER w AS np, lead(kind) OVER w AS nk, lead(removed) OVER w AS nr, lead(x0) OVER w AS nx0, lead(y0) OVER w AS ny0, lead(fx) OVER w AS nfx, lead(lf) OVER w AS nlf FROM bk WINDOW w AS (PARTITION BY doc_id ORDER BY page_id, pos))
SELECT doc_id, pos, coalesce(n >= 2 AND nk = 'Text' AND NOT nr AND CASE WHEN np = page_id THEN floor(ny0) <= ceil(y0) AND nx0 > x1 + 0.02 * (x1 - x0) ELSE nx0 < 306 AND ny0 < 350 END
  AND (lx >= reach OR regexp_matches(trim(lt), '[\p{{Ll}}|\p{{Nd}}][-—¬]\s?$')) AND nfx <= nlf, false) AS has_continuation FROM nx WHERE kind = 'Text'""",
    "doc_lines",
)
def _w12(s, d):
    text = F.when(F.length("text") % 5 == 0, F.concat("text", F.lit("a-"))).otherwise(F.col("text"))
    lines = doc_lines(s, d).selectExpr("doc_id", "page_id", "line_idx", "line_idx div 3 AS block", "text", _COLUMNS.split(" AS x0,")[0] + " AS x0", *[c.strip() for c in _COLUMNS.split("AS x0,")[1].split(", ")]).withColumn("text", text)
    found = lines.groupBy("doc_id", "page_id", F.col("block").alias("pos")).agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    found = found.selectExpr("*", f"{_KIND} AS block_type", "pos % 11 = 3 AS removed")
    return B.text_continuation(found, lines, 612.0, 700.0).select("doc_id", "pos", "has_continuation")


_W16 = """, l AS (SELECT *, lag(block_type) OVER w AS was, y0 - lag(y1) OVER w AS gap FROM blocks WINDOW w AS (PARTITION BY doc_id, page_id ORDER BY pos)),
r AS (SELECT *, sum(CASE WHEN block_type = 'ListItem' AND coalesce(was = 'ListItem', false) AND coalesce(gap, 0) < 0.1 * 792 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, page_id ORDER BY pos) AS run FROM l),
gl AS (SELECT doc_id, page_id, min(pos) AS first_pos, count(*) AS n_items, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, CASE WHEN count(*) > 1 THEN 'ListGroup' ELSE 'Text' END AS block_type
  FROM r WHERE block_type = 'ListItem' GROUP BY doc_id, page_id, run)
"""


@_query("w16_group_lists", _W16 + "SELECT doc_id, page_id, first_pos, n_items, block_type, x0, y0, x1, y1 FROM gl", "blocks")
def _w16(s, d):
    return B.group_lists(blocks(s, d), 792.0)


@_query(
    "w13_list_continuation",
    _W16 + """SELECT doc_id, page_id, first_pos, coalesce(block_type = 'ListGroup' AND lead(block_type) OVER w = 'ListGroup' AND (lead(page_id) OVER w > page_id OR lead(y0) OVER w < y0), false) AS has_continuation
FROM gl WINDOW w AS (PARTITION BY doc_id ORDER BY page_id, first_pos)""",
    "blocks",
)
def _w13(s, d):
    return B.list_continuation(B.group_lists(blocks(s, d), 792.0)).select("doc_id", "page_id", "first_pos", "has_continuation")


@_query(
    "w15_split_list_groups",
    """, m AS (SELECT *, CASE WHEN line_idx % 4 = 1 AND page_id % 3 > 0 THEN 1 ELSE 0 END AS st FROM lines_boxed),
i AS (SELECT *, sum(st) OVER (PARTITION BY doc_id, page_id ORDER BY line_idx) AS item, max(st) OVER (PARTITION BY doc_id, page_id) AS any_ FROM m)
SELECT doc_id, page_id, min(line_idx) AS first_line, count(*) AS n_lines, CASE WHEN max(any_) = 1 THEN 'ListItem' ELSE 'Text' END AS block_type, md5(string_agg(text, chr(10) ORDER BY line_idx)) AS text FROM i GROUP BY doc_id, page_id, item""",
    "lines_boxed",
)
def _w15(s, d):
    bullets = lines_boxed(s, d).withColumn("bulleted", F.concat(F.when((F.col("line_idx") % 4 == 1) & (F.col("page_id") % 3 > 0), "• x").otherwise("plain"), F.lit("")))
    out = B.split_list_groups(bullets, X.is_list_start(F.concat(F.split("bulleted", "x")[0], F.lit("y"))))
    return out.select("doc_id", "page_id", "first_line", "n_lines", "block_type", F.md5("text").alias("text"))


@_query(
    "w19_inline_math_blocks",
    """, t AS (SELECT *, length(text) % 7 = 0 AS flag, avg((length(text) % 7 = 0)::INT) OVER (PARTITION BY doc_id, page_id) AS share FROM blocks WHERE block_type IN ('Text', 'ListItem'))
SELECT doc_id, pos FROM t WHERE flag OR share > 0.3""",
    "blocks",
)
def _w19(s, d):
    return B.inline_math_blocks(blocks(s, d), F.length("text") % 7 == 0).select("doc_id", "pos")


@_query("o1_block_position_sort", "SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, page_id ORDER BY y0, x1 DESC, pos) - 1 AS new_pos FROM blocks", "blocks")
def _o1(s, d):
    return B.block_position_sort(blocks(s, d)).select("doc_id", "pos", "new_pos")


@_query(
    "o2_most_common_types",
    """, n AS (SELECT doc_id, block_type, count(*) AS n, min(pos) AS first_seen FROM blocks GROUP BY ALL)
SELECT doc_id, block_type, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first_seen, block_type) AS rank FROM n) WHERE rank <= 3""",
    "blocks",
)
def _o2(s, d):
    return A.top_by_count(blocks(s, d), ["doc_id"], "block_type", "pos", 3).select("doc_id", "block_type", "n", "rank")


# --- joins on the page

_AREA = "greatest(0.0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0.0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0))"
_LB = _AREA.format(a="l", b="b")


def _shifted(s, d):
    return lines_boxed(s, d).withColumns({"y0": F.col("y0") + F.when(F.col("line_idx") % 5 == 0, 35.0).otherwise(0.0), "y1": F.col("y1") + F.when(F.col("line_idx") % 5 == 0, 35.0).otherwise(0.0)})


_SHIFT = ", sh AS (SELECT doc_id, page_id, line_idx, text, x0, x1, y0 + CASE WHEN line_idx % 5 = 0 THEN 35.0 ELSE 0.0 END AS y0, y1 + CASE WHEN line_idx % 5 = 0 THEN 35.0 ELSE 0.0 END AS y1 FROM lines_boxed)\n"


@_query(
    "j1_assign_lines_to_blocks",
    _SHIFT
    + f""", j AS (SELECT l.doc_id, l.page_id, l.line_idx, b.pos, {_LB} AS area, sqrt(5 * ((l.x0 + l.x1 - b.x0 - b.x1) / 2) ** 2 + ((l.y0 + l.y1 - b.y0 - b.y1) / 2) ** 2) AS dist
  FROM sh l LEFT JOIN layout b ON l.doc_id = b.doc_id AND l.page_id = b.page_id AND b.pos % 3 <> 1),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line_idx ORDER BY CASE WHEN area > 0 THEN -area END NULLS LAST, pos) AS ra, row_number() OVER (PARTITION BY doc_id, line_idx ORDER BY dist NULLS LAST, pos) AS rd FROM j)
SELECT a.doc_id, a.line_idx, CASE WHEN a.area > 0 THEN a.pos WHEN b.dist < 20 THEN b.pos END AS pos, CASE WHEN a.area > 0 THEN 'overlap' WHEN b.dist < 20 THEN 'distance' ELSE 'orphan' END AS how
FROM r a JOIN r b ON a.doc_id = b.doc_id AND a.line_idx = b.line_idx AND a.ra = 1 AND b.rd = 1""",
    "lines_boxed", "layout",
)
def _j1(s, d):
    return P.assign_lines_to_blocks(_shifted(s, d), layout(s, d).where("pos % 3 <> 1")).select("doc_id", "line_idx", "pos", "how")


@_query(
    "j2_orphan_line_blocks",
    """, o AS (SELECT *, greatest(abs(x0 - lag(x0) OVER w), abs(y0 - lag(y1) OVER w)) AS far FROM lines_boxed WHERE line_idx % 4 <> 2 AND y1 - y0 > 1 WINDOW w AS (PARTITION BY doc_id, page_id ORDER BY line_idx)),
r AS (SELECT *, sum(CASE WHEN far <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, page_id ORDER BY line_idx) AS run FROM o)
SELECT doc_id, page_id, min(line_idx) AS first_line, count(*) AS n_lines, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM r GROUP BY doc_id, page_id, run""",
    "lines_boxed",
)
def _j2(s, d):
    return P.orphan_line_blocks(lines_boxed(s, d).where("line_idx % 4 <> 2"), 50.0).drop("run")


def _dropped_low(s, d):
    """Every line, those of an odd third of a page moved off it, so that their blocks have none."""
    return lines_boxed(s, d).withColumns({c: F.col(c) + F.when(F.expr("line_idx div 3") % 2 == 1, 2000.0).otherwise(0.0) for c in ("y0", "y1")})


@_query(
    "j3_line_coverage",
    f""", mv AS (SELECT doc_id, page_id, x0, x1, y0 + CASE WHEN line_idx // 3 % 2 = 1 THEN 2000.0 ELSE 0.0 END AS y0, y1 + CASE WHEN line_idx // 3 % 2 = 1 THEN 2000.0 ELSE 0.0 END AS y1 FROM lines_boxed),
c AS (SELECT b.doc_id, b.page_id, b.pos, coalesce(bool_or({_LB} > 0), false) AS hit FROM layout b LEFT JOIN mv l ON l.doc_id = b.doc_id AND l.page_id = b.page_id WHERE b.block_type <> 'Picture' GROUP BY ALL)
SELECT doc_id, page_id, count(*) FILTER (WHERE hit) AS covered, count(*) AS total, count(*) FILTER (WHERE hit) / count(*) >= 0.25 AS ok FROM c GROUP BY ALL""",
    "lines_boxed", "layout",
)
def _j3(s, d):
    return P.line_coverage(layout(s, d), _dropped_low(s, d), ["Picture"])


@_query(
    "j4_line_self_overlap",
    f""", t AS (SELECT doc_id, page_id, line_idx, x0, x1, y0, y0 + 10 * (1 + length(text) % 13) AS y1 FROM lines_boxed),
c AS (SELECT l.doc_id, l.page_id, l.line_idx, count(*) FILTER (WHERE {_LB} > 0.1) AS n FROM t l JOIN t b ON l.doc_id = b.doc_id AND l.page_id = b.page_id GROUP BY ALL)
SELECT doc_id, page_id, count(*) AS n_lines, count(*) FILTER (WHERE n > 2) AS n_bad, count(*) FILTER (WHERE n > 2) / count(*) <= 0.5 AS ok FROM c GROUP BY ALL""",
    "lines_boxed",
)
def _j4(s, d):
    return P.line_self_overlap(lines_boxed(s, d).withColumn("y1", F.col("y0") + 10 * (1 + F.length("text") % 13)))


@_query(
    "j5_choose_text_source",
    """, g AS (SELECT doc_id, page_id, count(*) AS n, max(length(text)) % 5 = 0 AS bad, min(length(text)) % 3 > 0 AS cov FROM lines_boxed GROUP BY ALL)
SELECT doc_id, page_id, CASE WHEN n > 0 AND NOT bad AND cov THEN 'embedded' ELSE 'ocr' END AS source FROM g""",
    "lines_boxed",
)
def _j5(s, d):
    g = lines_boxed(s, d).groupBy("doc_id", "page_id").agg(F.count("*").alias("n_lines"), (F.max(F.length("text")) % 5 == 0).alias("bad_text"), (F.min(F.length("text")) % 3 > 0).alias("coverage_ok"), F.lit(True).alias("overlap_ok"))
    return P.choose_text_source(g).select("doc_id", "page_id", "source")


@_query(
    "j7_refs_to_blocks",
    """, r AS (SELECT l.doc_id, l.line_idx, b.pos, row_number() OVER (PARTITION BY l.doc_id, l.line_idx ORDER BY sqrt((l.x1 - b.x0) ** 2 + (l.y1 - b.y0) ** 2), b.pos) AS rn FROM lines_boxed l JOIN layout b ON l.doc_id = b.doc_id AND l.page_id = b.page_id)
SELECT doc_id, line_idx AS ref, pos FROM r WHERE rn = 1""",
    "lines_boxed", "layout",
)
def _j7(s, d):
    refs = lines_boxed(s, d).selectExpr("doc_id", "page_id", "line_idx AS ref", "x1 AS x", "y1 AS y")
    return P.refs_to_blocks(refs, layout(s, d)).select("doc_id", "ref", "pos")


@_query(
    "j8_drop_contained_in_tables",
    f"""SELECT doc_id, line_idx FROM lines_boxed l WHERE NOT EXISTS (SELECT 1 FROM layout b WHERE l.doc_id = b.doc_id AND l.page_id = b.page_id AND b.pos % 2 = 0
AND CASE WHEN (l.x1 - l.x0) * (l.y1 - l.y0) = 0 THEN 0.0 ELSE {_LB} / ((l.x1 - l.x0) * (l.y1 - l.y0)) END > 0.95)""",
    "lines_boxed", "layout",
)
def _j8(s, d):
    return P.drop_contained_in_tables(lines_boxed(s, d), layout(s, d).where("pos % 2 = 0")).select("doc_id", "line_idx")


@_query(
    "j9_expand_layout_blocks",
    """, g AS (SELECT a.doc_id, a.page_id, a.pos, a.x0, a.y0, a.x1, a.y1, min(sqrt(greatest(0.0, a.x0 - b.x1, b.x0 - a.x1) ** 2 + greatest(0.0, a.y0 - b.y1, b.y0 - a.y1) ** 2)) AS gap
  FROM blocks a LEFT JOIN blocks b ON a.doc_id = b.doc_id AND a.page_id = b.page_id AND a.pos <> b.pos WHERE a.block_type = 'Picture' GROUP BY ALL),
e AS (SELECT *, least(coalesce(gap, (x1 - x0) * 0.05), (x1 - x0) * 0.05) AS dx, least(coalesce(gap, (y1 - y0) * 0.05), (y1 - y0) * 0.05) AS dy FROM g)
SELECT doc_id, pos, round(greatest(0.0, x0 - dx), 6) AS x0, round(greatest(0.0, y0 - dy), 6) AS y0, round(least(612.0, x1 + dx), 6) AS x1, round(least(792.0, y1 + dy), 6) AS y1 FROM e""",
    "blocks",
)
def _j9(s, d):
    return P.expand_layout_blocks(blocks(s, d), ["Picture"], (612.0, 792.0)).select("doc_id", "pos", *[F.round(c, 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


@_query(
    "j11_recover_lines",
    f""", c AS (SELECT l.doc_id, l.line_idx, max((l.x1 - l.x0) * (l.y1 - l.y0)) AS size, coalesce(sum({_LB}), 0.0) AS over_ FROM lines_boxed l LEFT JOIN layout b ON l.doc_id = b.doc_id AND l.page_id = b.page_id AND b.pos % 4 = 1 GROUP BY ALL)
SELECT doc_id, line_idx FROM c WHERE CASE WHEN size <= 0 THEN 0.0 ELSE least(1.0, over_ / size) END < 0.5""",
    "lines_boxed", "layout",
)
def _j11(s, d):
    return P.recover_lines(lines_boxed(s, d), layout(s, d).where("pos % 4 = 1")).select("doc_id", "line_idx")


@_query(
    "j12_hierarchy_asof",
    """SELECT l.doc_id, l.line_idx, (SELECT arg_max(b.block_id, b.y0 * 100000 + b.pos) FROM blocks b WHERE b.doc_id = l.doc_id AND b.page_id = l.page_id AND b.block_type = 'SectionHeader' AND b.y0 <= l.y0) AS heading FROM lines_boxed l""",
    "blocks",
)
def _j12(s, d):
    heads = blocks(s, d).where("block_type = 'SectionHeader'").withColumn("heading", F.col("block_id"))
    return P.last_before(lines_boxed(s, d), heads, "heading").select("doc_id", "line_idx", "heading")


@_query(
    "j15_nearest_caption",
    """, r AS (SELECT a.doc_id, a.pos, c.pos AS cp, row_number() OVER (PARTITION BY a.doc_id, a.pos ORDER BY CASE WHEN c.y0 >= a.y1 - 1 THEN 0 ELSE 1 END, abs(c.y0 - a.y1), c.pos) AS rn
  FROM blocks a LEFT JOIN blocks c ON a.doc_id = c.doc_id AND a.page_id = c.page_id AND c.block_type = 'Caption' WHERE a.block_type = 'Picture')
SELECT doc_id, pos, cp AS caption_pos FROM r WHERE rn = 1""",
    "blocks",
)
def _j15(s, d):
    b = blocks(s, d)
    return P.nearest_caption(b.where("block_type = 'Picture'"), b.where("block_type = 'Caption'")).select("doc_id", "pos", "caption_pos")


@_query(
    "j16_anchor_clusters",
    """, r AS (SELECT l.doc_id, l.line_idx, b.pos, row_number() OVER (PARTITION BY l.doc_id, l.line_idx ORDER BY sqrt(((l.x0 + l.x1 - b.x0 - b.x1) / 2) ** 2 + ((l.y0 + l.y1 - b.y0 - b.y1) / 2) ** 2), b.pos) AS rn FROM lines_boxed l JOIN layout b ON l.doc_id = b.doc_id AND l.page_id = b.page_id)
SELECT doc_id, line_idx, pos AS anchor_pos FROM r WHERE rn = 1""",
    "lines_boxed", "layout",
)
def _j16(s, d):
    return P.anchor_clusters(lines_boxed(s, d), layout(s, d)).select("doc_id", "line_idx", "anchor_pos")


@_query(
    "j17_apply_corrections",
    """, c AS (SELECT doc_id, block_id, CASE WHEN pos % 2 = 0 THEN 'New ' || text ELSE 'x' END AS html FROM blocks WHERE pos % 3 = 0)
SELECT b.doc_id, b.block_id, md5(CASE WHEN c.html IS NULL OR length(c.html) < 0.5 * length(b.text) THEN b.text ELSE c.html END) AS text, CASE WHEN length(c.html) < 0.5 * length(b.text) THEN 1 ELSE 0 END AS errors FROM blocks b LEFT JOIN c ON b.doc_id = c.doc_id AND b.block_id = c.block_id""",
    "blocks",
)
def _j17(s, d):
    b = blocks(s, d)
    fixes = b.where("pos % 3 = 0").select("doc_id", "block_id", F.when(F.col("pos") % 2 == 0, F.concat(F.lit("New "), "text")).otherwise("x").alias("html"))
    return P.apply_corrections(b, fixes).select("doc_id", "block_id", F.md5("text").alias("text"), "errors")


@_query(
    "j18_apply_reorder",
    """, o AS (SELECT doc_id, page_id, pos, 1000 - pos AS new_pos FROM blocks WHERE NOT (page_id % 2 = 1 AND pos % 12 = 5)),
h AS (SELECT doc_id, page_id, count(*) AS n FROM blocks GROUP BY ALL), w AS (SELECT doc_id, page_id, count(*) AS n FROM o GROUP BY ALL)
SELECT b.doc_id, b.pos, CASE WHEN h.n = w.n THEN o.new_pos ELSE b.pos END AS new_pos FROM blocks b JOIN h USING (doc_id, page_id) LEFT JOIN w USING (doc_id, page_id) LEFT JOIN o ON b.doc_id = o.doc_id AND b.pos = o.pos""",
    "blocks",
)
def _j18(s, d):
    b = blocks(s, d)
    order = b.where("not (page_id % 2 = 1 and pos % 12 = 5)").selectExpr("doc_id", "page_id", "pos", "1000 - pos AS new_pos")
    return P.apply_reorder(b, order).select("doc_id", "pos", "new_pos")


# --- aggregations


@_query(
    "a1_page_stats",
    """, k AS (SELECT doc_id, page_id, block_type, count(*) AS n, min(pos) AS f FROM blocks WHERE NOT removed GROUP BY ALL)
SELECT doc_id, page_id, string_agg(block_type || '=' || n, ',' ORDER BY n DESC, f, block_type) AS block_counts, CAST(sum(n) AS BIGINT) AS n_blocks FROM k GROUP BY ALL""",
    "blocks",
)
def _a1(s, d):
    return A.page_stats(blocks(s, d))


@_query("a3_raw_text", "SELECT doc_id, page_id, md5(string_agg(text || chr(10), '' ORDER BY line_idx)) AS text FROM doc_lines GROUP BY ALL", "doc_lines")
def _a3(s, d):
    return A.raw_text(doc_lines(s, d)).select("doc_id", "page_id", F.md5("text").alias("text"))


@_query("a4_single_char_span_ratio", "SELECT doc_id, page_id, round(CASE WHEN sum(length(text)) > 0 THEN sum(length(text) % 5) / sum(length(text)) ELSE 0.0 END, 9) AS ratio FROM doc_lines GROUP BY ALL", "doc_lines")
def _a4(s, d):
    return A.ratio_of_sums(doc_lines(s, d), ["doc_id", "page_id"], F.length("text") % 5, F.length("text"), "ratio").withColumn("ratio", F.round("ratio", 9))


#: Folios in footers, in Persian digits in short blocks at the bottom, and numbers that can't be one.
_FOLIO = """CASE WHEN pos % 12 = 11 AND page_id % 3 = 0 THEN concat(' ', page_id + 1 + doc_id % 5) WHEN pos % 12 = 11 AND page_id % 3 = 1 THEN 'x'
  WHEN pos % 12 = 10 AND page_id % 3 = 1 THEN translate(concat(page_id + 1 + doc_id % 5 - length(text) % 2, ''), '0123456789', '۰۱۲۳۴۵۶۷۸۹') WHEN pos % 12 = 10 AND page_id % 3 = 2 THEN '501' WHEN pos % 12 = 2 THEN '7' ELSE text END"""


@_query(
    "a6_page_offset",
    rf""", c AS (SELECT *, translate(trim({_FOLIO}), '۰۱۲۳۴۵۶۷۸۹', '0123456789') AS t FROM blocks),
f AS (SELECT doc_id, page_id, arg_min(t::INT, pos) AS folio FROM c WHERE regexp_matches(t, '^[0-9]+$') AND length(t) BETWEEN 1 AND 4 AND (block_type = 'PageFooter' OR y0 >= 0.85 * 740) AND CASE WHEN regexp_matches(t, '^[0-9]{{1,4}}$') THEN t::INT ELSE 0 END BETWEEN 1 AND 500 GROUP BY ALL),
v AS (SELECT doc_id, page_id + 1 - folio AS sh, count(*) AS n, min(page_id) AS first FROM f GROUP BY ALL),
b AS (SELECT doc_id, sh, n, sum(n) OVER (PARTITION BY doc_id) AS samples FROM v QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) = 1),
p AS (SELECT DISTINCT doc_id, page_id FROM blocks)
SELECT p.doc_id, p.page_id, coalesce(folio, p.page_id + 1 - sh) AS printed_page, CASE WHEN folio IS NOT NULL THEN 'page_footer' WHEN sh IS NOT NULL THEN 'inferred_from_offset' END AS printed_source, sh AS page_offset, CAST(coalesce(samples, 0) AS BIGINT) AS samples, round(n / samples, 4) AS agreement
FROM p LEFT JOIN f ON p.doc_id = f.doc_id AND p.page_id = f.page_id LEFT JOIN b ON p.doc_id = b.doc_id""",
    "blocks",
)
def _a6(s, d):
    found = blocks(s, d).selectExpr("* EXCEPT (text)", f"{_FOLIO} AS text")
    pages = blocks(s, d).select("doc_id", "page_id").distinct().selectExpr("*", "0.0 AS top", "740.0 AS bottom")
    return A.page_map(found, pages)


@_query(
    "a8_material_profile",
    """, m AS (SELECT doc_id, count(DISTINCT page_id) AS pages, count(*) FILTER (WHERE block_type = 'Picture') AS images, CAST(sum(CASE WHEN block_type NOT IN ('Picture', 'PageHeader', 'PageFooter') THEN length(text) ELSE 0 END) AS BIGINT) AS text_chars,
  count(*) FILTER (WHERE block_type NOT IN ('Picture', 'PageHeader', 'PageFooter')) AS text_blocks, count(*) FILTER (WHERE block_type = 'SectionHeader') AS headings FROM blocks GROUP BY ALL)
SELECT *, CASE WHEN text_chars <= 1000 THEN 'low' WHEN text_chars >= 2500 THEN 'high' ELSE 'medium' END AS density FROM m""",
    "blocks",
)
def _a8(s, d):
    return A.material_profile(blocks(s, d), ["doc_id"])


@_query(
    "a9_table_shape",
    """, c AS (SELECT doc_id, page_id, line_idx // 3 AS row_id, line_idx % 3 AS col_id, 1 + (length(text) % 11 = 0)::INT AS rowspan, 1 + (length(text) % 7 = 0)::INT AS colspan FROM doc_lines),
dn AS (SELECT doc_id, page_id, max(r) AS n_rows FROM (SELECT doc_id, page_id, col_id, sum(rowspan) AS r FROM c GROUP BY ALL) GROUP BY ALL),
ac AS (SELECT doc_id, page_id, max(r) AS n_cols FROM (SELECT doc_id, page_id, row_id, sum(colspan) AS r FROM c GROUP BY ALL) GROUP BY ALL)
SELECT doc_id, page_id, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_cols AS BIGINT) AS n_cols FROM dn JOIN ac USING (doc_id, page_id)""",
    "doc_lines",
)
def _a9(s, d):
    cells = doc_lines(s, d).selectExpr("doc_id", "page_id", "line_idx div 3 AS row_id", "line_idx % 3 AS col_id", "1 + cast(length(text) % 11 = 0 as int) AS rowspan", "1 + cast(length(text) % 7 = 0 as int) AS colspan")
    return A.table_shape(cells, ["doc_id", "page_id"])


@_query(
    "a11_validation_report",
    """, f AS (SELECT CASE WHEN removed THEN 'error' WHEN conf < 30 THEN 'warning' ELSE 'review' END AS severity, block_type AS code FROM blocks)
SELECT severity, code, count(*) AS n FROM f GROUP BY ROLLUP (severity, code)""",
    "blocks",
)
def _a11(s, d):
    return A.findings_report(blocks(s, d).selectExpr("CASE WHEN removed THEN 'error' WHEN conf < 30 THEN 'warning' ELSE 'review' END AS severity", "block_type AS code"))


@_query(
    "a12_bench_summary",
    """, p AS (SELECT block_type AS category, avg((conf >= 40)::INT) AS score, count(*) AS tests FROM blocks GROUP BY ALL),
u AS (SELECT * FROM p UNION ALL SELECT 'overall', avg(score), sum(tests) FROM p UNION ALL SELECT 'digital', avg(score), sum(tests) FROM p WHERE category NOT IN ('Picture', 'Table'))
SELECT category, round(score, 9) AS score, CAST(tests AS BIGINT) AS tests FROM u""",
    "blocks",
)
def _a12(s, d):
    return A.bench_summary(blocks(s, d).select(F.col("block_type").alias("category"), (F.col("conf") >= 40).alias("passed")), ["Picture", "Table"]).withColumn("score", F.round("score", 9))


@_query(
    "a13_throughput",
    """SELECT source, count(*) AS pages, count(CASE WHEN removed THEN 'x' END) AS errors, round(count(*) * 1000 / CAST(sum(1 + conf) AS DOUBLE), 6) AS pages_per_s, round(CAST(sum(1 + conf) AS DOUBLE) / count(*), 6) AS ms_per_page FROM blocks GROUP BY ALL""",
    "blocks",
)
def _a13(s, d):
    runs = blocks(s, d).select("source", (1.0 + F.col("conf")).alias("latency_ms"), F.when(F.col("removed"), "x").alias("error"))
    return A.throughput(runs, ["source"])
