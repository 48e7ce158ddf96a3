"""Queries of the renderers over a tree of blocks, three to four levels deep, and over web pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.markup import clean_table_html, html_to_markdown
from quire.operators import render as M
from quire.plans.fixtures import blocks, with_fixtures
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


def tree(s: SparkSession, d: str) -> DataFrame:
    """Blocks with lines of eight words, each of two spans; the list items of a page's stretch lie in one group.

    Some blocks go on in the next, are quotes, lie indented, hold own markup or an image.
    """
    b = blocks(s, d).selectExpr("*", "concat('/page/', page_id, '/ListGroup/', pos div 11) AS group_id", "split(text, ' ') AS words")
    item = F.col("block_type") == "ListItem"
    top = b.select(
        "doc_id", "page_id", "block_id", F.when(item, F.col("group_id")).alias("parent_id"), F.when(item, 2).otherwise(1).alias("depth"), "pos", "block_type", "text",
        F.when(F.col("block_type") == "Table", F.concat(F.lit("<table><tr><td>"), M.escape_html(F.col("text")), F.lit("</td></tr></table>"))).alias("html"),
        F.col("heading_level").cast("int").alias("heading_level"), ((F.col("block_type") == "Text") & (F.col("conf") % 5 == 0)).alias("has_continuation"), (F.col("conf") % 7 == 0).cast("int").alias("quote_level"),
        F.when(item, F.col("conf") % 2).cast("int").alias("indent_level"), F.when(F.col("block_type") == "Picture", F.base64(F.encode(F.col("block_id"), "UTF-8"))).alias("image"), "removed", "x0", "y0", "x1", "y1",
    )
    groups = b.where(item & ~F.col("removed")).groupBy("doc_id", "page_id", "group_id").agg(F.min("pos").alias("pos"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    groups = groups.select("doc_id", "page_id", F.col("group_id").alias("block_id"), F.lit(1).alias("depth"), "pos", F.lit("ListGroup").alias("block_type"), "x0", "y0", "x1", "y1")
    lined = b.where(~F.col("block_type").isin("Table", "Picture"))
    lines = lined.select("doc_id", "page_id", F.col("block_id").alias("parent_id"), F.when(item, 3).otherwise(2).alias("depth"), "pos", F.explode(F.expr("sequence(0, (size(words) - 1) div 8)")).alias("k"), "words")
    lines = lines.select("doc_id", "page_id", "parent_id", "depth", F.col("pos").alias("of"), F.col("k").alias("pos"), F.concat("parent_id", F.lit("/"), "k").alias("block_id"), F.expr("slice(words, k * 8 + 1, 8)").alias("w"))
    spans = lines.select("doc_id", "page_id", F.col("block_id").alias("parent_id"), (F.col("depth") + 1).alias("depth"), F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"), "of", "w", F.col("block_id").alias("line"))
    spans = spans.where("pos = 0 or size(w) > 1").select(
        "doc_id", "page_id", F.concat("line", F.lit("."), "pos").alias("block_id"), "parent_id", "depth", "pos", F.lit("Span").alias("block_type"),
        F.when(F.col("pos") == 0, F.concat(F.get("w", F.lit(0)), F.when(F.size("w") > 1, F.lit(" ")).otherwise(""))).otherwise(F.array_join(F.expr("slice(w, 2, 7)"), " ")).alias("text"),
        F.when(F.col("pos") == 0, F.when(F.col("of") % 3 == 0, F.array(F.lit("bold"))).when(F.col("of") % 3 == 1, F.array(F.lit("italic")))).alias("formats"),
    )
    lines = lines.select("doc_id", "page_id", "block_id", "parent_id", "depth", "pos", F.lit("Line").alias("block_type"), F.array_join("w", " ").alias("text"))
    return top.unionByName(groups, allowMissingColumns=True).unionByName(lines, allowMissingColumns=True).unionByName(spans, allowMissingColumns=True)


def _esc(x: str) -> str:
    return f"""replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')"""


#: Spans, lines, blocks, groups and pages, each level from the one below.
_TREE = rf""", bt AS (SELECT *, string_split(text, ' ') AS words, '/page/' || page_id || '/ListGroup/' || (pos // 11) AS group_id FROM blocks WHERE NOT removed),
ls AS (SELECT doc_id, page_id, block_id, pos AS of_, k, words[k * 8 + 1 : k * 8 + 8] AS w FROM (SELECT *, unnest(range(0, (len(words) - 1) // 8 + 1)) AS k FROM bt WHERE block_type NOT IN ('Table', 'Picture'))),
lt AS (SELECT *, trim(array_to_string(w, ' '), E' \t\n\r\x0b\x0c') AS raw, lead(array_to_string(w, ' ')) OVER (PARTITION BY doc_id, block_id ORDER BY k) AS after, CASE of_ % 3 WHEN 0 THEN 'b' WHEN 1 THEN 'i' END AS tag, w[1] || CASE WHEN len(w) > 1 THEN ' ' ELSE '' END AS w1 FROM ls),
lh AS (SELECT *, CASE WHEN tag IS NULL THEN {_esc('w1')} ELSE '<' || tag || '>' || {_esc('w1')} || '</' || tag || '>' END || {_esc("array_to_string(w[2:8], ' ')")} AS h FROM lt),
le AS (SELECT *, CASE WHEN after IS NULL THEN trim(h, ' ') WHEN regexp_matches(raw, '[\p{{Ll}}0-9][-—¬]$', 's') AND regexp_matches(after, '^\s*\p{{Ll}}') THEN regexp_replace(h, '[-—¬](\s*(</[a-z]+>)*\s*)$', '\1') ELSE h || chr(10) END AS line FROM lh),
bl AS (SELECT doc_id, block_id, string_agg(line, '' ORDER BY k) AS content FROM le GROUP BY ALL),
bh AS (SELECT bt.*, replace(coalesce(content, ''), chr(10), ' ') AS flat, coalesce(content, '') AS content,
  ' block-type=''' || block_type || '''' AS named, CASE WHEN block_type = 'Text' AND conf % 5 = 0 THEN ' class=''has-continuation''' ELSE '' END AS goes_on FROM bt LEFT JOIN bl USING (doc_id, block_id)),
bm AS (SELECT *, CASE block_type WHEN 'PageHeader' THEN '' WHEN 'PageFooter' THEN ''
  WHEN 'Table' THEN '<table><tr><td>' || {_esc('text')} || '</td></tr></table>' WHEN 'Picture' THEN '<p><img src=''' || replace(block_id, '/', '_') || '.jpeg''></p>'
  WHEN 'SectionHeader' THEN '<h' || heading_level || '>' || flat || '</h' || heading_level || '>' WHEN 'Caption' THEN '<p>' || content || '</p>' WHEN 'Footnote' THEN '<p>' || content || '</p>'
  WHEN 'ListItem' THEN CASE WHEN conf % 2 = 1 THEN '<ul><li' || named || ' class=''list-indent-1''>' ELSE '<li' || named || '>' END || regexp_replace(flat, '(^|[\n ]|<[^>]*>)[•●○ഠം◦■▪▫–—-]( )', '\1\2', 'g') || CASE WHEN conf % 2 = 1 THEN '</li></ul>' ELSE '</li>' END
  ELSE CASE WHEN conf % 7 = 0 THEN '<blockquote>' ELSE '' END || '<p' || named || goes_on || '>' || flat || '</p>' || CASE WHEN conf % 7 = 0 THEN '</blockquote>' ELSE '' END END AS html FROM bh),
tp AS (SELECT doc_id, page_id, block_id, pos, block_type, heading_level, html, html AS holes, x0, y0, x1, y1, NULL AS kids FROM bm WHERE block_type <> 'ListItem'
  UNION ALL SELECT doc_id, page_id, group_id, min(pos), 'ListGroup', NULL, '<p block-type=''ListGroup''><ul>' || string_agg(html, '' ORDER BY pos) || '</ul></p>',
    '<p block-type=''ListGroup''><ul>' || string_agg('<content-ref src=''' || block_id || '''></content-ref>', '' ORDER BY pos) || '</ul></p>', min(x0), min(y0), max(x1), max(y1), string_agg(block_id || '=' || md5(html), ';' ORDER BY pos)
  FROM bm WHERE block_type = 'ListItem' GROUP BY doc_id, page_id, group_id),
pages_ AS (SELECT DISTINCT doc_id, page_id FROM blocks),
pg AS (SELECT p.doc_id, p.page_id, coalesce(string_agg(html, '' ORDER BY pos, block_id), '') AS html FROM pages_ p LEFT JOIN tp ON p.doc_id = tp.doc_id AND p.page_id = tp.page_id GROUP BY ALL)
"""
_MERGE = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '</b><b>', '', 'g'), '</b>\s+<b>', ' ', 'g'), '</i><i>', '', 'g'), '</i>\s+<i>', ' ', 'g')"
_SHELL = "'<!DOCTYPE html>' || chr(10) || '<html>' || chr(10) || '<head>' || chr(10) || '<meta charset=\"utf-8\" />' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10) || {0} || chr(10) || '</body>' || chr(10) || '</html>' || chr(10)"


@_query(
    "m1_render_html",
    _TREE + f""", dc AS (SELECT doc_id, string_agg('<div class=''page'' data-page-id=''' || page_id || '''>' || html || '</div>', '' ORDER BY page_id) AS html FROM pg GROUP BY 1)
SELECT doc_id, md5({_SHELL.format(_MERGE.format('html'))}) AS html FROM dc""",
    "blocks",
)
def _m1(s, d):
    pages = blocks(s, d).select("doc_id", "page_id").distinct()
    return M.render_html(tree(s, d), paginate=True, pages=pages).select("doc_id", F.md5("html").alias("html"))


@_query("m2_block_html", _TREE + "SELECT doc_id, block_id, block_type, md5(html) AS html FROM tp", "blocks")
def _m2(s, d):
    return M.assemble(tree(s, d)).select("doc_id", "block_id", "block_type", F.md5("html").alias("html"))


#: Markdown of a page's blocks straight from their words: no markup is read. Inline marks hold where a word carries them.
_MD = rf""", lm AS (SELECT *, regexp_replace(array_to_string(w, ' '), '([*_$])', '\\\1', 'g') AS plain, regexp_replace(w1, '([*_$])', '\\\1', 'g') AS first, regexp_replace(array_to_string(w[2:8], ' '), '([*_$])', '\\\1', 'g') AS rest FROM lt)
"""


@_query(
    "m3_render_markdown",
    _TREE + r""", pt AS (SELECT doc_id, page_id, block_id, block_type, heading_level, regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([*_$])', '\\\1', 'g') AS md FROM blocks
  WHERE NOT removed AND block_type IN ('SectionHeader', 'Caption', 'Footnote'))
SELECT doc_id, block_id, md5(CASE WHEN block_type = 'SectionHeader' THEN CASE WHEN md = '' THEN '' ELSE repeat('#', heading_level::INT) || ' ' || md END ELSE md END) AS markdown FROM pt""",
    "blocks",
)
def _m3(s, d):
    """Headings, captions and footnotes as documents of their own, so that SQL can follow; spans carry no format here."""
    plain = tree(s, d).withColumn("formats", F.lit(None).cast("array<string>"))
    tops = M.assemble(plain).where("block_type in ('SectionHeader', 'Caption', 'Footnote')")
    return tops.select("doc_id", "block_id", F.md5(html_to_markdown(F.col("html"))).alias("markdown"))


@_query("m3_document_markdown")
def _m3d(s, d):
    """Whole documents from their trees."""
    return M.render_markdown(tree(s, d)).select("doc_id", "markdown")


@_query("m3_page_markdown")
def _m3p(s, d):
    """Raw web pages, broken markup included."""
    return table(s, d, "pages").select("page_id", html_to_markdown(F.col("html")).alias("markdown"))


#: White space as a converter in Python sees it.
_SPACE = r"[\p{Z}\t-\r\x1c-\x1f\x{85}]+"


def _inline_md(x: str) -> str:
    """Markdown of bold, italic and text: spaces single, marks at the words, entities read."""
    x = rf"regexp_replace(regexp_replace({x}, '{_SPACE}', ' ', 'g'), '([*_$])', '\\\1', 'g')"
    for tag, mark in (("b", "**"), ("i", "*")):
        x = rf"regexp_replace(regexp_replace({x}, '<{tag}>( ?)</{tag}>', '\1', 'g'), '<{tag}>( ?)([^<]*?)( ?)</{tag}>', '\1{mark}\2{mark}\3', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return f"trim({x}, ' ')"


_BULLETS = r"regexp_replace(flat, '(^|[\n ]|<[^>]*>)[•●○ഠം◦■▪▫–—-]( )', '\1\2', 'g')"

#: Each page's rule and what its blocks give, in order; a paragraph that goes on is followed at once by one that comes next.
_PAGED = rf""", im AS (SELECT *, {_inline_md(_MERGE.format(f"CASE WHEN block_type = 'ListItem' THEN {_BULLETS} ELSE flat END"))} AS md, block_type = 'Text' AND conf % 5 = 0 AS on_,
  replace(regexp_replace(translate(text, E'|\n', '  '), '^{_SPACE}|{_SPACE}$', '', 'g'), '$', '\$') AS cell FROM bm),
it AS (SELECT *, CASE WHEN lag(pos) OVER g IS NULL THEN '' WHEN conf % 2 = 1 OR lag(conf) OVER g % 2 = 1 THEN chr(10) || chr(10) ELSE chr(10) END || rtrim('- ' || md, ' ') AS item FROM im WHERE block_type = 'ListItem' WINDOW g AS (PARTITION BY doc_id, page_id, group_id ORDER BY pos)),
pc AS (SELECT doc_id, page_id, -1 AS pos, '' AS block_id, '{{' || page_id || '}}' || repeat('-', 48) AS md, false AS on_, false AS para FROM pages_
  UNION ALL SELECT doc_id, page_id, min(pos), group_id, string_agg(item, '' ORDER BY pos), false, true FROM it GROUP BY doc_id, page_id, group_id
  UNION ALL SELECT doc_id, page_id, pos, block_id, CASE WHEN block_type IN ('PageHeader', 'PageFooter') THEN '' WHEN block_type = 'Picture' THEN '![](' || replace(block_id, '/', '_') || '.jpeg)'
    WHEN block_type = 'Table' THEN CASE WHEN cell = '' THEN '|--|' ELSE '| ' || cell || ' |' || repeat(chr(10) || '|' || repeat('-', length(cell) + 2) || '|', 2) END
    WHEN md = '' THEN '' WHEN block_type = 'SectionHeader' THEN repeat('#', heading_level::INT) || ' ' || regexp_replace(md, ' +', ' ', 'g')
    ELSE CASE WHEN block_type = 'Text' AND conf % 7 = 0 THEN '> ' ELSE '' END || CASE WHEN NOT on_ THEN md WHEN regexp_matches(md, '[\p{{Ll}}\p{{Nd}}|][-—¬]$') THEN left(md, -1) ELSE md || ' ' END END,
    on_, block_type = 'Picture' OR block_type IN ('Text', 'Caption', 'Footnote') AND NOT (block_type = 'Text' AND conf % 7 = 0) FROM im WHERE block_type <> 'ListItem'),
sq AS (SELECT *, lead(para) OVER (PARTITION BY doc_id ORDER BY page_id, pos, block_id) AS next_para FROM pc WHERE md <> ''),
mk AS (SELECT doc_id, list_sort(list(DISTINCT page_id)) AS pages, string_agg(CASE WHEN next_para IS NULL THEN rtrim(md, ' ') WHEN on_ AND next_para THEN md ELSE rtrim(md, ' ') || chr(10) || chr(10) END, '' ORDER BY page_id, pos, block_id) AS md FROM sq GROUP BY 1)
SELECT doc_id, pages, md5(chr(10) || chr(10) || md || CASE WHEN ends_with(md, repeat('-', 48)) THEN chr(10) || chr(10) ELSE '' END) AS markdown FROM mk"""


@_query("m4_paginate", _TREE + _PAGED, "blocks")
def _m4(s, d):
    """Whole paginated documents, and the numbers of their rules as read back from the markdown."""
    pages = blocks(s, d).select("doc_id", "page_id").distinct()
    md = M.render_markdown(tree(s, d), paginate=True, pages=pages)
    rule = r"\n\n\{(\d+)\}-{48}(?=\n\n)"
    return md.select("doc_id", F.transform(F.regexp_extract_all("markdown", F.lit(rule), F.lit(1)), lambda x: x.cast("int")).alias("pages"), F.md5("markdown").alias("markdown"))


@_query(
    "m5_render_json",
    _TREE + "SELECT doc_id, count(DISTINCT page_id) AS pages, string_agg(block_id || '=' || md5(holes) || coalesce('(' || kids || ')', ''), ',' ORDER BY page_id, pos, block_id) AS leaves FROM tp GROUP BY ALL",
    "blocks",
)
def _m5(s, d):
    """Rendered as JSON and read back with a schema."""
    node = "id:string,block_type:string,html:string,bbox:array<double>,images:map<string,string>"
    back = M.render_json(tree(s, d)).select("doc_id", F.from_json("json", f"children array<struct<id:string,children:array<struct<{node},children:array<struct<{node}>>,section_hierarchy:map<string,string>>>>>").alias("j"))
    kids = lambda c: F.when(c["children"].isNotNull(), F.concat(F.lit("("), F.array_join(F.transform(c["children"], lambda k: F.concat(k["id"], F.lit("="), F.md5(k["html"]))), ";"), F.lit(")"))).otherwise("")
    leaves = F.transform(F.flatten(F.transform("j.children", lambda p: p["children"])), lambda c: F.concat(c["id"], F.lit("="), F.md5(c["html"]), kids(c)))
    return back.select("doc_id", F.size("j.children").cast("long").alias("pages"), F.array_join(leaves, ",").alias("leaves"))


@_query(
    "m6_render_chunks",
    _TREE + """, hd AS (SELECT doc_id, page_id, pos, block_id, heading_level FROM tp WHERE block_type = 'SectionHeader')
SELECT tp.doc_id, tp.block_id AS id, tp.page_id, md5(tp.html) AS html, tp.x0 AS left_edge, tp.y1 AS bottom, CASE WHEN tp.block_type = 'Picture' THEN tp.block_id END AS image,
  (SELECT h.block_id FROM hd h WHERE h.doc_id = tp.doc_id AND (h.page_id, h.pos) <= (tp.page_id, tp.pos) ORDER BY h.page_id DESC, h.pos DESC LIMIT 1) AS heading
FROM tp""",
    "blocks",
)
def _m6(s, d):
    chunks = M.render_chunks(tree(s, d))
    return chunks.select(
        "doc_id", "id", "page_id", F.md5("html").alias("html"), F.get("bbox", F.lit(0)).alias("left_edge"), F.get(F.get("polygon", F.lit(2)), F.lit(1)).alias("bottom"),
        F.unbase64(F.get(F.map_values("images"), F.lit(0))).cast("string").alias("image"), F.try_element_at(F.map_values(F.map_from_entries(F.array_sort(F.map_entries("hierarchy")))), F.lit(-1)).alias("heading"),
    )


@_query(
    "t34_clean_table_html",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN '<table border="1"><tr><td>' || replace(replace(url, '&', '&amp;'), '<', '&lt;') || '</td></tr></table>'
  WHEN 1 THEN '<table><tr><td>a</td><td>' || replace(replace(url, '&', '&amp;'), '<', '&lt;') || '</td></tr><tr><td><b>c</b></td></tr></table>' ELSE '' END AS html FROM pages""",
)
def _t34(s, d):
    """Whole tables, tables cut off in the middle with crossed tags, tables without a cell, and no table."""
    url = F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    kind = F.col("page_id") % 4
    whole = F.concat(F.lit("<table border=1 data-bbox='0 0 1 1'><tr data-label=x><td>"), url, F.lit("</td></tr></table> "))
    cut = F.concat(F.lit("<table></i><tr><td>a<td>"), url, F.lit("</tr><tr><td><b>c"))
    return table(s, d, "pages").select("page_id", clean_table_html(F.when(kind == 0, whole).when(kind == 1, cut).when(kind == 2, F.lit("<table><tr></tr></table>")).otherwise(F.col("url"))).alias("html"))
