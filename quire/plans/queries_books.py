"""Queries of claims, sections, tables, rendering and sources over the whole derived tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import books as K
from quire.operators import claims as C
from quire.operators.render import escape_html
from quire.plans.fixtures import blocks, doc_lines, lines_boxed, with_fixtures
from quire.plans.queries_rules import FIXTURES, books
from quire.session import table
from quire.sources import files as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str, *fixtures: str):
    def keep(f):
        QUERIES[name] = f
        ORACLES[name] = with_fixtures(sql, *fixtures) if fixtures else sql
        return f

    return keep


def _packages(sql: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURES[n]})" for n in FIXTURES if n in sql) + "\n" + sql


# --- claims

_NORM = r"trim(regexp_replace(regexp_replace({}, ' +', ' ', 'g'), '\s+([،؛,.!؟?:])', '\1', 'g'))"


@_query(
    "j22_match_quotes",
    rf""", q AS (SELECT doc_id, line_idx, text AS block, CASE line_idx % 4 WHEN 0 THEN substr(text, 8) WHEN 1 THEN replace(text, ' ', '  ') WHEN 2 THEN text || ' zzz' ELSE 'nothing of this is there' END AS quote
  FROM (SELECT doc_id, line_idx, regexp_replace(text, '[^a-zA-Z ]', '', 'g') AS text FROM doc_lines)),
n AS (SELECT *, {_NORM.format("quote")} AS nq, {_NORM.format("block")} AS nb FROM q),
t AS (SELECT *, list_filter(regexp_split_to_array(nq, '\s+'), lambda x: x <> '') AS qt, list_filter(regexp_split_to_array(nb, '\s+'), lambda x: x <> '') AS bt FROM n),
s AS (SELECT *, CASE WHEN len(qt) > 0 THEN len(list_filter(qt, lambda x: list_contains(bt, x))) / len(qt) END AS share, instr(block, quote) AS e, instr(nb, nq) AS m FROM t)
SELECT doc_id, line_idx, CASE WHEN trim(quote) = '' OR trim(block) = '' THEN 'none' WHEN e > 0 THEN 'exact' WHEN m > 0 THEN 'normalized' ELSE 'token_overlap' END AS method,
CASE WHEN trim(quote) = '' OR trim(block) = '' THEN 0.0 WHEN e > 0 THEN 1.0 WHEN m > 0 THEN 0.95 ELSE round(coalesce(share, 0.0), 4) END AS score,
CASE WHEN trim(quote) = '' OR trim(block) = '' THEN NULL WHEN e > 0 THEN e - 1 WHEN m > 0 THEN m - 1 END AS char_start FROM s""",
    "doc_lines",
)
def _j22(s, d):
    """A quotation of each line: its end, spaced out, with a word more, or of something else."""
    q = doc_lines(s, d).select("doc_id", "line_idx", F.regexp_replace("text", "[^a-zA-Z ]", "").alias("block"))
    kind = F.col("line_idx") % 4
    quote = F.when(kind == 0, F.expr("substr(block, 8)")).when(kind == 1, F.replace("block", F.lit(" "), F.lit("  "))).when(kind == 2, F.concat("block", F.lit(" zzz"))).otherwise("nothing of this is there")
    return q.withColumn("quote", quote).select("doc_id", "line_idx", C.match_quote(F.col("quote"), F.col("block")).alias("m")).select("doc_id", "line_idx", "m.method", "m.score", "m.char_start")


_C11 = """, c AS (SELECT okey, id, package_id, any_value(evidence_level) AS claimed FROM concepts GROUP BY ALL)"""


def _claims(s, d):
    claims = books(s, d, "concepts").groupBy("package_id", "id").agg(F.min("evidence_level").alias("claimed_level"), F.min("confidence").cast("double").alias("model_confidence"), F.min(F.when(F.col("okey") % 3 == 0, "low").otherwise("high")).alias("density"))
    ev = books(s, d, "evidence")
    cited = ev.select("package_id", F.concat(F.lit("c"), F.substring("id", 2, 99)).alias("id"), F.col("quote_verified").alias("matched"), F.when(F.col("printed_page") % 2 == 0, "exact").otherwise("token_overlap").alias("method"), F.when(F.col("pdf_page") % 3 == 0, "img").alias("asset_id"))
    return C.verify_claims(claims, cited)


_CLAIMS = """cl AS (SELECT package_id, id, min(evidence_level) AS claimed_level, min(confidence)::DOUBLE AS mc, min(CASE WHEN okey % 3 = 0 THEN 'low' ELSE 'high' END) AS density FROM concepts GROUP BY ALL),
g AS (SELECT package_id, 'c' || substr(id, 2) AS id, count(*) AS n, count(*) FILTER (WHERE quote_verified) AS nv, bool_or(quote_verified AND printed_page % 2 = 0) AS ex, bool_and(pdf_page % 3 = 0) AS vis FROM evidence GROUP BY ALL),
v AS (SELECT cl.*, coalesce(n, 0) AS n, coalesce(nv, 0) AS nv, coalesce(ex, false) AS ex, CASE WHEN claimed_level = 'explicit' AND coalesce(nv, 0) = 0 THEN 'inferred' WHEN claimed_level = 'explicit' AND coalesce(vis, false) AND coalesce(n, 0) > 0 THEN 'needs_visual_review' ELSE claimed_level END AS level
  FROM cl LEFT JOIN g USING (package_id, id)),
s1 AS (SELECT *, round_even(CASE WHEN nv > 0 AND ex THEN 0.55 WHEN nv > 0 THEN 0.35 ELSE 0.0 END + CASE WHEN nv >= 2 THEN 0.1 ELSE 0.0 END + CASE WHEN level = 'explicit' AND nv > 0 THEN 0.1 ELSE 0.0 END, 4) AS a FROM v),
s2 AS (SELECT *, round_even(least(1.0, round_even(greatest(0.0, a - CASE WHEN density = 'low' THEN 0.1 ELSE 0.0 END), 4) + least(0.1, greatest(0.0, mc) * 0.1)), 4) AS b FROM s1),
sc AS (SELECT *, CASE WHEN level = 'needs_visual_review' THEN least(b, 0.5) ELSE b END AS confidence FROM s2)
"""


def _with_claims(sql: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURES[n]})" for n in ("concepts", "evidence")) + ",\n" + _CLAIMS + sql


@_query("c11_verify_claims", _with_claims("SELECT package_id, id, level, level <> claimed_level AS demoted, n > 0 AS grounded FROM v"))
def _c11(s, d):
    return _claims(s, d).select("package_id", "id", "level", "demoted", "grounded")


@_query("c12_claim_confidence", _with_claims("SELECT package_id, id, confidence::DOUBLE AS confidence FROM sc"))
def _c12(s, d):
    return C.claim_confidence(_claims(s, d)).select("package_id", "id", "confidence")


@_query("c13_review_reasons", _with_claims("SELECT package_id, id, concat_ws(',', CASE WHEN level = 'needs_visual_review' THEN 'image' END, CASE WHEN level <> claimed_level THEN 'demoted' END, CASE WHEN nv = 0 THEN 'no_quotation' END, CASE WHEN confidence < 0.6 THEN 'low' WHEN confidence < 0.85 THEN 'below_accept' END) AS reasons FROM sc"))
def _c13(s, d):
    return C.review_reasons(C.claim_confidence(_claims(s, d))).select("package_id", "id", F.array_join("reasons", ",").alias("reasons"))


@_query(
    "c14_check_wording",
    """WITH w AS (SELECT DISTINCT conv_id, turn, role, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda x: x <> '')) AS word FROM conversations),
k AS (SELECT DISTINCT conv_id, word FROM w WHERE role <> 'assistant'), c AS (SELECT DISTINCT conv_id, turn, word FROM w WHERE role = 'assistant' AND length(word) >= 4)
SELECT c.conv_id AS lesson_id, c.turn AS claim_id, c.word FROM c WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.conv_id = c.conv_id AND k.word = c.word)
AND NOT EXISTS (SELECT 1 FROM k WHERE k.conv_id = c.conv_id AND substr(k.word, 1, 4) = substr(c.word, 1, 4)) AND NOT EXISTS (SELECT 1 FROM k WHERE k.conv_id = c.conv_id AND length(k.word) = 3 AND k.word = substr(c.word, 1, 3))""",
)
def _c14(s, d):
    """Every answer's words against all that the conversation's other turns say."""
    w = table(s, d, "conversations").select(F.col("conv_id").alias("lesson_id"), F.col("turn").alias("claim_id"), "role", F.explode(F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda x: x != ""))).alias("word"))
    return C.check_wording(w.where("role = 'assistant'").select("lesson_id", "claim_id", "word"), w.where("role <> 'assistant'").select("lesson_id", "word"))


@_query(
    "c15_flag_duplicates",
    _packages("""SELECT DISTINCT a.package_id, a.lesson_id, a.id AS id_a, b.id AS id_b FROM concepts a JOIN concepts b ON a.package_id = b.package_id AND a.lesson_id = b.lesson_id AND a.id < b.id AND a.label = b.label"""),
)
def _c15(s, d):
    return C.flag_duplicates(books(s, d, "concepts").withColumn("label", F.concat(F.lit("Unit x y z "), F.col("label"), F.lit(" "), F.col("label"))), 0.9)


@_query("c21_grading_mode", _packages("SELECT id, CASE WHEN n_options = 3 OR question_type = 'handwriting' THEN 'hybrid' WHEN question_type IN ('true_false', 'multiple_choice', 'short_answer') THEN 'auto' ELSE 'manual' END AS mode, CASE WHEN answer IS NULL THEN 'no' ELSE 'yes,no' END AS keys FROM questions"))
def _c21(s, d):
    return books(s, d, "questions").select("id", C.grading_mode(F.col("question_type"), F.when(F.col("n_options") == 3, "hybrid")).alias("mode"), F.array_join(C.answer_key(F.col("answer"), F.array(F.lit("no"), F.lit("yes").substr(1, 0), F.col("answer"))), ",").alias("keys"))


# --- books


@_query("j13_lesson_pages", ", les AS (SELECT DISTINCT doc_id, page_id AS first_page, page_id + page_id % 3 AS last_page, 'l' || page_id AS id FROM doc_lines WHERE page_id % 2 = 0), pg AS (SELECT DISTINCT doc_id, page_id AS page_key FROM doc_lines) SELECT les.doc_id, id AS lesson_id, page_key FROM les JOIN pg ON les.doc_id = pg.doc_id AND page_key BETWEEN first_page AND last_page", "doc_lines")
def _j13(s, d):
    pages = doc_lines(s, d).select("doc_id", "page_id").distinct()
    lessons = pages.where("page_id % 2 = 0").selectExpr("doc_id", "concat('l', page_id) AS id", "page_id AS first_page", "page_id + page_id % 3 AS last_page")
    return K.lesson_pages(lessons, pages.selectExpr("doc_id", "page_id AS page_key"))


_SECT = """, sec AS (SELECT doc_id, pos, page_id, text, block_type, coalesce(last_value(CASE WHEN block_type = 'SectionHeader' AND length(trim(text)) > 0 THEN block_id END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page_id, y0, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'front') AS section FROM blocks)
"""


@_query("j14_blocks_to_sections", _SECT + "SELECT doc_id, pos, section FROM sec", "blocks")
def _j14(s, d):
    b = blocks(s, d)
    return K.blocks_to_sections(b, b.where("block_type = 'SectionHeader' and length(trim(text)) > 0").withColumn("section", F.col("block_id")))


@_query(
    "w23_lesson_opening",
    r""", m AS (SELECT *, length(trim(text)) <= 60 AND length(trim(text)) > 0 AND NOT regexp_matches(trim(text), '^\d+$') AS sh FROM blocks)
SELECT doc_id, page_id, CASE WHEN count(*) FILTER (WHERE sh) = 1 THEN arg_min(trim(text), pos) FILTER (WHERE sh) ELSE arg_min(trim(text), pos) FILTER (WHERE block_type = 'SectionHeader') END AS title FROM m GROUP BY ALL""",
    "blocks",
)
def _w23(s, d):
    return K.lesson_opening(blocks(s, d), 60)


@_query(
    "w24_toc_columns",
    """, s AS (SELECT doc_id, page_id, line_idx, x0 + line_idx % 2 * 300 AS x0, x0 + line_idx % 2 * 300 + 100 AS x1 FROM lines_boxed),
e AS (SELECT *, max(x1) OVER w - min(x0) OVER w AS ext FROM s WINDOW w AS (PARTITION BY doc_id, page_id)),
n AS (SELECT *, max(x1) OVER (PARTITION BY doc_id, page_id ORDER BY x0, x1, line_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e WHERE x1 - x0 < 0.6 * ext),
c AS (SELECT *, sum(CASE WHEN x0 - reach >= 0.02 * ext THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_id ORDER BY x0, x1, line_idx) AS col FROM n)
SELECT e.doc_id, e.line_idx, CAST(c.col AS BIGINT) AS "column" FROM e LEFT JOIN c ON e.doc_id = c.doc_id AND e.line_idx = c.line_idx""",
    "lines_boxed",
)
def _w24(s, d):
    li = lines_boxed(s, d).withColumn("x0", F.col("x0") + F.col("line_idx") % 2 * 300)
    return K.toc_columns(li.withColumn("x1", F.col("x0") + 100)).select("doc_id", "line_idx", "column")


# --- tables: a page's lines are cells, three to a row

_CELLS = ", cells AS (SELECT doc_id, page_id, (line_idx % 12) // 3 AS row_id, line_idx % 3 AS col_id, text, 1 + (length(text) % 11 = 0)::INT AS rowspan, 1 + (length(text) % 7 = 0)::INT AS colspan FROM doc_lines)\n"


def _cells(s, d):
    return doc_lines(s, d).selectExpr("doc_id", "page_id", "cast((line_idx % 12) div 3 as int) AS row_id", "line_idx % 3 AS col_id", "text", "1 + cast(length(text) % 11 = 0 as int) AS rowspan", "1 + cast(length(text) % 7 = 0 as int) AS colspan", "line_idx % 12 < 3 AS is_header")


@_query(
    "r5_cells_to_html",
    _CELLS + """, r AS (SELECT doc_id, page_id, row_id, '<tr>' || string_agg('<' || CASE WHEN row_id = 0 THEN 'th' ELSE 'td' END || CASE WHEN rowspan > 1 THEN ' rowspan=' || rowspan ELSE '' END || CASE WHEN colspan > 1 THEN ' colspan=' || colspan ELSE '' END || '>' || text || CASE WHEN row_id = 0 THEN '</th>' ELSE '</td>' END, '' ORDER BY col_id) || '</tr>' AS line FROM cells GROUP BY ALL)
SELECT doc_id, page_id, md5('<table><tbody>' || string_agg(line, '' ORDER BY row_id) || '</tbody></table>') AS html FROM r GROUP BY ALL""",
    "doc_lines",
)
def _r5(s, d):
    return K.cells_to_html(_cells(s, d), ["doc_id", "page_id"]).select("doc_id", "page_id", F.md5("html").alias("html"))


_R7 = """, sp AS (SELECT doc_id, page_id, row_id, col_id, CASE WHEN page_id % 3 = 1 AND row_id = 0 THEN '' ELSE regexp_replace(text, '[^a-zA-Z0-9]', '', 'g') END AS text FROM cells WHERE NOT (page_id % 2 = 0 AND row_id IN (1, 2) AND col_id = 1) AND NOT (page_id % 5 = 4 AND row_id > 0)),
sh AS (SELECT doc_id, page_id, max(row_id) AS r, count(DISTINCT row_id) AS n_rows, max(col_id) AS c FROM sp GROUP BY ALL),
gr AS (SELECT doc_id, page_id, n_rows, row_id, unnest(range(0, c + 1)) AS col_id FROM (SELECT doc_id, page_id, n_rows, c, unnest(range(0, r + 1)) AS row_id FROM sh)),
dn AS (SELECT gr.*, coalesce(sp.text, '') AS text FROM gr LEFT JOIN sp USING (doc_id, page_id, row_id, col_id)),
pd AS (SELECT *, max(length(text)) OVER (PARTITION BY doc_id, page_id, col_id) AS w, max(text) OVER (PARTITION BY doc_id, page_id, row_id) = '' AS blank FROM dn),
ln AS (SELECT doc_id, page_id, n_rows, row_id, any_value(blank) AS blank, '|' || string_agg(' ' || text || repeat(' ', (w - length(text))::INT) || ' ', '|' ORDER BY col_id) || '|' AS line, '|' || string_agg(repeat('-', w::INT + 2), '|' ORDER BY col_id) || '|' AS rule FROM pd GROUP BY ALL),
st AS (SELECT *, min(CASE WHEN NOT blank THEN row_id END) OVER (PARTITION BY doc_id, page_id) AS first FROM ln)
SELECT doc_id, page_id, md5(coalesce(string_agg(CASE WHEN row_id >= first THEN line || CASE WHEN row_id = first THEN chr(10) || rule ELSE '' END END, chr(10) ORDER BY row_id), '') || CASE WHEN any_value(n_rows) = 1 THEN CASE WHEN any_value(first) IS NULL THEN '' ELSE chr(10) END || any_value(rule) ELSE '' END) AS markdown FROM st GROUP BY ALL"""


@_query("r7_cells_to_markdown", _CELLS + _R7, "doc_lines")
def _r7(s, d):
    """Tables with a middle cell over three rows, an empty first row, or a single row."""
    spans = _cells(s, d).where("NOT (page_id % 2 = 0 AND row_id IN (1, 2) AND col_id = 1) AND NOT (page_id % 5 = 4 AND row_id > 0)")
    tall = "if(page_id % 2 = 0 AND page_id % 5 <> 4 AND row_id = 0 AND col_id = 1, 3, 1)"
    cells = spans.selectExpr("doc_id", "page_id", "row_id", "col_id", f"{tall} AS rowspan", "1 AS colspan", "is_header", "if(page_id % 3 = 1 AND row_id = 0, '', regexp_replace(text, '[^a-zA-Z0-9]', '')) AS text")
    return K.cells_to_markdown(cells, ["doc_id", "page_id"]).select("doc_id", "page_id", F.md5("markdown").alias("markdown"))


@_query(
    "r2_header_band",
    """, t AS (SELECT doc_id, page_id, line_idx AS row_id, length(text) % 5 AS n, length(text) % 3 AS m FROM doc_lines),
g AS (SELECT doc_id, page_id, min(CASE WHEN n >= 2 AND m > 0.5 * n THEN row_id END) AS dt, min(CASE WHEN n >= 2 THEN row_id END) AS rich, min(row_id) AS top FROM t GROUP BY ALL)
SELECT doc_id, page_id, coalesce(dt, CASE WHEN rich > top THEN rich END) AS first_data_row FROM g""",
    "doc_lines",
)
def _r2(s, d):
    rows = doc_lines(s, d).selectExpr("doc_id", "page_id", "line_idx AS row_id", "length(text) % 5 AS n_tokens", "length(text) % 3 AS n_numeric")
    return K.header_band(rows, ["doc_id", "page_id"])


@_query(
    "j19_join_tables",
    _CELLS + """, dn AS (SELECT doc_id, page_id, max(r) AS r FROM (SELECT doc_id, page_id, col_id, sum(rowspan) AS r FROM cells GROUP BY ALL) GROUP BY ALL),
ac AS (SELECT doc_id, page_id, max(c) AS c FROM (SELECT doc_id, page_id, row_id, sum(colspan) AS c FROM cells GROUP BY ALL) GROUP BY ALL),
sh AS (SELECT * FROM dn JOIN ac USING (doc_id, page_id)),
ok AS (SELECT b.doc_id, b.page_id, a.page_id AS to_page, a.page_id % 4 = 0 AS below, a.r, a.c FROM sh a JOIN sh b ON a.doc_id = b.doc_id AND b.page_id = a.page_id + 1 AND a.page_id % 2 = 0 AND CASE WHEN a.page_id % 4 = 0 THEN abs(a.c - b.c) < 2 ELSE abs(a.r - b.r) < 5 END)
SELECT c.doc_id, coalesce(ok.to_page, c.page_id) AS page_id, c.row_id + CASE WHEN below THEN ok.r ELSE 0 END AS row_id, c.col_id + CASE WHEN NOT below THEN ok.c ELSE 0 END AS col_id, c.text FROM cells c LEFT JOIN ok ON c.doc_id = ok.doc_id AND c.page_id = ok.page_id""",
    "doc_lines",
)
def _j19(s, d):
    """Each odd page's table goes on below or beside that of the page before."""
    cells = _cells(s, d)
    merges = cells.select("doc_id", "page_id").distinct().where("page_id % 2 = 1").selectExpr("doc_id AS doc_id_1", "page_id - 1 AS page_id_1", "doc_id AS doc_id_2", "page_id AS page_id_2", "if(page_id % 4 = 1, 'bottom', 'right') AS direction")
    return K.join_tables(cells, merges, ["doc_id", "page_id"])


# --- sources


@_query(
    "s2_route_doctype",
    """SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'html' WHEN 1 THEN 'pdf' WHEN 2 THEN 'image' WHEN 3 THEN 'docx' WHEN 4 THEN 'xlsx' WHEN 5 THEN 'pdf' ELSE 'epub' END AS kind FROM pages""",
)
def _s2(s, d):
    """Pages, files by magic bytes, archives of which the telling member lies behind the page, plain texts by extension or none."""
    said = lambda x: F.encode(F.lit(x), "UTF-8")
    filler = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    kind = F.col("page_id") % 7
    content = (
        F.when(kind == 0, filler).when(kind == 1, F.concat(said("%PDF-1.7"), filler)).when(kind == 2, F.concat(F.unhex(F.lit("89504E470D0A1A0A")), filler))
        .when(kind == 3, _zip("word/document.xml", "x", filler)).when(kind == 6, _zip("mimetype", "application/epub+zip", filler)).otherwise(said("plain"))
    )
    return table(s, d, "pages").select("page_id", S.route_doctype(content, F.when(kind == 4, "a/b.xlsx").otherwise("a/b")).alias("kind"))


def _zip(name: str, stored: str, filler):
    """An archive in which a member of that name lies behind the filler."""

    @F.pandas_udf("binary")
    def make(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            file = io.BytesIO()
            with zipfile.ZipFile(file, "w") as archive:
                archive.writestr("filler.xml", text)
                archive.writestr(name, stored)
            out.append(file.getvalue())
        return pd.Series(out)

    return make(filler)


@_query("s3_skip_existing", "SELECT page_id FROM pages WHERE page_id % 3 <> 0")
def _s3(s, d):
    p = table(s, d, "pages")
    ins = p.selectExpr("page_id", "concat('in/doc', page_id, '.pdf') AS path")
    outs = p.where("page_id % 3 = 0").selectExpr("concat('out/doc', page_id, '.md') AS path").unionByName(p.where("page_id % 3 = 1").selectExpr("concat('out/doc', page_id, '.png') AS path"))
    return S.skip_existing(ins, outs).select("page_id")


@_query("s4_select_pages", "SELECT doc_id, page_id, count(*) AS n FROM doc_lines WHERE page_id = 0 OR page_id BETWEEN 2 AND 4 OR page_id = 7 GROUP BY ALL", "doc_lines")
def _s4(s, d):
    return S.select_pages(doc_lines(s, d), "0,2-4,7").groupBy("doc_id", "page_id").agg(F.count("*").alias("n"))


@_query("s5_content_key", "SELECT page_id, substr(sha256(sha256(html) || '|balanced|0-3'), 1, 16) AS k FROM pages")
def _s5(s, d):
    return table(s, d, "pages").select("page_id", S.content_key(F.encode("html", "UTF-8"), "balanced", "0-3").alias("k"))


#: A block's markup by its type, all five special characters escaped.
_ESCAPED = """replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')"""
_TYPED = f"""CASE block_type WHEN 'SectionHeader' THEN '<h' || heading_level || '>' || {_ESCAPED} || '</h' || heading_level || '>' WHEN 'ListItem' THEN '<li>' || {_ESCAPED} || '</li>'
  WHEN 'Picture' THEN '' ELSE '<p block-type=''' || block_type || '''>' || {_ESCAPED} || '</p>' END"""


@_query("s6_read_block_json", f"SELECT doc_id, block_id AS id, block_type, md5({_TYPED}) AS html FROM blocks", "blocks")
def _s6(s, d):
    """Documents as JSON trees (document, pages, blocks), each block with the markup of its type, read back to leaves."""
    kind, text, level = F.col("block_type"), escape_html(F.col("text")), F.col("heading_level").cast("string")
    html = (
        F.when(kind == "SectionHeader", F.concat(F.lit("<h"), level, F.lit(">"), text, F.lit("</h"), level, F.lit(">"))).when(kind == "ListItem", F.concat(F.lit("<li>"), text, F.lit("</li>")))
        .when(kind == "Picture", F.lit("")).otherwise(F.concat(F.lit("<p block-type='"), kind, F.lit("'>"), text, F.lit("</p>")))
    )
    b = blocks(s, d).select("doc_id", "page_id", "pos", F.col("block_id").alias("id"), "block_type", html.alias("html"))
    pages = b.groupBy("doc_id", "page_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.struct("id", "block_type", "html").alias("b")))), lambda x: x["b"]).alias("children"))
    docs = pages.groupBy("doc_id").agg(F.to_json(F.struct(F.lit("doc").alias("id"), F.collect_list(F.struct(F.concat(F.lit("/page/"), "page_id").alias("id"), "children")).alias("children"))).alias("json"))
    return S.leaf_blocks(docs, "json", ["doc_id"]).select("doc_id", "id", "block_type", F.md5("html").alias("html"))


@_query(
    "s9_version_gate",
    "SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'newer' WHEN 2 THEN 'major' ELSE 'malformed' END AS reason, CASE o_orderkey % 5 WHEN 0 THEN '1.2.0' WHEN 1 THEN '1.3.0' WHEN 2 THEN '2.0.0' WHEN 3 THEN 'draft' ELSE '1.1' END AS version FROM orders",
)
def _s9(s, d):
    v = table(s, d, "orders").selectExpr("o_orderkey AS id", "CASE o_orderkey % 5 WHEN 0 THEN '1.1.7' WHEN 1 THEN '1.3.0' WHEN 2 THEN '2.0.0' WHEN 3 THEN 'draft' ELSE '1.1' END AS version")
    return S.version_gate(v, "1.2.0").select("id", "reason", "version")


@_query(
    "s10_sheet_to_html",
    _CELLS + """, m AS (SELECT DISTINCT doc_id, page_id FROM cells WHERE page_id % 2 = 0),
k AS (SELECT c.doc_id, c.page_id, c.row_id, c.col_id, c.text, m.doc_id IS NOT NULL AND row_id = 0 AND col_id = 0 AS first, m.doc_id IS NULL OR row_id > 1 OR (row_id = 0 AND col_id = 0) AS stays FROM cells c LEFT JOIN m ON c.doc_id = m.doc_id AND c.page_id = m.page_id),
r AS (SELECT doc_id, page_id, row_id, coalesce(string_agg('<td' || CASE WHEN first THEN ' rowspan=2 colspan=3' ELSE '' END || '>' || text || '</td>', '' ORDER BY col_id) FILTER (WHERE stays), '') AS line FROM k GROUP BY ALL)
SELECT doc_id, page_id, md5('<table><tbody>' || string_agg('<tr>' || line || '</tr>', '' ORDER BY row_id) || '</tbody></table>') AS html FROM r GROUP BY ALL""",
    "doc_lines",
)
def _s10(s, d):
    """Every other sheet has its first two rows merged into one cell."""
    cells = _cells(s, d)
    merged = cells.select("doc_id", "page_id").distinct().where("page_id % 2 = 0").selectExpr("doc_id", "page_id", "0 AS r0", "1 AS r1", "0 AS c0", "2 AS c1")
    return S.sheet_to_html(cells, merged, ["doc_id", "page_id"]).select("doc_id", "page_id", F.md5("html").alias("html"))
