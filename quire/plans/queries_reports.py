"""Queries of the reports, of lookups, limits and set operations, and of sections by lesson."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import books as K
from quire.operators import reports as T
from quire.plans.fixtures import blocks, lines_boxed, with_fixtures
from quire.plans.queries_rules import FIXTURES, books
from quire.session import table

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


def _pages(s, d):
    return blocks(s, d).select("doc_id", "page_id").distinct().selectExpr("*", "484704.0 AS area")


# --- extraction

#: Raw lines have spans of single characters on some pages; a fifth of the blocks lost their text, some pages show large pictures.
_RAW = "doc_id, page_id, line_idx, text, 4 AS n_spans, CASE WHEN page_id % 3 = 1 THEN 3 ELSE line_idx % 3 END AS n_single_char_spans"
_SHOWN = """doc_id, page_id, pos, block_type, CASE WHEN (pos + doc_id) % 5 = 0 THEN '' ELSE text END AS text, x0, y0, CASE WHEN block_type = 'Picture' AND doc_id % 3 = 0 THEN 700.0 ELSE x1 END AS x1, CASE WHEN block_type = 'Picture' AND doc_id % 3 = 0 THEN y0 + 400.0 ELSE y1 END AS y1"""
_KINDS = ", ".join(f"'{k}'" for k in T.TEXT_TYPES)
_DIAGNOSTICS = f""", sh AS (SELECT {_SHOWN} FROM blocks), rw AS (SELECT {_RAW} FROM lines_boxed),
b AS (SELECT doc_id, page_id, sum(CASE WHEN block_type = 'Picture' THEN greatest(0, x1 - x0) * greatest(0, y1 - y0) ELSE 0.0 END) AS pa, sum(CASE WHEN block_type = 'Picture' THEN 0 ELSE length(text) END) AS rc,
  count(*) FILTER (WHERE block_type IN ({_KINDS})) AS nt, bool_or(block_type = 'Picture') AS hp, bool_or(block_type = 'PageHeader') AS hh, bool_or(block_type = 'PageFooter') AS hf FROM sh GROUP BY ALL),
l AS (SELECT doc_id, page_id, sum(length(trim(text))) AS raw, count(*) AS n, sum(n_spans) AS sp, sum(n_single_char_spans) AS si FROM rw GROUP BY ALL),
dg AS (SELECT doc_id, page_id, raw::BIGINT AS raw_chars, rc::BIGINT AS rendered_chars, CASE WHEN raw > 0 THEN rc / raw END AS exact, n AS raw_lines, nt AS n_text_blocks, least(1.0, pa / 484704.0) AS share, hp AS has_picture, false AS has_picture_group,
  hh AS has_page_header, hf AS has_page_footer, n >= 10 AND si / sp >= 0.5 AS is_decorative,
  nullif(concat_ws(',', CASE WHEN least(1.0, pa / 484704.0) >= 0.3 THEN 'picture_area' END, CASE WHEN raw > 0 AND rc / raw < 0.8 THEN 'recovery_ratio' END, CASE WHEN nt = 0 AND n > 0 THEN 'no_text_blocks' END), '') AS reasons FROM b JOIN l USING (doc_id, page_id))
"""


def _diagnostics(s, d):
    return T.page_diagnostics(blocks(s, d).selectExpr(*_columns(_SHOWN)), lines_boxed(s, d).selectExpr(*_columns(_RAW)), _pages(s, d))


def _columns(text: str) -> list[str]:
    """Columns of a select list, at the commas outside parentheses and CASE."""
    out, depth, word = [], 0, ""
    for part in text.split(","):
        word += part
        depth = word.count("(") - word.count(")") + word.count("CASE") - word.count(" END")
        if depth == 0:
            out.append(word.strip())
            word = ""
        else:
            word += ","
    return out


@_query(
    "a5_page_diagnostics",
    _DIAGNOSTICS + "SELECT * EXCLUDE (exact, share), round_even(exact, 4) AS recovery_ratio, round_even(share, 4) AS picture_share FROM dg",
    "blocks",
)
def _a5(s, d):
    return _diagnostics(s, d)


@_query(
    "a7_extraction_report",
    _DIAGNOSTICS + """, rv AS (SELECT doc_id, page_id, sum(length(text)) FILTER (WHERE pos % 10 = 0) AS chars, count(*) FILTER (WHERE pos % 10 = 0) AS n_lines, count(*) FILTER (WHERE pos % 10 = 5) AS n_dup, count(DISTINCT pos // 4) FILTER (WHERE pos % 10 = 0) AS n_blocks FROM blocks WHERE (pos + doc_id) % 5 = 0 GROUP BY ALL),
ats AS (SELECT doc_id, page_id, count(*) AS n FROM blocks WHERE block_type = 'Picture' GROUP BY ALL),
e AS (SELECT dg.*, rendered_chars + coalesce(chars, 0) AS final, coalesce(chars, 0) AS chars, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup, coalesce(n_blocks, 0) AS n_blocks, coalesce(ats.n, 0) AS n_at FROM dg LEFT JOIN rv USING (doc_id, page_id) LEFT JOIN ats USING (doc_id, page_id)),
f AS (SELECT *, coalesce(nullif(CASE WHEN raw_chars > 0 THEN final / raw_chars END, 0), 1) AS ratio FROM e)
SELECT doc_id, count(*) AS pages, sum(raw_chars)::BIGINT AS raw_chars, sum(rendered_chars)::BIGINT AS rendered_chars, sum(chars)::BIGINT AS recovered_chars, sum(final)::BIGINT AS final_chars, round_even(sum(final) / nullif(sum(raw_chars), 0), 4) AS final_ratio, round_even(sum(rendered_chars) / nullif(sum(raw_chars), 0), 4) AS rendered_ratio,
  count(reasons) AS candidates, count(*) FILTER (WHERE n_lines > 0) AS pages_recovered, coalesce(list(page_id + 1 ORDER BY page_id) FILTER (WHERE ratio < 0.8), []) AS below_80, coalesce(list(page_id + 1 ORDER BY page_id) FILTER (WHERE ratio < 0.9), []) AS below_90,
  sum(n_dup)::BIGINT AS duplicates_skipped, sum(n_blocks)::BIGINT AS recovered_blocks, sum(n_at)::BIGINT AS assets, coalesce(string_agg((page_id + 1) || ':' || (raw_chars - final), ',' ORDER BY page_id) FILTER (WHERE ratio < 0.9), '') AS incomplete FROM f GROUP BY 1""",
    "blocks",
)
def _a7(s, d):
    lost = blocks(s, d).where("(pos + doc_id) % 5 = 0").withColumn("back", F.col("pos") % 10 == 0)
    recovered = lost.groupBy("doc_id", "page_id").agg(
        F.sum(F.when(F.col("back"), F.char_length("text"))).alias("chars"), F.count_if("back").alias("n_lines"), F.count_if(F.col("pos") % 10 == 5).alias("n_duplicates"), F.count_distinct(F.when(F.col("back"), F.expr("pos div 4"))).alias("n_blocks"),
    )
    out = T.extraction_report(_diagnostics(s, d), recovered, blocks(s, d).where("block_type = 'Picture'").select("doc_id", "page_id"))
    return out.withColumn("incomplete", F.array_join(F.transform("incomplete", lambda x: F.concat_ws(":", x["page"].cast("string"), x["missing_chars"].cast("string"))), ","))


@_query(
    "a2_document_metadata",
    """, t AS (SELECT doc_id, count(*) AS n, string_agg(trim(text) || '@' || heading_level || '@' || page_id, '|' ORDER BY page_id, pos) AS toc FROM blocks WHERE block_type = 'SectionHeader' AND NOT removed GROUP BY 1),
k AS (SELECT doc_id, page_id, block_type, count(*) AS n, min(pos) AS first FROM blocks WHERE NOT removed GROUP BY ALL), p AS (SELECT doc_id, page_id, string_agg(block_type || '=' || n, ',' ORDER BY n DESC, first) AS counts FROM k GROUP BY ALL),
a AS (SELECT DISTINCT doc_id, page_id FROM blocks), q AS (SELECT a.doc_id, string_agg(a.page_id || ':' || coalesce(counts, ''), ';' ORDER BY a.page_id) AS pages FROM a LEFT JOIN p ON a.doc_id = p.doc_id AND a.page_id = p.page_id GROUP BY 1)
SELECT q.doc_id, coalesce(t.n, 0) AS headings, md5(coalesce(toc, '')) AS toc, pages FROM q LEFT JOIN t USING (doc_id)""",
    "blocks",
)
def _a2(s, d):
    out = T.document_metadata(blocks(s, d))
    toc = F.array_join(F.transform("toc", lambda x: F.concat_ws("@", x["title"], x["heading_level"].cast("string"), x["page_id"].cast("string"))), "|")
    return out.select("doc_id", F.size("toc").cast("long").alias("headings"), F.md5(toc).alias("toc"), F.array_join(F.transform("pages", lambda p: F.concat_ws(":", p["page_id"].cast("string"), p["block_counts"])), ";").alias("pages"))


# --- packages


def _counted(s, d):
    review = {"requires_review": F.col("id").rlike("[13579]$"), "review_status": F.when(F.col("id").rlike("[27]$"), "accepted").otherwise("pending")}
    return {k: books(s, d, k).withColumns({c: x for c, x in review.items() if k in T.REVIEWED}) for k in T.COUNTED}


_STATS = "SELECT package_id, " + ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS {k}" for k in T.COUNTED) + """,
  count(*) FILTER (WHERE ok) AS quotations_verified, count(*) FILTER (WHERE kind NOT IN ('lessons', 'sections', 'evidence') AND regexp_matches(id, '[13579]$') AND NOT regexp_matches(id, '[27]$')) AS awaiting_review,
  count(*) FILTER (WHERE kind NOT IN ('lessons', 'sections', 'evidence') AND regexp_matches(id, '[27]$')) AS reviewed FROM (""" + " UNION ALL ".join(f"SELECT package_id, id, '{k}' AS kind, {'quote_verified' if k == 'evidence' else 'false'} AS ok FROM {k}" for k in T.COUNTED) + ") GROUP BY 1"  # fmt: skip


@_query("a14_package_stats", _packages(_STATS))
def _a14(s, d):
    return T.package_stats(_counted(s, d))


@_query("a14_stats_differences", _packages(f"SELECT package_id, 'concepts' AS field, concepts + 1 AS says, concepts AS holds FROM ({_STATS}) WHERE lessons % 3 = 0"))
def _a14d(s, d):
    """Stored counts of which some say a concept too many."""
    actual = T.package_stats(_counted(s, d))
    return T.stats_differences(actual.withColumn("concepts", F.col("concepts") + F.when(F.col("lessons") % 3 == 0, 1).otherwise(0)), actual)


_REGISTRY = "SELECT DISTINCT package_id, length(package_id) AS grade, 's' || package_id[-1:] AS subject FROM lessons"
_ANY = " UNION ALL ".join(f"SELECT package_id, id FROM {k}" for k in ("lessons", "concepts", "objectives", "questions"))


def _registry(s, d):
    return books(s, d, "lessons").select("package_id").distinct().select("package_id", F.length("package_id").alias("grade"), F.concat(F.lit("s"), F.right("package_id", F.lit(1))).alias("subject"))


@_query("a15_registry_summary", _packages(f"SELECT grade, list_sort(list(DISTINCT r.package_id)) AS packages, list_sort(list(DISTINCT subject)) AS subjects, sum(n)::BIGINT AS n_entities FROM ({_REGISTRY}) r JOIN (SELECT package_id, count(*) AS n FROM ({_ANY}) GROUP BY 1) e USING (package_id) GROUP BY 1"))
def _a15(s, d):
    entities = [books(s, d, k).select("package_id", "id") for k in ("lessons", "concepts", "objectives", "questions")]
    return T.registry_summary(_registry(s, d), entities[0].unionByName(entities[1]).unionByName(entities[2]).unionByName(entities[3]))


@_query("a15_find_packages", _packages(f"SELECT a.grade, a.subject, min(r.package_id) AS package_id FROM (SELECT DISTINCT CAST(o_orderkey % 7 AS INT) AS grade, 's' || o_orderkey % 12 AS subject FROM orders) a LEFT JOIN ({_REGISTRY}) r ON r.grade = a.grade AND r.subject = a.subject GROUP BY ALL"))
def _a15f(s, d):
    asked = table(s, d, "orders").selectExpr("cast(o_orderkey % 7 AS int) AS grade", "concat('s', o_orderkey % 12) AS subject").distinct()
    return T.find_packages(_registry(s, d), asked)


@_query(
    "a17_confidence_summary",
    _packages("""SELECT c.package_id, min(x) AS least, round_even(avg(x), 3) AS mean, max(x) AS most, count(*) AS n, count(*) FILTER (WHERE review_status = 'pending') AS awaiting, count(*) FILTER (WHERE line = 1) AS wording_flags, """
        + ", ".join(f"count(*) FILTER (WHERE x >= {t / 100}) AS over_{t}, count(*) FILTER (WHERE x >= {t / 100} AND NOT bare) AS clear_{t}" for t in (85, 80, 75, 70))
        + ", any_value(types) AS types FROM (SELECT *, confidence::DOUBLE AS x FROM concepts) c JOIN (SELECT package_id, string_agg(evidence_level || '=' || n, ',' ORDER BY evidence_level) AS types FROM (SELECT package_id, evidence_level, count(*) AS n FROM concepts GROUP BY ALL) GROUP BY 1) t ON t.package_id = c.package_id GROUP BY 1"),
)
def _a17(s, d):
    c = books(s, d, "concepts").select("package_id", F.col("confidence").cast("double").alias("confidence"), "review_status", F.col("evidence_level").alias("type"), (F.col("line") == 1).cast("int").alias("n_wording"), F.col("bare").alias("other_reasons"))
    return T.confidence_summary(c)


# --- stages

_OUTCOME = "CASE WHEN line % 5 = 4 THEN 'no_citation' WHEN line % 7 = 6 THEN 'empty_label' ELSE 'accepted' END"


@_query(
    "a20_stage_summary",
    _packages(f"""SELECT l.package_id, l.id AS lesson_id, any_value(10 + l.lesson_number) AS prompt_chars, count(c.id) AS raw, count(*) FILTER (WHERE o = 'accepted' AND NOT bare) AS accepted, count(*) FILTER (WHERE o <> 'accepted') AS rejected, count(*) FILTER (WHERE o = 'accepted' AND bare) AS ungrounded,
  coalesce(sum(line % 3), 0)::BIGINT AS dropped_citations, coalesce(sum(CASE WHEN o = 'accepted' AND NOT bare THEN line END), 0)::BIGINT AS evidence, count(*) FILTER (WHERE o = 'accepted' AND NOT bare AND review_status = 'pending') AS needs_review,
  concat_ws(',', CASE WHEN count(*) FILTER (WHERE o = 'empty_label') > 0 THEN 'empty_label=' || count(*) FILTER (WHERE o = 'empty_label') END, CASE WHEN count(*) FILTER (WHERE o = 'no_citation') > 0 THEN 'no_citation=' || count(*) FILTER (WHERE o = 'no_citation') END) AS reasons,
  concat_ws(',', """ + ", ".join(f"CASE WHEN count(*) FILTER (WHERE o = 'accepted' AND NOT bare AND evidence_level = '{k}') > 0 THEN '{k}=' || count(*) FILTER (WHERE o = 'accepted' AND NOT bare AND evidence_level = '{k}') END" for k in ("explicit", "human", "inferred"))
        + f""") AS types FROM lessons l LEFT JOIN (SELECT *, {_OUTCOME} AS o FROM concepts) c ON c.package_id = l.package_id AND c.lesson_id = l.id GROUP BY ALL"""),
)
def _a20(s, d):
    lessons = books(s, d, "lessons").select("package_id", F.col("id").alias("lesson_id"), "lesson_number")
    proposals = books(s, d, "concepts").selectExpr("package_id", "lesson_id", f"{_OUTCOME} AS outcome", "not bare AS grounded", "line % 3 AS n_dropped", "line AS n_evidence", "review_status = 'pending' AS needs_review", "evidence_level AS type")
    return T.stage_summary(lessons, proposals, lessons.withColumn("text", F.repeat(F.lit("x"), (10 + F.col("lesson_number")).cast("int"))))


_DONE = "SELECT DISTINCT package_id, lesson_id FROM"


@_query(
    "c19_resumable_work",
    _packages(f"""SELECT l.package_id, count(*) AS lessons, count(c.lesson_id) AS concepts_done, count(o.lesson_id) AS objectives_done, count(*) FILTER (WHERE c.lesson_id IS NULL OR o.lesson_id IS NULL) AS remaining, count(*) FILTER (WHERE c.lesson_id IS NOT NULL AND o.lesson_id IS NULL) AS objectives_to_do
FROM lessons l LEFT JOIN ({_DONE} concepts WHERE line = 2) c ON c.package_id = l.package_id AND c.lesson_id = l.id LEFT JOIN ({_DONE} objectives WHERE NOT observable) o ON o.package_id = l.package_id AND o.lesson_id = l.id GROUP BY 1"""),
)
def _c19(s, d):
    lessons = books(s, d, "lessons").select("package_id", F.col("id").alias("lesson_id"))
    return T.work_report(T.resumable_work(lessons, books(s, d, "concepts").where("line = 2"), books(s, d, "objectives").where("not observable")))


# --- lookups, limits, set operations


@_query("a10_merge_evidence", _packages("SELECT id, block_id, source FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY source, block_id, pdf_page) AS n FROM (SELECT id, block_id, pdf_page, 0 AS source FROM evidence WHERE quote_verified UNION ALL SELECT id, block_id, pdf_page, 1 FROM evidence)) WHERE n = 1"))
def _a10(s, d):
    e = books(s, d, "evidence")
    return T.merge_evidence(e.where("quote_verified"), e, order=["block_id", "pdf_page"]).drop("pdf_page")


@_query("j27_lookup", _packages("SELECT a.asked, l.kind, l.package_id FROM (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'l' ELSE 'q' END || o_orderkey AS asked FROM orders) a LEFT JOIN (SELECT id, 'lesson' AS kind, package_id FROM lessons) l ON l.id = a.asked"))
def _j27(s, d):
    """Ids of lessons and questions, asked for as lessons."""
    known = books(s, d, "lessons").select("id", F.lit("lesson").alias("kind"), "package_id").unionByName(books(s, d, "questions").select("id", F.lit("question").alias("kind"), "package_id"))
    return T.lookup(table(s, d, "orders").selectExpr("concat(CASE WHEN o_orderkey % 2 = 0 THEN 'l' ELSE 'q' END, o_orderkey) AS asked"), known, "lesson")


@_query("o3_first_concepts", _packages("SELECT package_id, id FROM (SELECT *, row_number() OVER (PARTITION BY package_id ORDER BY id, line, label, bare) AS n FROM concepts) WHERE n <= 3"))
def _o3(s, d):
    """The first three concepts of each package (a limit is the feature here)."""
    return T.first_of_each(books(s, d, "concepts"), ["package_id"], ["id", "line", "label", "bare"], 3).select("package_id", "id")


@_query("o4_uncovered_pages", ", a AS (SELECT DISTINCT doc_id, page_id FROM blocks) SELECT doc_id, page_id FROM a EXCEPT SELECT doc_id, page_id FROM blocks WHERE block_type = 'SectionHeader'", "blocks")
def _o4(s, d):
    return T.uncovered_pages(blocks(s, d), blocks(s, d).where("block_type = 'SectionHeader'"))


@_query("o5_orphan_blocks", "SELECT doc_id, pos FROM blocks b WHERE NOT EXISTS (SELECT 1 FROM blocks h WHERE h.doc_id = b.doc_id AND h.page_id = b.page_id AND h.block_type = 'SectionHeader')", "blocks")
def _o5(s, d):
    """Blocks of pages without a heading, as if sections covered the other pages."""
    headed = blocks(s, d).where("block_type = 'SectionHeader'").select("doc_id", "page_id").distinct()
    return T.orphan_blocks(blocks(s, d), blocks(s, d).join(headed, ["doc_id", "page_id"], "left_semi"), ["doc_id", "pos"]).select("doc_id", "pos")


@_query(
    "t32_render_code",
    """, m AS (SELECT doc_id, page_id, line_idx, text, x0, min(x0) OVER w AS mn, sum(x1 - x0) OVER w / greatest(1, sum(length(text)) OVER w) AS cw FROM lines_boxed WINDOW w AS (PARTITION BY doc_id, page_id))
SELECT doc_id, page_id, md5(rtrim(string_agg(CASE WHEN cw = 0 THEN '' ELSE repeat(' ', greatest(0, floor((x0 - mn) / cw))::INT) END || text, chr(10) ORDER BY line_idx), ' ' || chr(10))) AS code FROM m GROUP BY doc_id, page_id""",
    "lines_boxed",
)
def _t32(s, d):
    return T.render_code(lines_boxed(s, d), ["doc_id", "page_id"]).select("doc_id", "page_id", F.md5("code").alias("code"))


@_query(
    "c8_segment_sections",
    """, ls AS (SELECT DISTINCT doc_id, 'k' || page_id // 2 AS lesson_id, page_id // 2 AS k FROM blocks), r AS (SELECT b.*, 'k' || page_id // 2 AS lesson_id, block_type = 'SectionHeader' AND trim(text) <> '' AND doc_id % 4 > 0 AS head FROM blocks b),
h AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lesson_id ORDER BY page_id, y0) AS part FROM r WHERE head), hn AS (SELECT DISTINCT doc_id, lesson_id FROM h),
p AS (SELECT r.*, hn.doc_id IS NOT NULL AS headed, CASE WHEN hn.doc_id IS NULL THEN r.page_id + 1 ELSE (SELECT count(*) FROM h WHERE h.doc_id = r.doc_id AND h.lesson_id = r.lesson_id AND (h.page_id, h.y0) <= (r.page_id, r.y0)) END AS part FROM r LEFT JOIN hn ON hn.doc_id = r.doc_id AND hn.lesson_id = r.lesson_id),
g AS (SELECT doc_id, lesson_id, headed, part, min(page_id) AS first_page, max(page_id) AS last_page, count(*) AS n_blocks, sum(CASE WHEN block_type IN ('Text', 'SectionHeader', 'Caption', 'ListItem') AND trim(text) <> '' THEN length(text) ELSE 0 END)::BIGINT AS text_chars, string_agg(pos, ',' ORDER BY page_id, y0) AS places FROM p GROUP BY ALL)
SELECT g.doc_id, g.lesson_id, row_number() OVER (PARTITION BY g.doc_id, g.lesson_id ORDER BY g.part) AS n, CASE WHEN h.part IS NOT NULL THEN trim(h.text) WHEN g.headed THEN 'Lesson ' || g.lesson_id ELSE 'Lesson ' || g.lesson_id || ' — صفحه ' || g.first_page END AS title,
  CASE WHEN h.part IS NOT NULL THEN 'section_header' ELSE 'page_fallback' END AS boundary_method, h.block_id AS source_block, g.first_page, g.last_page, g.n_blocks, g.text_chars, md5(places) AS places
FROM g LEFT JOIN h ON h.doc_id = g.doc_id AND h.lesson_id = g.lesson_id AND h.part = g.part""",
    "blocks",
)
def _c8(s, d):
    """Lessons of two pages; the headings of some documents are plain text."""
    b = blocks(s, d).withColumn("block_type", F.expr("CASE WHEN block_type = 'SectionHeader' AND doc_id % 4 = 0 THEN 'Caption' ELSE block_type END"))
    pages = b.select("doc_id", "page_id").distinct()
    lessons = pages.selectExpr("doc_id", "page_id div 2 AS k").distinct().selectExpr("doc_id", "concat('k', k) AS id", "concat('Lesson k', k) AS title", "2 * k AS first_page", "2 * k + 1 AS last_page")
    out = K.sections(lessons, b, pages)
    places = F.array_join(F.transform("block_ids", lambda x: F.element_at(F.split(x, "/"), -1)), ",")
    return out.select("doc_id", "lesson_id", F.col("order").alias("n"), "title", "boundary_method", "source_block", "first_page", "last_page", "n_blocks", "text_chars", F.md5(places).alias("places"))
