"""Queries of layout labels, lessons, grounding, packages and their sources and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import books as K
from quire.operators import ground as D
from quire.operators import layout as L
from quire.operators import lessons as N
from quire.operators import rules as R
from quire.plans.fixtures import blocks, lines_boxed, with_fixtures
from quire.plans.queries_books import _SECT, _packages
from quire.plans.queries_rules import books
from quire.session import Scratch, table
from quire.sources import files as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
C = F.col


def _query(name: str, sql: str | None = None, *fixtures: str):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_fixtures(sql, *fixtures) if fixtures else sql
        return f

    return keep


# --- layout

_LABELS = ["Text", "SectionHeader", "BlankPage", "Picture", "No such label", "Table", "Handwriting"]


@_query(
    "f7_assign_labels",
    f""", k AS (SELECT *, {_LABELS}[line_idx % 7 + 1] AS label FROM lines_boxed)
SELECT doc_id, page_id, row_number() OVER (PARTITION BY doc_id, page_id ORDER BY 1000000 - line_idx) - 1 AS pos, label AS block_type, round(least(x0 * 2 * 0.5, 612.0), 6) AS x0, round(least(y0 * 2 * 0.5, 792.0), 6) AS y0,
round(least((x1 * 2 + 300) * 0.5, 612.0), 6) AS x1, round(least(y1 * 2 * 0.5, 792.0), 6) AS y1 FROM k WHERE label NOT IN ('BlankPage', 'No such label')
UNION ALL SELECT DISTINCT doc_id, -1 - page_id, 0, 'Form', 0.0, 0.0, 612.0, 792.0 FROM lines_boxed""",
    "lines_boxed",
)
def _f7(s, d):
    """Boxes of an image twice the page's size, and beside them (pages below 0) one forced block a page."""
    size = {"image_width": F.lit(1224.0), "image_height": F.lit(1584.0), "page_width": F.lit(612.0), "page_height": F.lit(792.0)}
    label = F.get(F.array(*map(F.lit, _LABELS)), C("line_idx") % 7)
    boxes = lines_boxed(s, d).withColumns({"label": label, "position": F.lit(1000000) - C("line_idx"), "x0": C("x0") * 2, "y0": C("y0") * 2, "x1": C("x1") * 2 + 300, "y1": C("y1") * 2, **size})
    forced = L.forced_layout(lines_boxed(s, d).select("doc_id", (-1 - C("page_id")).alias("page_id")).distinct().withColumns(size), "Form")
    out = L.assign_labels(boxes, ("Handwriting",)).unionByName(forced)
    return out.select("doc_id", "page_id", "pos", "block_type", *[F.round(c, 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


_INSIDE = "greatest(0.0, least(e.x1, t.x1) - greatest(e.x0, t.x0)) * greatest(0.0, least(e.y1, t.y1) - greatest(e.y0, t.y0)) / ((e.x1 - e.x0) * (e.y1 - e.y0)) >= 0.75"


@_query(
    "j6_flag_bad_blocks",
    f""", b AS (SELECT doc_id, page_id, pos, CASE WHEN pos % 3 = 0 THEN '' ELSE trim(text) END AS text, pos % 2 = 0 AS has_ink, length(text) % 7 = 0 AS garbled, x0, y0, x1, y1 + CASE WHEN pos % 3 = 0 THEN 4 WHEN pos % 12 = 5 THEN 120 ELSE 0 END AS y1 FROM blocks),
e AS (SELECT * FROM b WHERE text = '' AND has_ink AND (x1 - x0) * (y1 - y0) >= 0.01 * 484704.0),
bad AS (SELECT doc_id, pos FROM e WHERE NOT EXISTS (SELECT 1 FROM b t WHERE t.doc_id = e.doc_id AND t.page_id = e.page_id AND t.pos <> e.pos AND t.text <> '' AND {_INSIDE}) UNION ALL SELECT doc_id, pos FROM b WHERE length(text) >= 50 AND garbled)
SELECT b.doc_id, b.page_id, b.pos, bad.pos IS NOT NULL AS reread, avg((bad.pos IS NOT NULL)::INT) OVER (PARTITION BY b.doc_id, b.page_id) > 0.5 AS promoted FROM b LEFT JOIN bad ON bad.doc_id = b.doc_id AND bad.pos = b.pos""",
    "blocks",
)
def _j6(s, d):
    third = C("pos") % 3 == 0
    b = blocks(s, d).withColumns({
        "garbled": F.length("text") % 7 == 0, "has_ink": C("pos") % 2 == 0, "y1": C("y1") + F.when(third, 4).when(C("pos") % 12 == 5, 120).otherwise(0), "text": F.when(third, "").otherwise(C("text")),
    })
    return L.flag_bad_blocks(b, 484704.0, "fast")


@_query(
    "m7_render_ocr_lines",
    """, b AS (SELECT *, CASE block_type WHEN 'Caption' THEN 'Equation' ELSE block_type END AS kind FROM blocks),
u AS (SELECT doc_id, page_id, 0 AS k, pos, block_id AS id, text AS html FROM b WHERE NOT removed AND kind = 'Table' AND length(text) > 0
  UNION ALL SELECT doc_id, page_id, 1, pos, '/page/' || page_id || '/Line/' || pos, text FROM b WHERE kind <> 'Equation' OR removed
  UNION ALL SELECT doc_id, page_id, 2, pos, block_id, text FROM b WHERE kind = 'Equation' AND NOT removed)
SELECT doc_id, page_id, md5(string_agg(id || '=' || md5(html), ',' ORDER BY k, pos)) AS children FROM u GROUP BY ALL""",
    "blocks",
)
def _m7(s, d):
    """Captions play equations, whose lines are theirs; tables carry html; every block has one line."""
    b = blocks(s, d).withColumns({"id": C("block_id"), "block_type": F.when(C("block_type") == "Caption", "Equation").otherwise(C("block_type"))})
    b = b.withColumn("html", F.when(C("block_type").isin("Table", "Equation"), C("text")).otherwise(""))
    li = b.select("doc_id", "page_id", F.concat(F.lit("/page/"), "page_id", F.lit("/Line/"), "pos").alias("id"), "pos", C("text").alias("html"), "x0", "y0", "x1", "y1", F.when(C("block_type") == "Equation", C("block_id")).alias("equation_id"))
    pages = L.render_ocr_lines(li, b)
    back = pages.select("doc_id", "page_id", F.from_json(F.to_json("children"), "array<struct<id:string,block_type:string,html:string,bbox:array<double>>>").alias("c"))
    return back.select("doc_id", "page_id", F.md5(F.array_join(F.transform("c", lambda x: F.concat(x["id"], F.lit("="), F.md5(x["html"]))), ",")).alias("children"))


# --- lessons

_OPEN = r""", m AS (SELECT *, length(trim(text)) <= 60 AND length(trim(text)) > 0 AND NOT regexp_matches(trim(text), '^\d+$') AS sh FROM blocks),
op AS (SELECT doc_id, page_id, CASE WHEN count(*) FILTER (WHERE sh) = 1 THEN arg_min(trim(text), pos) FILTER (WHERE sh) ELSE arg_min(trim(text), pos) FILTER (WHERE block_type = 'SectionHeader') END AS opening FROM m GROUP BY ALL)
"""


@_query(
    "c7_segment_lessons",
    _OPEN + """, mx AS (SELECT doc_id, max(page_id) AS pc FROM blocks GROUP BY ALL),
bd AS (SELECT doc_id, page_id AS fp, greatest(page_id, coalesce(lead(page_id) OVER (PARTITION BY doc_id ORDER BY page_id) - 1, pc)) AS lp, row_number() OVER (PARTITION BY doc_id ORDER BY page_id) AS number,
  CASE WHEN page_id % 8 = 6 THEN '' ELSE 'Lesson ' || page_id END AS toc, CASE WHEN page_id % 6 <> 4 THEN page_id // 2 + 1 END AS printed FROM (SELECT DISTINCT doc_id, page_id FROM blocks WHERE page_id % 2 = 0) JOIN mx USING (doc_id)),
mat AS (SELECT bd.doc_id, bd.fp, count(DISTINCT b.page_id) AS pages, count(*) FILTER (WHERE block_type = 'Picture') AS images, CAST(sum(CASE WHEN block_type NOT IN ('Picture', 'PageHeader', 'PageFooter') THEN length(text) ELSE 0 END) AS BIGINT) AS text_chars,
  md5(string_agg(block_id, ',' ORDER BY b.page_id, b.pos)) AS blocks FROM bd JOIN blocks b ON b.doc_id = bd.doc_id AND b.page_id BETWEEN fp AND lp GROUP BY ALL)
SELECT bd.doc_id, bd.doc_id || ':lesson:' || CASE WHEN number < 10 THEN '0' ELSE '' END || number AS id, CAST(number AS INT) AS number, coalesce(opening, nullif(toc, ''), 'درس ' || printed, 'بدون عنوان') AS title,
CASE WHEN opening IS NOT NULL THEN 'opening' WHEN toc <> '' THEN 'toc' ELSE 'fallback' END AS title_source, fp AS first_page, lp AS last_page, pages, images, text_chars, CASE WHEN text_chars <= 1000 THEN 'low' WHEN text_chars >= 2500 THEN 'high' ELSE 'medium' END AS density, blocks
FROM bd JOIN mat USING (doc_id, fp) LEFT JOIN op ON op.doc_id = bd.doc_id AND op.page_id = bd.fp""",
    "blocks",
)
def _c7(s, d):
    """A lesson starts at every second page; some have no number or title in the contents."""
    b = blocks(s, d)
    page = C("page_id")
    toc = b.select("doc_id", "page_id").distinct().where("page_id % 2 = 0").select(
        "doc_id", page.alias("seq"), page.alias("printed_page"), F.when(page % 6 != 4, F.expr("cast(page_id div 2 + 1 as int)")).alias("printed"),
        F.when(page % 8 == 6, "").otherwise(F.concat(F.lit("Lesson "), page.cast("string"))).alias("title"), (page % 4 == 0).alias("approximate"),
    )
    out = N.segment_lessons(toc, b, short=60)
    return out.select("doc_id", "id", "number", "title", "title_source", "first_page", "last_page", "pages", "images", "text_chars", "density", F.md5(F.array_join("block_ids", ",")).alias("blocks"))


@_query("a18_section_text", _SECT + "SELECT doc_id, section, CAST(sum(CASE WHEN block_type NOT IN ('Picture', 'PageHeader', 'PageFooter') THEN length(text) ELSE 0 END) AS BIGINT) AS text_chars, min(page_id) AS first_page, max(page_id) AS last_page, count(*) AS n_blocks FROM sec GROUP BY ALL", "blocks")
def _a18(s, d):
    b = blocks(s, d)
    starts = b.where("block_type = 'SectionHeader' and length(trim(text)) > 0").withColumn("section", C("block_id"))
    return N.section_text(K.blocks_to_sections(b, starts).join(b, ["doc_id", "pos"]), ["doc_id", "section"])


@_query(
    "c1_number_anchors",
    r""", n AS (SELECT doc_id, page_id, line_idx, round(CASE line_idx % 6 WHEN 0 THEN 40.0 + line_idx % 5 ELSE 10.0 + line_idx % 3 END, 1) AS h FROM lines_boxed WHERE line_idx % 2 = 0 OR regexp_matches(text, '^\s*[0-9]+\s*$')),
r AS (SELECT *, lead(h) OVER (PARTITION BY doc_id, page_id ORDER BY h) AS nxt FROM (SELECT DISTINCT doc_id, page_id, h FROM n)),
k AS (SELECT doc_id, page_id, nxt FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_id ORDER BY nxt / h DESC, h) AS rn FROM r WHERE nxt / h >= 3) WHERE rn = 1)
SELECT n.doc_id, n.page_id, n.line_idx FROM n JOIN k ON n.doc_id = k.doc_id AND n.page_id = k.page_id AND n.h >= k.nxt - 1e-3""",
    "lines_boxed",
)
def _c1(s, d):
    high = F.when(C("line_idx") % 6 == 0, 40.0 + C("line_idx") % 5).otherwise(10.0 + C("line_idx") % 3)
    li = lines_boxed(s, d).withColumns({"text": F.when(C("line_idx") % 2 == 0, C("line_idx").cast("string")).otherwise(C("text")), "y0": F.lit(0.0), "y1": high})
    return K.number_anchors(li).select("doc_id", "page_id", "line_idx")


# --- grounding

_G = """cl AS (SELECT package_id, id, min(evidence_level) AS claimed, min(confidence)::DOUBLE AS mc, min(CASE WHEN okey % 3 = 0 THEN 'low' ELSE 'high' END) AS density, min(label) AS label, min(lesson_id) AS lesson_id FROM concepts GROUP BY ALL),
ci AS (SELECT package_id, 'c' || substr(id, 2) AS id, block_id, CAST(substr(block_id, 2) AS INT) < 25 AND EXISTS (SELECT 1 FROM evidence u WHERE u.package_id = e.package_id AND u.block_id = e.block_id) AS own, quote_verified, printed_page, pdf_page FROM evidence e),
g AS (SELECT package_id, id, count(*) AS n, count(*) FILTER (WHERE quote_verified) AS nv, bool_or(quote_verified AND printed_page % 2 = 0) AS ex, bool_and(pdf_page % 3 = 0) AS vis FROM ci WHERE own GROUP BY ALL),
dr AS (SELECT package_id, id, count(DISTINCT CASE WHEN NOT own THEN block_id END) AS dropped FROM ci GROUP BY ALL),
v AS (SELECT cl.*, n, nv, ex, CASE WHEN claimed = 'explicit' AND nv = 0 THEN 'inferred' WHEN claimed = 'explicit' AND vis THEN 'needs_visual_review' ELSE claimed END AS level FROM cl JOIN g USING (package_id, id)),
s1 AS (SELECT *, round(CASE WHEN nv > 0 AND ex THEN 0.55 WHEN nv > 0 THEN 0.35 ELSE 0.0 END + CASE WHEN nv >= 2 THEN 0.1 ELSE 0.0 END + CASE WHEN level = 'explicit' AND nv > 0 THEN 0.1 ELSE 0.0 END, 4) AS a FROM v),
s2 AS (SELECT *, round(least(1.0, round(greatest(0.0, a - CASE WHEN density = 'low' THEN 0.1 ELSE 0.0 END), 4) + least(0.1, greatest(0.0, mc) * 0.1)), 4) AS b FROM s1),
sc AS (SELECT *, CASE WHEN level = 'needs_visual_review' THEN least(b, 0.5) ELSE b END AS confidence FROM s2)
SELECT package_id, id, level, confidence::DOUBLE AS confidence, CAST(dropped AS INT) AS dropped, package_id || ':concept:' || substr(sha256(package_id || '|concept|' || lower(label)), 1, 10) AS new_id,
concat_ws(',', CASE WHEN level = 'needs_visual_review' THEN 'image' END, CASE WHEN level <> claimed THEN 'demoted' END, CASE WHEN nv = 0 THEN 'no_quotation' END, CASE WHEN confidence < 0.6 THEN 'low' WHEN confidence < 0.85 THEN 'below_accept' END) AS reasons,
(SELECT min(o.id) FROM sc o WHERE o.package_id = sc.package_id AND o.lesson_id = sc.lesson_id AND o.label = sc.label AND o.id < sc.id) AS duplicate_of FROM sc JOIN dr USING (package_id, id)"""


@_query("c17_ground_concepts", _packages("SELECT 1 FROM concepts, evidence").rsplit("\n", 1)[0] + ",\n" + _G)
def _c17(s, d):
    """The unit of a package holds its blocks numbered under 25."""
    low = F.when(C("okey") % 3 == 0, "low").otherwise("high")
    proposals = books(s, d, "concepts").groupBy("package_id", "id").agg(F.min("evidence_level").alias("claimed_level"), F.min("confidence").cast("double").alias("model_confidence"), F.min(low).alias("density"), F.min("label").alias("label"), F.min("lesson_id").alias("lesson_id"))
    e = books(s, d, "evidence")
    cited = e.select(
        "package_id", F.concat(F.lit("c"), F.expr("substr(id, 2)")).alias("id"), "block_id", C("quote_verified").alias("matched"), F.when(C("printed_page") % 2 == 0, "exact").otherwise("token_overlap").alias("method"), F.when(C("pdf_page") % 3 == 0, "img").alias("asset_id"),
    )
    out = D.ground_concepts(proposals, cited, e.where("cast(substr(block_id, 2) as int) < 25"))
    return out.select("package_id", "id", "level", "confidence", "dropped", "new_id", F.array_join("reasons", ",").alias("reasons"), "duplicate_of")


@_query(
    "c17_ground_objectives",
    _packages("""SELECT p.package_id, p.id, CASE WHEN line % 2 = 0 THEN 'explicit' ELSE 'inferred' END AS level, CASE WHEN line % 2 = 0 THEN 0.65 ELSE 0.0 END::DOUBLE AS confidence, p.package_id || ':objective:' || substr(sha256(p.package_id || '|objective|' || statement), 1, 10) AS new_id, false AS crowded
FROM (SELECT package_id, id, min(cid1) AS cid, min(statement) AS statement, min(line) AS line FROM objectives GROUP BY ALL) p
WHERE EXISTS (SELECT 1 FROM objectives o JOIN concepts c ON c.package_id = o.package_id AND c.id = p.cid AND NOT c.bare AND c.eid = o.eid WHERE o.package_id = p.package_id AND o.id = p.id)"""),
)
def _c17b(s, d):
    o = books(s, d, "objectives")
    proposals = o.groupBy("package_id", "id").agg(F.min("cid1").alias("concept_id"), F.min("statement").alias("statement"), F.lit("explicit").alias("claimed_level"), F.lit(None).cast("double").alias("model_confidence"), F.lit("high").alias("density"))
    blocks_of = books(s, d, "concepts").select("package_id", C("id").alias("concept_id"), F.explode("evidence_ids").alias("block_id"))
    cited = o.select("package_id", "id", C("eid").alias("block_id"), (C("line") % 2 == 0).alias("matched"), F.lit("exact").alias("method"), F.lit(None).cast("string").alias("asset_id")).distinct()
    return D.ground_objectives(proposals, blocks_of, cited).select("package_id", "id", "level", "confidence", "new_id", "crowded")


# --- packages, sources and sinks


def _built(s, d) -> DataFrame:
    """Packages of the book tables; every tenth lacks a grade, and those with a lesson numbered 60 without text have an error."""
    number = F.expr("cast(substr(package_id, 2) as int)")
    ids = books(s, d, "lessons").select("package_id").distinct()
    rows = ids.select("package_id", F.when(number % 10 != 3, number % 6 + 1).alias("grade"), F.get(F.array(F.lit("science"), F.lit("reading")), number % 2).alias("subject"), F.concat(F.lit("Book "), number.cast("string")).alias("title"))
    kinds = {"lessons": ["lesson_number"], "concepts": ["label"], "objectives": ["statement"], "questions": ["question_type"]}
    entities = {k: books(s, d, k).select("package_id", "id", *more) for k, more in kinds.items()}
    prompts = books(s, d, "concepts").select("package_id", C("evidence_level").alias("stage"), F.lit("1.0").alias("version"))
    return N.build_packages(rows, entities, R.where(books(s, d, "lessons"), (C("lesson_number") == 60) & (C("text_chars") == 0), "STRUCT003"), prompts)


_BUILT = """ok AS (SELECT DISTINCT package_id, CAST(substr(package_id, 2) AS INT) AS k FROM lessons l WHERE CAST(substr(package_id, 2) AS INT) % 10 <> 3 AND NOT EXISTS (SELECT 1 FROM lessons x WHERE x.package_id = l.package_id AND x.lesson_number = 60 AND x.text_chars = 0))"""


def _with_built(sql: str) -> str:
    text = _packages(sql + " -- lessons")
    head, body = text.split("\n" + sql.split("\n")[0], 1)
    return head + ",\n" + _BUILT + "\n" + sql.split("\n")[0] + body.replace(" -- lessons", "")


_COUNTS = ", ".join(f"(SELECT count(*) FROM {k} e WHERE e.package_id = ok.package_id) AS n_{k}" for k in ("lessons", "concepts", "objectives", "questions"))


@_query("c18_build_packages", _with_built(f"""SELECT 'grade-' || (k % 6 + 1) || ':' || ['science', 'reading'][k % 2 + 1] || ':' || package_id AS name, package_id, {_COUNTS},
(SELECT count(DISTINCT evidence_level) FROM concepts e WHERE e.package_id = ok.package_id) AS n_prompts, (SELECT md5(coalesce(string_agg(id || '=' || label, ',' ORDER BY id, label), '')) FROM concepts e WHERE e.package_id = ok.package_id) AS concepts FROM ok"""))
def _c18(s, d):
    p = _built(s, d)
    listed = F.md5(F.array_join(F.transform(F.coalesce("concepts", F.array()), lambda c: F.concat(c["id"], F.lit("="), c["label"])), ","))
    return p.select("name", "package_id", *[C(f"stats.{k}").cast("long").alias(f"n_{k}") for k in ("lessons", "concepts", "objectives", "questions")], F.coalesce(F.when(C("prompts").isNotNull(), F.size("prompts")), F.lit(0)).cast("long").alias("n_prompts"), listed.alias("concepts"))


_PACKAGE = "package_id string, grade int, subject string, title string, lessons array<struct<id:string,lesson_number:int>>, concepts array<struct<id:string,label:string>>, objectives array<struct<id:string,statement:string>>, questions array<struct<id:string,question_type:string>>, prompts map<string,string>, stats struct<lessons:int,concepts:int,objectives:int,questions:int>"


def _written(s, d) -> DataFrame:
    path = Scratch(s, "packages").path("json")
    S.write_packages(_built(s, d), path)
    return S.read_packages(s, path, _PACKAGE)


@_query("s13_write_package", _with_built(f"SELECT package_id, k % 6 + 1 AS grade, ['science', 'reading'][k % 2 + 1] AS subject, {_COUNTS} FROM ok"))
def _s13(s, d):
    """Whole packages written by grade and subject and read back, with the stats that writing counts anew."""
    return _written(s, d).select("package_id", "grade", "subject", *[C(f"stats.{k}").cast("long").alias(f"n_{k}") for k in ("lessons", "concepts", "objectives", "questions")])


@_query("s8_read_packages", _with_built("SELECT c.package_id, c.id, c.statement FROM objectives c JOIN ok USING (package_id)"))
def _s8(s, d):
    """Every package under a folder, at any depth: the objectives they hold."""
    return _written(s, d).select("package_id", F.explode("objectives").alias("o")).select("package_id", "o.id", "o.statement")


@_query("s7_read_stage_artifacts", _packages("SELECT package_id, lesson_id, id, coalesce(model_id, 'of ' || lesson_id) AS model_id FROM concepts"))
def _s7(s, d):
    """One artifact a lesson, with its concepts; a concept without a model takes the artifact's."""
    path = Scratch(s, "artifacts").path("json")
    each = F.struct("id", F.struct("model_id").alias("provenance"))
    header = F.struct(F.concat(F.lit("of "), "lesson_id").alias("model_id"))
    books(s, d, "concepts").groupBy("package_id", "lesson_id").agg(F.collect_list(each).alias("concepts")).withColumn("provenance", header).write.json(path)
    found = S.read_stage_artifacts(s, f"{path}/*.json", "package_id string, lesson_id string", "concepts", "id string", "model_id string")
    return found.select("package_id", "lesson_id", "id", "provenance.model_id")


@_query("s1_read_files", "SELECT page_id % 7 AS bucket, count(*) AS n_lines, CAST(sum(octet_length(encode(coalesce(url, ''))) + 1) AS BIGINT) AS n_bytes FROM pages GROUP BY ALL")
def _s1(s, d):
    """URLs of pages written as text files by bucket, listed and read as binary files."""
    path = Scratch(s, "files").path("text")
    table(s, d, "pages").select((C("page_id") % 7).alias("bucket"), F.coalesce("url", F.lit("")).alias("value")).write.partitionBy("bucket").text(path)
    files = S.read_files(s, path)
    lines = F.size(F.split(F.decode("content", "UTF-8"), "\n")) - 1
    return files.select(F.regexp_extract("path", r"bucket=(\d+)", 1).cast("long").alias("bucket"), "length", lines.alias("n")).groupBy("bucket").agg(F.sum("n").cast("long").alias("n_lines"), F.sum("length").alias("n_bytes"))


@_query("s12_assets_from_images", "SELECT page_id, '_page_' || page_id || '_img.png' AS asset_id, length(coalesce(url, '')) AS n_bytes FROM pages UNION ALL SELECT page_id, 'fig.jpg', 3 FROM pages WHERE page_id % 2 = 0")
def _s12(s, d):
    """Image maps as asset rows."""
    one = F.create_map(F.concat(F.lit("/page/"), C("page_id").cast("string"), F.lit("/img.png")), F.base64(F.encode(F.coalesce("url", F.lit("")), "UTF-8")))
    images = F.when(C("page_id") % 2 == 0, F.map_concat(one, F.create_map(F.lit("fig.jpg"), F.base64(F.encode(F.lit("abc"), "UTF-8"))))).otherwise(one)
    assets = S.assets_from_images(table(s, d, "pages").select("page_id", images.alias("images")), ["page_id"])
    return assets.select("page_id", "asset_id", F.octet_length("content").cast("long").alias("n_bytes"))
