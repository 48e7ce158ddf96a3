"""Reports: what an extraction found page by page, what packages hold, what stages did and still have to do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.operators.aggregates import page_stats
from quire.operators.blocks import PAGE, document_toc

#: Fixed kinds of blocks.
TEXT_TYPES = ["Text", "TextInlineMath", "SectionHeader", "ListItem", "ListGroup", "Caption", "Footnote", "PageHeader", "PageFooter", "Code", "Table", "TableOfContents", "Form", "Equation", "Reference", "Handwriting", "ComplexRegion"]
PICTURE_TYPES, PICTURE_GROUPS = ["Picture", "Figure", "Diagram"], ["PictureGroup", "FigureGroup", "TableGroup"]
#: Kinds that a package counts, and those of them that people review.
COUNTED = ["lessons", "sections", "concepts", "objectives", "skills", "misconceptions", "relations", "activities", "questions", "evidence"]
REVIEWED = ["concepts", "objectives", "skills", "misconceptions", "relations", "activities", "questions"]


def page_diagnostics(blocks: DataFrame, lines: DataFrame, pages: DataFrame, picture: float = 0.30, recovered: float = 0.80, lettered: float = 0.50, least_lines: int = 10) -> DataFrame:
    """A row for each page: characters rendered and raw, their ratio (null without raw ones), pictures' share of the page, which kinds of
    blocks are there, whether the page is decorative, and why it is a candidate for recovery (null reasons: it isn't).

    ``blocks`` at the top of pages (block_type, text, box), ``lines`` (text, n_spans, n_single_char_spans), ``pages`` (doc_id, page_id, area).
    Reasons in order: pictures cover ``picture`` of the page, under ``recovered`` of the raw characters are rendered, raw lines but no text block.
    """
    shown = F.col("block_type").isin(PICTURE_TYPES + PICTURE_GROUPS)
    area = F.greatest(F.lit(0.0), F.col("x1") - F.col("x0")) * F.greatest(F.lit(0.0), F.col("y1") - F.col("y0"))
    has = lambda *kinds: F.coalesce(F.bool_or(F.col("block_type").isin(*kinds)), F.lit(False))
    b = blocks.groupBy(*PAGE).agg(
        F.sum(F.when(shown, area).otherwise(0.0)).alias("pictures"), F.sum(F.when(shown, 0).otherwise(F.char_length(F.coalesce("text", F.lit(""))))).alias("rendered_chars"),
        F.count_if(F.col("block_type").isin(TEXT_TYPES)).alias("n_text_blocks"), has(*PICTURE_TYPES).alias("has_picture"), has(*PICTURE_GROUPS).alias("has_picture_group"),
        has("PageHeader").alias("has_page_header"), has("PageFooter").alias("has_page_footer"),
    )
    li = lines.groupBy(*PAGE).agg(F.sum(F.char_length(F.btrim("text"))).alias("raw_chars"), F.count("*").alias("raw_lines"), F.sum("n_spans").alias("spans"), F.sum("n_single_char_spans").alias("single"))
    j = pages.select(*PAGE, F.when(F.col("area") > 0, F.col("area")).otherwise(1.0).alias("area")).join(b, PAGE, "left").join(li, PAGE, "left")
    j = j.na.fill(0, ["pictures", "rendered_chars", "n_text_blocks", "raw_chars", "raw_lines", "spans", "single"]).na.fill(False, ["has_picture", "has_picture_group", "has_page_header", "has_page_footer"])
    share = F.least(F.lit(1.0), F.col("pictures") / F.col("area"))
    ratio = F.when(F.col("raw_chars") > 0, F.col("rendered_chars") / F.col("raw_chars"))
    decorative = (F.col("raw_lines") >= least_lines) & (F.coalesce(F.try_divide("single", "spans"), F.lit(0.0)) >= lettered)
    reasons = F.array_compact(F.array(F.when(share >= picture, "picture_area"), F.when(ratio < recovered, "recovery_ratio"), F.when((F.col("n_text_blocks") == 0) & (F.col("raw_lines") > 0), "no_text_blocks")))
    return j.select(
        *PAGE, "raw_chars", "rendered_chars", F.bround(ratio, 4).alias("recovery_ratio"), "raw_lines", "n_text_blocks", F.bround(share, 4).alias("picture_share"), "has_picture", "has_picture_group",
        "has_page_header", "has_page_footer", decorative.alias("is_decorative"), F.when(F.size(reasons) > 0, F.array_join(reasons, ",")).alias("reasons"),
    )


def extraction_report(diagnostics: DataFrame, recovered: DataFrame, assets: DataFrame) -> DataFrame:
    """A row for each document: characters raw, rendered, recovered and in the end, their ratios, candidate pages, pages
    with recovered text, pages under 80 and 90 percent (numbers from 1), lines left out as duplicates, recovered blocks, assets, and what incomplete pages still miss.

    ``recovered``: doc_id, page_id, chars, n_lines, n_duplicates, n_blocks of each page with any; ``assets``: doc_id, page_id, a row each.
    """
    each = diagnostics.join(recovered, PAGE, "left").join(assets.groupBy(*PAGE).agg(F.count("*").alias("n_assets")), PAGE, "left")
    each = each.na.fill(0, ["chars", "n_lines", "n_duplicates", "n_blocks", "n_assets"])
    final = F.col("rendered_chars") + F.col("chars")
    # a page without raw text, or with none in the end, counts as whole
    ratio = F.coalesce(F.nullif(F.try_divide(final, F.col("raw_chars")), F.lit(0.0)), F.lit(1.0))
    page = F.col("page_id") + 1
    sum_ = lambda c: F.sum(c).cast("long")
    pages_below = lambda most: F.array_sort(F.collect_list(F.when(ratio < most, page)))
    of = lambda part: F.bround(F.when(sum_("raw_chars") > 0, sum_(part) / sum_("raw_chars")), 4)
    missing = F.when(ratio < 0.9, F.struct(page.alias("page"), (F.col("raw_chars") - final).alias("missing_chars")))
    return each.groupBy("doc_id").agg(
        F.count("*").alias("pages"), sum_("raw_chars").alias("raw_chars"), sum_("rendered_chars").alias("rendered_chars"), sum_("chars").alias("recovered_chars"), sum_(final).alias("final_chars"),
        of(final).alias("final_ratio"), of("rendered_chars").alias("rendered_ratio"), F.count_if(F.col("reasons").isNotNull()).alias("candidates"), F.count_if(F.col("n_lines") > 0).alias("pages_recovered"),
        pages_below(0.8).alias("below_80"), pages_below(0.9).alias("below_90"), sum_("n_duplicates").alias("duplicates_skipped"), sum_("n_blocks").alias("recovered_blocks"), sum_("n_assets").alias("assets"),
        F.array_sort(F.collect_list(missing)).alias("incomplete"),
    )


def document_metadata(blocks: DataFrame) -> DataFrame:
    """(doc_id, toc, pages): the headings in order (title, level, page, box) and each page's blocks by kind, for every document."""
    heading = F.struct("seq", "title", "heading_level", "page_id", F.array("x0", "y0", "x1", "y1").alias("bbox"))
    toc = document_toc(blocks).groupBy("doc_id").agg(F.sort_array(F.collect_list(heading)).alias("toc"))
    stats = blocks.select(*PAGE).distinct().join(page_stats(blocks), PAGE, "left")
    pages = stats.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page_id", F.coalesce("block_counts", F.lit("")).alias("block_counts"), F.coalesce("n_blocks", F.lit(0)).alias("n_blocks")))).alias("pages"))
    none = F.array().cast(toc.schema["toc"].dataType)
    return pages.join(toc, "doc_id", "left").select("doc_id", F.coalesce("toc", none).alias("toc"), "pages")


def package_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """A row for each package: how many of each kind it holds, verified quotations, and how many entities await or had a review.

    ``tables`` by name (``COUNTED``): package_id; evidence with quote_verified, reviewed kinds with requires_review and review_status.
    """
    blank = {"quote_verified": F.lit(False), "requires_review": F.lit(False), "review_status": F.lit(None).cast("string")}
    parts = [df.select("package_id", F.lit(name).alias("kind"), *[(F.col(c) if c in df.columns else x).alias(c) for c, x in blank.items()]) for name, df in tables.items()]
    review = F.col("kind").isin(REVIEWED)
    return reduce(DataFrame.unionByName, parts).groupBy("package_id").agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in COUNTED], F.count_if((F.col("kind") == "evidence") & F.col("quote_verified")).alias("quotations_verified"),
        F.count_if(review & F.col("requires_review") & (F.col("review_status") == "pending")).alias("awaiting_review"), F.count_if(review & (F.col("review_status") != "pending")).alias("reviewed"),
    )


def stats_differences(stated: DataFrame, actual: DataFrame) -> DataFrame:
    """(package_id, field, says, holds): stated counts that the content doesn't bear out."""
    fields = [c for c in actual.columns if c != "package_id"]
    long = lambda df, name: df.select("package_id", F.explode(F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f))])).alias("field", name))
    return long(stated, "says").join(long(actual, "holds"), ["package_id", "field"]).where(~F.col("says").eqNullSafe(F.col("holds")))


def registry_summary(packages: DataFrame, entities: DataFrame) -> DataFrame:
    """(grade, packages, subjects, n_entities) of a registry; ``packages``: package_id, grade, subject; ``entities``: package_id, id."""
    n = entities.groupBy("package_id").agg(F.count("*").alias("n_entities"))
    j = packages.join(n, "package_id", "left")
    return j.groupBy("grade").agg(F.sort_array(F.collect_set("package_id")).alias("packages"), F.sort_array(F.collect_set("subject")).alias("subjects"), F.coalesce(F.sum("n_entities"), F.lit(0)).alias("n_entities"))


def find_packages(packages: DataFrame, asked: DataFrame) -> DataFrame:
    """The package of each (grade, subject) that is asked for, the first by id, or null."""
    first = packages.groupBy("grade", "subject").agg(F.min("package_id").alias("package_id"))
    return asked.join(first, ["grade", "subject"], "left")


def confidence_summary(entities: DataFrame, thresholds: tuple[float, ...] = (0.85, 0.80, 0.75, 0.70)) -> DataFrame:
    """A row for each package: least, mean and greatest confidence, what awaits review, flags of wording, how many entities there are of each type
    (``type=n`` by name), and for each threshold how many reach it, and reach it with no other reason for a review.

    ``entities``: package_id, confidence, review_status, type, n_wording, other_reasons (whether there is one).
    """
    kinds = entities.groupBy("package_id", "type").agg(F.count("*").alias("n")).groupBy("package_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("type", "n"))), lambda k: F.concat_ws("=", k["type"], k["n"].cast("string"))), ",").alias("types"))
    reach = [F.count_if(F.col("confidence") >= t).alias(f"over_{int(100 * t)}") for t in thresholds] + [F.count_if((F.col("confidence") >= t) & ~F.col("other_reasons")).alias(f"clear_{int(100 * t)}") for t in thresholds]
    out = entities.groupBy("package_id").agg(
        F.min("confidence").alias("least"), F.bround(F.avg("confidence"), 3).alias("mean"), F.max("confidence").alias("most"), F.count("*").alias("n"), F.count_if(F.col("review_status") == "pending").alias("awaiting"),
        F.count_if(F.col("n_wording") > 0).alias("wording_flags"), *reach,
    )
    return out.join(kinds, "package_id")


def stage_summary(lessons: DataFrame, proposals: DataFrame, prompts: DataFrame) -> DataFrame:
    """A row for each lesson: prompt size, proposals, accepted ones, rejected ones by reason (``reason=n`` by name), ungrounded ones, dropped
    citations, evidence, what needs review, and concepts by type.

    ``lessons``: package_id, lesson_id; ``proposals``: package_id, lesson_id, outcome (``accepted`` or a reason), grounded, n_dropped, n_evidence,
    needs_review, type; ``prompts``: package_id, lesson_id, text.
    """
    keys = ["package_id", "lesson_id"]
    accepted = F.col("outcome") == "accepted"
    kept = accepted & F.col("grounded")
    tally = lambda which, name: proposals.where(which).groupBy(*keys, F.col(name).alias("k")).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "n"))), lambda x: F.concat_ws("=", x["k"], x["n"].cast("string"))), ",").alias("tally"))
    n = proposals.groupBy(*keys).agg(
        F.count("*").alias("raw"), F.count_if(kept).alias("accepted"), F.count_if(~accepted).alias("rejected"), F.count_if(accepted & ~F.col("grounded")).alias("ungrounded"), F.sum("n_dropped").alias("dropped_citations"),
        F.sum(F.when(kept, F.col("n_evidence")).otherwise(0)).alias("evidence"), F.count_if(kept & F.col("needs_review")).alias("needs_review"),
    )
    out = lessons.select(*keys).join(prompts.select(*keys, F.char_length("text").alias("prompt_chars")), keys, "left").join(n, keys, "left")
    out = out.join(tally(~accepted, "outcome").withColumnRenamed("tally", "reasons"), keys, "left").join(tally(kept, "type").withColumnRenamed("tally", "types"), keys, "left")
    return out.na.fill(0, ["raw", "accepted", "rejected", "ungrounded", "dropped_citations", "evidence", "needs_review"]).na.fill("", ["reasons", "types"])


def resumable_work(lessons: DataFrame, concept_artifacts: DataFrame, objective_artifacts: DataFrame) -> DataFrame:
    """What each lesson's stages have to do (``to_do``): ``concepts`` where they have no artifact; ``objectives`` where those have one and these don't;
    nothing (null) once both are there. The objectives stage isn't asked of a lesson without concepts.

    All three: package_id, lesson_id; an artifact may be listed more than once.
    """
    keys = ["package_id", "lesson_id"]
    have = lambda df, name: df.select(*keys).distinct().withColumn(name, F.lit(True))
    j = lessons.select(*keys).join(have(concept_artifacts, "has_concepts"), keys, "left").join(have(objective_artifacts, "has_objectives"), keys, "left").na.fill(False)
    to_do = F.when(~F.col("has_concepts"), "concepts").when(~F.col("has_objectives"), "objectives")
    return j.withColumn("to_do", to_do)


def work_report(work: DataFrame) -> DataFrame:
    """A row for each package: lessons, those with either artifact, and those with something left to do."""
    left = ~(F.col("has_concepts") & F.col("has_objectives"))
    return work.groupBy("package_id").agg(F.count("*").alias("lessons"), F.count_if("has_concepts").alias("concepts_done"), F.count_if("has_objectives").alias("objectives_done"), F.count_if(left).alias("remaining"), F.count_if(F.col("to_do") == "objectives").alias("objectives_to_do"))


# --- lookups, limits and set operations


def merge_evidence(*tables: DataFrame, order: list[str]) -> DataFrame:
    """One row per id of all tables (id, columns of ``order``, source); the first table wins, inside it the least by ``order``."""
    both = reduce(DataFrame.unionByName, [t.select("id", *order, F.lit(n).alias("source")) for n, t in enumerate(tables)])
    return both.groupBy("id").agg(F.min(F.struct("source", *order)).alias("m")).select("id", *[f"m.{c}" for c in order], "m.source")


def lookup(asked: DataFrame, known: DataFrame, expected: str) -> DataFrame:
    """Each asked id with its kind and package, null where there is none or of another kind. ``known``: id, kind, package_id."""
    found = known.where(F.col("kind") == expected).select(F.col("id").alias("asked"), "kind", "package_id")
    return asked.join(found, "asked", "left")


def first_of_each(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each key in order; a limit is the feature."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def uncovered_pages(pages: DataFrame, covered: DataFrame) -> DataFrame:
    """Pages of no lesson."""
    return pages.select(*PAGE).distinct().join(covered.select(*PAGE), PAGE, "left_anti")


def orphan_blocks(blocks: DataFrame, sectioned: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks that no section has."""
    return blocks.join(sectioned.select(*keys), keys, "left_anti")


def render_code(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, code): lines in order (line_idx), indented by their left edge over the mean width of a character."""
    w = W.partitionBy(*keys)
    li = lines.withColumns({"_left": F.min("x0").over(w), "_wide": F.sum(F.col("x1") - F.col("x0")).over(w) / F.greatest(F.lit(1), F.sum(F.char_length("text")).over(w))})
    pad = F.when(F.col("_wide") == 0, "").otherwise(F.repeat(F.lit(" "), F.greatest(F.lit(0), F.floor((F.col("x0") - F.col("_left")) / F.col("_wide"))).cast("int")))
    each = F.sort_array(F.collect_list(F.struct("line_idx", F.concat(pad, "text").alias("t"))))
    return li.groupBy(*keys).agg(F.regexp_replace(F.array_join(F.transform(each, lambda x: x["t"]), "\n"), r"[ \n]+$", "").alias("code"))
