"""Integrity rules over content tables: each returns findings (code, severity, package_id, entity_id, detail).

References are equi-joins on (package, id): an anti-join of exploded id lists against the owners. No rule
gathers a package into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions.text import id_slug
from quire.operators.objectives import type_fits

#: Severity of each code: fixed values of the rule set.
SEVERITY = {
    "STRUCT001": "error", "STRUCT002": "error", "STRUCT003": "error", "STRUCT004": "error", "STRUCT005": "warning", "STRUCT006": "error", "STRUCT007": "error", "STRUCT008": "error",
    "STRUCT009": "warning", "STRUCT010": "warning", "STRUCT011": "warning", "STRUCT012": "error", "STRUCT013": "warning", "EVID001": "error", "EVID002": "error", "EVID003": "error",
    "EVID004": "error", "EVID005": "warning", "EVID006": "error", "EVID007": "warning", "PEDA001": "review", "PEDA002": "error", "PEDA003": "warning", "PEDA004": "error", "PEDA005": "review",
    "PEDA006": "error", "PEDA007": "error", "PEDA008": "warning", "PEDA009": "review", "PEDA010": "review", "PEDA011": "review", "FINAL001": "error", "FINAL002": "error", "FINAL003": "warning",
    "FINAL004": "warning", "PROV001": "error", "PROV002": "error", "LINK001": "error", "LINK002": "error", "LINK003": "error", "LINK004": "warning", "LINK005": "error", "LINK006": "warning",
    "LINK007": "warning", "QUEST001": "error", "QUEST002": "error", "QUEST003": "error",
}


def findings(df: DataFrame, code: str, entity: Column | str = "id", detail: Column | None = None) -> DataFrame:
    entity = F.col(entity) if isinstance(entity, str) else entity
    return df.select(F.lit(code).alias("code"), F.lit(SEVERITY[code]).alias("severity"), "package_id", entity.cast("string").alias("entity_id"), (F.lit("") if detail is None else detail.cast("string")).alias("detail"))


def missing_fields(books: DataFrame, fields: list[str]) -> DataFrame:
    """STRUCT001: identity fields that are null or empty."""
    gaps = F.array_compact(F.array(*[F.when(F.coalesce(F.length(F.btrim(F.col(f).cast("string"))), F.lit(0)) == 0, F.lit(f)) for f in fields]))
    return findings(books.withColumn("gap", F.explode(gaps)), "STRUCT001", "package_id", F.col("gap"))


def page_ranges(lessons: DataFrame) -> DataFrame:
    """STRUCT003: reversed, before the first page, or past the last."""
    wrong = F.when(F.col("pdf_start") < 1, "before").when(F.col("pdf_start") > F.col("pdf_end"), "reversed").when(F.col("pdf_end") > F.col("page_count"), "past_end")
    return findings(lessons.withColumn("wrong", wrong).where("wrong is not null"), "STRUCT003", "id", F.col("wrong"))


def overlapping_lessons(lessons: DataFrame) -> DataFrame:
    """STRUCT004: a lesson that starts at or before the end of the one before it."""
    w = W.partitionBy("package_id").orderBy("pdf_start", "id")
    return findings(lessons.withColumn("end_before", F.lag("pdf_end").over(w)).where("pdf_start <= end_before"), "STRUCT004")


def numbering(lessons: DataFrame) -> DataFrame:
    """STRUCT005: a lesson whose number isn't over that of the one before it in page order."""
    w = W.partitionBy("package_id").orderBy("pdf_start", "id")
    return findings(lessons.withColumn("before", F.lag("lesson_number").over(w)).where("lesson_number <= before"), "STRUCT005")


def missing_references(owners: DataFrame, ids: str, targets: DataFrame, code: str) -> DataFrame:
    """Ids in a list (or a single id) that no target of the package has: STRUCT006-8, EVID002-3, PEDA002, FINAL003, LINK001."""
    listed = F.explode(ids) if dict(owners.dtypes)[ids].startswith("array") else F.col(ids)
    each = owners.select("package_id", "id", listed.alias("ref"))
    gone = each.join(targets.select("package_id", F.col("id").alias("ref")), ["package_id", "ref"], "left_anti")
    return findings(gone.where("ref is not null"), code, "id", F.col("ref"))


def where(df: DataFrame, condition: Column, code: str, detail: Column | None = None) -> DataFrame:
    """Rows that meet a condition: STRUCT009, EVID001, PEDA001, PEDA011, PROV001, PROV002, LINK002, QUEST001-3."""
    return findings(df.where(condition), code, "id", detail)


def unverified_explicit(entities: DataFrame, evidence: DataFrame) -> DataFrame:
    """EVID004: explicit entities none of whose quotations is verified."""
    e = entities.where("evidence_level = 'explicit'").select("package_id", "id", F.explode_outer("evidence_ids").alias("ref"))
    j = e.join(evidence.select("package_id", F.col("id").alias("ref"), "quote_verified"), ["package_id", "ref"], "left")
    return findings(j.groupBy("package_id", "id").agg(F.bool_or(F.coalesce("quote_verified", F.lit(False))).alias("ok")).where("not ok"), "EVID004")


def evidence_outside_lesson(entities: DataFrame, evidence: DataFrame, lessons: DataFrame) -> DataFrame:
    """EVID005: evidence pages outside the entity's lesson."""
    e = entities.select("package_id", "id", "lesson_id", F.explode("evidence_ids").alias("ref"))
    j = e.join(evidence.select("package_id", F.col("id").alias("ref"), "pdf_page"), ["package_id", "ref"]).join(lessons.select("package_id", F.col("id").alias("lesson_id"), "pdf_start", "pdf_end"), ["package_id", "lesson_id"])
    return findings(j.where(~F.col("pdf_page").between(F.col("pdf_start"), F.col("pdf_end"))), "EVID005", "id", F.col("ref"))


def mostly_inferred(entities: DataFrame, share: float = 0.85, least: int = 5) -> DataFrame:
    """EVID007: packages of at least five entities, over 85 % inferred."""
    g = entities.groupBy("package_id").agg(F.count("*").alias("n"), F.avg((F.col("evidence_level") == "inferred").cast("int")).alias("share"))
    return findings(g.where((F.col("n") >= least) & (F.col("share") > share)), "EVID007", "package_id")


def repeated(df: DataFrame, keys: list[str], order: list[str], code: str) -> DataFrame:
    """A later row with the same key: PEDA003, PEDA008, FINAL004, LINK007."""
    w = W.partitionBy("package_id", *keys).orderBy(*order)
    return findings(df.withColumn("n", F.row_number().over(w)).where("n > 1"), code)


def objectives_outside_concepts(objectives: DataFrame, concepts: DataFrame, evidence: DataFrame) -> DataFrame:
    """PEDA006: blocks an objective cites that its concepts don't."""
    block = evidence.select("package_id", F.col("id").alias("ref"), "block_id")
    mine = objectives.select("package_id", "id", F.explode("evidence_ids").alias("ref")).join(block, ["package_id", "ref"]).select("package_id", "id", "block_id").distinct()
    named = objectives.select("package_id", "id", F.explode("concept_ids").alias("cid"))
    theirs = concepts.select("package_id", F.col("id").alias("cid"), F.explode("evidence_ids").alias("ref")).join(block, ["package_id", "ref"])
    allowed = named.join(theirs, ["package_id", "cid"]).select("package_id", "id", "block_id").distinct()
    return findings(mine.join(allowed, ["package_id", "id", "block_id"], "left_anti"), "PEDA006", "id", F.col("block_id"))


def objective_lesson(objectives: DataFrame, concepts: DataFrame) -> DataFrame:
    """PEDA007: an objective in another lesson than one of its concepts."""
    j = objectives.select("package_id", "id", "lesson_id", F.explode("concept_ids").alias("cid")).join(concepts.select("package_id", F.col("id").alias("cid"), F.col("lesson_id").alias("theirs")), ["package_id", "cid"])
    return findings(j.where("lesson_id <> theirs"), "PEDA007", "id", F.col("cid"))


def relation_faults(relations: DataFrame, known: DataFrame, types: list[str]) -> DataFrame:
    """FINAL001: unknown type, an end that doesn't exist, or an edge onto itself; one row for each fault."""
    ids = known.select("package_id", F.col("id").alias("end"), F.lit(True).alias("here"))
    r = relations.join(ids.withColumnsRenamed({"end": "source_id", "here": "s"}), ["package_id", "source_id"], "left").join(ids.withColumnsRenamed({"end": "target_id", "here": "t"}), ["package_id", "target_id"], "left")
    faults = F.array_compact(F.array(
        F.when(~F.col("relation_type").isin(types), F.lit("type")), F.when(F.col("s").isNull(), F.lit("source")), F.when(F.col("t").isNull(), F.lit("target")), F.when(F.col("source_id") == F.col("target_id"), F.lit("self")),
    ))
    return findings(r.withColumn("fault", F.explode(faults)), "FINAL001", "id", F.col("fault"))


def prerequisite_cycles(relations: DataFrame, scratch) -> DataFrame:
    """FINAL002: packages whose prerequisite edges hold a cycle.

    Edges whose source has no incoming edge, or whose target no outgoing one, are stripped until none is
    left to strip; what remains lies on or between cycles. Each round reads a written table and rounds go on until
    nothing changes: half the longest chain of a package, whatever the number of packages. Both sides are as large as the edges, so
    neither goes through the driver.
    """
    edges = scratch.keep(relations.where("relation_type = 'prerequisite' and source_id <> target_id").select("package_id", "source_id", "target_id").distinct(), "edges")
    before = edges.count()
    while True:
        heads = edges.select("package_id", F.col("target_id").alias("source_id")).distinct().hint("merge")
        tails = edges.select("package_id", F.col("source_id").alias("target_id")).distinct().hint("merge")
        left = scratch.keep(edges.join(heads, ["package_id", "source_id"], "left_semi").join(tails, ["package_id", "target_id"], "left_semi"), "edges")
        scratch.drop(edges)
        edges, now = left, left.count()
        if now in (0, before):
            break
        before = now
    return findings(edges.select("package_id").distinct(), "FINAL002", "package_id")


def unbacked_prerequisites(relations: DataFrame, evidence: DataFrame) -> DataFrame:
    """LINK003: prerequisites neither authored nor with a verified quotation; of evidence with one id any verified row counts."""
    r = relations.where("relation_type = 'prerequisite' and authored_by is null").select("package_id", "id", F.explode_outer("evidence_ids").alias("ref"))
    j = r.join(evidence.select("package_id", F.col("id").alias("ref"), "quote_verified"), ["package_id", "ref"], "left")
    return findings(j.groupBy("package_id", "id").agg(F.bool_or(F.coalesce("quote_verified", F.lit(False))).alias("ok")).where("not ok"), "LINK003")


def skills_one_sided(skills: DataFrame, objectives: DataFrame) -> DataFrame:
    """LINK005: a skill lists an objective that names another skill or none."""
    s = skills.select("package_id", F.col("id").alias("sid"), F.explode("objective_ids").alias("oid"))
    j = s.join(objectives.select("package_id", F.col("id").alias("oid"), "skill_id"), ["package_id", "oid"])
    return findings(j.where(~F.col("skill_id").eqNullSafe(F.col("sid"))), "LINK005", "sid", F.col("oid")).distinct()


def uncovered(all_rows: DataFrame, covered: DataFrame, keys: list[str], code: str, entity: str) -> DataFrame:
    """Rows that no covering row names: STRUCT010, STRUCT011, STRUCT012, STRUCT013."""
    return findings(all_rows.join(covered.select(*keys).distinct(), keys, "left_anti"), code, entity)


def misconception_guards(items: DataFrame, concepts: DataFrame, evidence: DataFrame) -> DataFrame:
    """PEDA004: a misconception of an unknown concept, not marked for a person, or explicit without a verified quotation; a row for each fault.

    ``items``: package_id, id, concept_id, requires_human_review, evidence_level, evidence_ids.
    """
    known = concepts.select("package_id", F.col("id").alias("concept_id")).distinct()
    return (
        findings(items.join(known, ["package_id", "concept_id"], "left_anti"), "PEDA004", "id", F.lit("unknown_concept"))
        .unionByName(findings(items.where(~F.coalesce("requires_human_review", F.lit(False))), "PEDA004", "id", F.lit("not_for_review")))
        .unionByName(unverified_explicit(items, evidence).withColumns({"code": F.lit("PEDA004"), "severity": F.lit(SEVERITY["PEDA004"]), "detail": F.lit("unverified")}))
    )


def foreign_wording(entities: DataFrame, code: str, most: int = 8) -> DataFrame:
    """PEDA005, PEDA009: entities with words their lesson never uses (``foreign_words``); the first few are named."""
    return findings(entities.where(F.size("foreign_words") > 0), code, "id", F.array_join(F.slice("foreign_words", 1, most), "، "))


def unsuitable_type(objectives: DataFrame, concepts: DataFrame) -> DataFrame:
    """PEDA010: an objective of a kind that doesn't suit one of its concepts."""
    each = objectives.select("package_id", "id", "objective_type", F.explode("concept_ids").alias("cid"))
    j = each.join(concepts.select("package_id", F.col("id").alias("cid"), "concept_type"), ["package_id", "cid"])
    return findings(j.where(~type_fits(F.col("objective_type"), F.col("concept_type"))), "PEDA010", "id", F.col("cid"))


def idle_skills(skills: DataFrame, objectives: DataFrame) -> DataFrame:
    """LINK004: a skill that groups no objective, or repeats the statement of its only one."""
    n = F.coalesce(F.size("objective_ids"), F.lit(0))
    none = findings(skills.where(n <= 0), "LINK004", "id", F.lit("no_objective"))
    only = skills.where(n == 1).select("package_id", "id", "label", F.get("objective_ids", F.lit(0)).alias("oid"))
    j = only.join(objectives.select("package_id", F.col("id").alias("oid"), "statement").distinct(), ["package_id", "oid"])
    return none.unionByName(findings(j.where(id_slug(F.col("statement")) == id_slug(F.col("label"))), "LINK004", "id", F.lit("restates")))


def stray_questions(activities: DataFrame, questions: DataFrame) -> DataFrame:
    """LINK006: a question of an activity that measures none of the objectives it serves; ``questions``: package_id, id, objective_ids."""
    each = activities.where(F.size("objective_ids") > 0).select("package_id", "id", "objective_ids", F.explode("question_ids").alias("qid"))
    j = each.join(questions.select("package_id", F.col("id").alias("qid"), F.col("objective_ids").alias("measured")), ["package_id", "qid"])
    return findings(j.where(~F.coalesce(F.arrays_overlap("objective_ids", "measured"), F.lit(False))), "LINK006", "id", F.col("qid"))
