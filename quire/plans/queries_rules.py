"""Queries of the integrity rules, traversals and package operators over books made from orders, lines and parts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.operators import entities as E
from quire.operators import rules as R
from quire.operators.claims import ACTIVITY_TYPES, GRADING, answer_key, grading_mode
from quire.session import Scratch, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# One text for both engines: a package is a range of 100 orders (parts), so packages grow in number and not in size;
# a lesson is an order, a concept or objective a line, a relation a pair of neighbouring parts; a few keys break each rule.
_PK = "concat('p', cast(floor({k} / 100) as bigint))"
FIXTURES = {
    "lessons": f"""SELECT {_PK.format(k="o_orderkey")} AS package_id, concat('l', o_orderkey) AS id, o_orderkey % 61 AS lesson_number, o_orderkey % 251 AS pdf_start,
  o_orderkey % 251 + o_orderkey % 7 - 1 AS pdf_end, 250 AS page_count, o_custkey % 9 * 100 AS text_chars FROM orders""",
    "concepts": f"""SELECT {_PK.format(k="l_orderkey")} AS package_id, concat('c', l_orderkey, '-', l_linenumber) AS id, CASE WHEN l_partkey % 97 = 0 THEN 'lx' ELSE concat('l', l_orderkey) END AS lesson_id, l_orderkey AS okey, l_linenumber AS line,
  concat('Part ', l_partkey % 5) AS label, l_partkey % 13 = 0 AS bare, CASE l_linenumber % 3 WHEN 0 THEN 'explicit' WHEN 1 THEN 'inferred' ELSE 'human' END AS evidence_level,
  concat('e', l_orderkey, '-', l_linenumber) AS eid, CASE WHEN l_suppkey % 17 > 0 THEN 'm1' END AS model_id, CASE WHEN l_suppkey % 4 = 0 THEN 'accepted' ELSE 'pending' END AS review_status,
  CASE WHEN l_suppkey % 8 = 0 THEN 'someone' END AS reviewed_by, (l_partkey % 100) / 100.0 AS confidence FROM lineitem""",
    "evidence": f"""SELECT {_PK.format(k="l_orderkey")} AS package_id, concat('e', l_orderkey, '-', l_linenumber) AS id, concat('b', l_partkey % 50) AS block_id, l_orderkey % 251 + l_linenumber % 4 AS pdf_page,
  l_orderkey % 251 + l_linenumber % 4 - 3 + CASE WHEN l_partkey % 31 = 0 THEN 1 ELSE 0 END AS printed_page, l_partkey % 5 > 0 AS quote_verified FROM lineitem WHERE l_suppkey % 11 <> 0""",
    "objectives": f"""SELECT {_PK.format(k="l_orderkey")} AS package_id, concat('o', l_orderkey, '-', l_linenumber) AS id, concat('l', l_orderkey + CASE WHEN l_partkey % 89 = 0 THEN 1 ELSE 0 END) AS lesson_id,
  concat('c', l_orderkey, '-', l_linenumber) AS cid1, concat('c', l_orderkey, '-', l_linenumber - 1) AS cid2, concat('e', l_orderkey, '-', l_linenumber - l_partkey % 3) AS eid, l_partkey % 6 > 0 AS observable,
  CASE l_partkey % 4 WHEN 0 THEN 'نشان دهد' WHEN 1 THEN 'دانش آموز بداند' WHEN 2 THEN 'نام ببرد' ELSE 'درک کند که' END AS statement, CASE WHEN l_partkey % 3 = 0 THEN concat('s', l_orderkey) END AS skill_id, l_orderkey AS okey, l_linenumber AS line FROM lineitem""",
    "relations": f"""SELECT {_PK.format(k="p_partkey")} AS package_id, concat('r', p_partkey) AS id, p_partkey AS source_id, p_partkey + CASE WHEN p_partkey % 53 = 0 THEN 0 ELSE 7 END AS target_id,
  CASE p_partkey % 29 WHEN 0 THEN 'friend' WHEN 1 THEN 'part_of' ELSE 'prerequisite' END AS relation_type, CASE WHEN p_partkey % 3 = 0 THEN 'someone' END AS authored_by FROM part""",
    "questions": f"""SELECT {_PK.format(k="o_orderkey")} AS package_id, concat('q', o_orderkey) AS id, CASE o_orderkey % 9 WHEN 0 THEN 'riddle' WHEN 1 THEN 'true_false' WHEN 2 THEN 'multiple_choice' WHEN 3 THEN 'long_answer' WHEN 4 THEN 'handwriting' ELSE 'short_answer' END AS question_type, CASE WHEN o_custkey % 8 = 0 THEN 'manual' END AS grading,
  CASE WHEN o_custkey % 5 > 0 THEN 'yes' END AS answer, o_custkey % 4 AS n_options, o_custkey % 3 AS n_correct, o_custkey % 7 = 0 AS shared, CASE WHEN o_custkey % 10 > 0 THEN concat('o', o_orderkey, '-1') END AS oid FROM orders""",
    "sections": f"""SELECT {_PK.format(k="o_orderkey")} AS package_id, concat(CASE WHEN o_custkey % 41 = 0 THEN 'l' ELSE 'x' END, o_orderkey) AS id FROM orders""",
    "misconceptions": f"""SELECT {_PK.format(k="o_orderkey")} AS package_id, concat('m', o_orderkey % 50) AS id FROM orders""",
    "skills": f"""SELECT {_PK.format(k="o_orderkey")} AS package_id, concat('s', o_orderkey) AS id, concat('c', o_orderkey, '-1') AS cid, concat('o', o_orderkey, '-', 1 + o_custkey % 3) AS oid,
  concat(CASE WHEN o_custkey % 11 = 0 THEN 'q' ELSE 'l' END, o_orderkey) AS lid FROM orders WHERE o_custkey % 5 > 0""",
    "activities": f"""SELECT {_PK.format(k="o_orderkey")} AS package_id, concat('a', o_orderkey) AS id, concat('o', o_orderkey, '-1') AS oid,
  CASE WHEN o_custkey % 7 = 0 THEN concat('o', o_orderkey, '-1') WHEN o_custkey % 13 = 0 THEN concat('e', o_orderkey, '-1') ELSE concat('q', o_orderkey) END AS qid,
  CASE o_custkey % 6 WHEN 0 THEN 'dance' WHEN 1 THEN 'game' WHEN 2 THEN 'review' WHEN 3 THEN 'visual' ELSE 'practice' END AS activity_type FROM orders""",
    "offsets": f"""SELECT {_PK.format(k="o_orderkey")} AS package_id, max(CASE WHEN floor(o_orderkey / 100) % 4 = 0 THEN NULL ELSE 2 + floor(o_orderkey / 100) % 3 END) AS page_offset FROM orders GROUP BY 1""",
}


def books(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A content table, with its id lists as arrays."""
    from_table = {"lessons": "orders", "concepts": "lineitem", "evidence": "lineitem", "objectives": "lineitem", "relations": "part"}.get(name, "orders")
    df = spark.sql(FIXTURES[name].replace(f"FROM {from_table}", "FROM {src}"), src=table(spark, sf_dir, from_table))
    if name == "concepts":
        df = df.withColumn("evidence_ids", F.when(F.col("bare"), F.array().cast("array<string>")).otherwise(F.array("eid")))
    if name == "objectives":
        df = df.withColumns({"concept_ids": F.when(F.col("line") > 1, F.array("cid1", "cid2")).otherwise(F.array("cid1")), "evidence_ids": F.array("eid")})
    if name == "skills":
        df = df.withColumns({"concept_ids": F.array("cid"), "objective_ids": F.array("oid"), "lesson_ids": F.array("lid")})
    if name == "activities":
        df = df.withColumns({"objective_ids": F.array("oid"), "question_ids": F.array("qid")})
    if name == "questions":
        option = lambda i: F.struct(F.when(F.col("shared"), F.lit(1)).otherwise(i).cast("string").alias("option_id"), (i <= F.col("n_correct")).alias("is_correct"))
        none = F.array().cast("array<struct<option_id: string, is_correct: boolean>>")
        options = F.when(F.col("n_options") > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.col("n_options").cast("int"), F.lit(1))), option)).otherwise(none)
        df = df.withColumns({"objective_ids": F.array("oid"), "options": options})
    if name == "relations":
        df = df.withColumn("evidence_ids", F.when(F.col("source_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("e"), F.col("source_id").cast("string"), F.lit("-1")))))
    return df


_EACH_C = "SELECT package_id, id, lesson_id, evidence_level, unnest(CASE WHEN bare THEN [] ELSE [eid] END) AS ref FROM concepts"
_EACH_OC = "SELECT package_id, id, lesson_id, unnest(CASE WHEN line > 1 THEN [cid1, cid2] ELSE [cid1] END) AS cid FROM objectives"


def _with(sql: str) -> str:
    used = [n for n in FIXTURES if n in sql]
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURES[n]})" for n in used) + "\n" + sql


def _rule(name: str, code: str, sql: str, f: Callable) -> None:
    """sql selects package_id, entity_id and detail."""
    QUERIES[name] = lambda s, d: f(lambda n: books(s, d, n))
    ORACLES[name] = _with(f"SELECT '{code}' AS code, '{R.SEVERITY[code]}' AS severity, package_id, entity_id, detail FROM (\n{sql})")


C = F.col
_rule("v1_book_identity", "STRUCT001", "SELECT id AS package_id, id AS entity_id, unnest(list_filter([CASE WHEN answer IS NULL THEN 'answer' END, CASE WHEN oid IS NULL THEN 'oid' END], lambda x: x IS NOT NULL)) AS detail FROM questions", lambda t: R.missing_fields(t("questions").drop("package_id").withColumn("package_id", C("id")), ["answer", "oid"]))
_KINDS = {"lesson": "lessons", "section": "sections", "concept": "concepts", "objective": "objectives", "skill": "skills", "misconception": "misconceptions", "relation": "relations", "activity": "activities", "question": "questions", "evidence": "evidence"}
_ENTITIES = " UNION ALL ".join(f"SELECT package_id, id, '{kind}' AS kind, {rank} AS kind_rank FROM {name}" for rank, (kind, name) in enumerate(_KINDS.items()))
_rule(
    "v2_duplicate_ids", "STRUCT002", f"SELECT package_id, id AS entity_id, b || '>' || kind AS detail FROM (SELECT *, lag(kind) OVER (PARTITION BY package_id, id ORDER BY kind_rank) AS b FROM ({_ENTITIES})) WHERE b IS NOT NULL",
    lambda t: E.duplicate_entities(E.entity_table({kind: t(name) for kind, name in _KINDS.items()})),
)
_rule("v3_page_ranges", "STRUCT003", "SELECT package_id, id AS entity_id, CASE WHEN pdf_start < 1 THEN 'before' WHEN pdf_start > pdf_end THEN 'reversed' ELSE 'past_end' END AS detail FROM lessons WHERE pdf_start < 1 OR pdf_start > pdf_end OR pdf_end > page_count", lambda t: R.page_ranges(t("lessons")))
_rule("v4_overlapping_lessons", "STRUCT004", "SELECT package_id, id AS entity_id, '' AS detail FROM (SELECT *, lag(pdf_end) OVER (PARTITION BY package_id ORDER BY pdf_start, id) AS e FROM lessons) WHERE pdf_start <= e", lambda t: R.overlapping_lessons(t("lessons")))
_rule("v5_numbering", "STRUCT005", "SELECT package_id, id AS entity_id, '' AS detail FROM (SELECT *, lag(lesson_number) OVER (PARTITION BY package_id ORDER BY pdf_start, id) AS b FROM lessons) WHERE lesson_number <= b", lambda t: R.numbering(t("lessons")))
_rule("v6_unknown_lesson", "STRUCT006", "SELECT o.package_id, o.id AS entity_id, o.lesson_id AS detail FROM objectives o WHERE NOT EXISTS (SELECT 1 FROM lessons l WHERE l.package_id = o.package_id AND l.id = o.lesson_id)", lambda t: R.missing_references(t("objectives"), "lesson_id", t("lessons"), "STRUCT006"))
_rule("v7_missing_blocks", "STRUCT007", "SELECT o.package_id, o.id AS entity_id, o.eid AS detail FROM objectives o WHERE NOT EXISTS (SELECT 1 FROM evidence e WHERE e.package_id = o.package_id AND e.id = o.eid)", lambda t: R.missing_references(t("objectives"), "evidence_ids", t("evidence"), "STRUCT007"))
_rule("v8_missing_assets", "STRUCT008", "SELECT q.package_id, q.id AS entity_id, q.oid AS detail FROM questions q WHERE oid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM concepts e WHERE e.package_id = q.package_id AND e.id = q.oid)", lambda t: R.missing_references(t("questions"), "oid", t("concepts"), "STRUCT008"))
_rule("v9_lesson_without_text", "STRUCT009", "SELECT package_id, id AS entity_id, '' AS detail FROM lessons WHERE text_chars = 0", lambda t: R.where(t("lessons"), C("text_chars") == 0, "STRUCT009"))
_rule(
    "v10_uncovered_pages", "STRUCT010", "SELECT DISTINCT e.package_id, e.pdf_page::VARCHAR AS entity_id, '' AS detail FROM evidence e WHERE NOT EXISTS (SELECT 1 FROM lessons l WHERE l.package_id = e.package_id AND l.pdf_start = e.pdf_page)",
    lambda t: R.uncovered(t("evidence").select("package_id", "pdf_page").distinct(), t("lessons").select("package_id", C("pdf_start").alias("pdf_page")), ["package_id", "pdf_page"], "STRUCT010", "pdf_page"),
)
_rule(
    "v12_orphan_blocks", "STRUCT012", "SELECT DISTINCT package_id, block_id AS entity_id, '' AS detail FROM evidence e WHERE NOT EXISTS (SELECT 1 FROM evidence x WHERE x.package_id = e.package_id AND x.block_id = e.block_id AND x.quote_verified)",
    lambda t: R.uncovered(t("evidence").select("package_id", "block_id").distinct(), t("evidence").where("quote_verified"), ["package_id", "block_id"], "STRUCT012", "block_id"),
)
_rule(
    "v13_lesson_without_concept", "STRUCT013", "SELECT package_id, id AS entity_id, '' AS detail FROM lessons l WHERE text_chars >= 200 AND NOT EXISTS (SELECT 1 FROM concepts c WHERE c.package_id = l.package_id AND c.lesson_id = l.id AND c.evidence_level = 'explicit')",
    lambda t: R.uncovered(t("lessons").where("text_chars >= 200"), t("concepts").where("evidence_level = 'explicit'").select("package_id", C("lesson_id").alias("id")), ["package_id", "id"], "STRUCT013", "id"),
)
_rule("v14_without_evidence", "EVID001", "SELECT package_id, id AS entity_id, '' AS detail FROM concepts WHERE bare AND evidence_level <> 'human'", lambda t: R.where(t("concepts"), (F.size("evidence_ids") == 0) & (C("evidence_level") != "human"), "EVID001"))
_rule("v16_unresolved_evidence", "EVID003", f"SELECT c.package_id, c.id AS entity_id, c.ref AS detail FROM ({_EACH_C}) c WHERE NOT EXISTS (SELECT 1 FROM evidence e WHERE e.package_id = c.package_id AND e.id = c.ref)", lambda t: R.missing_references(t("concepts"), "evidence_ids", t("evidence"), "EVID003"))
_rule(
    "v17_unverified_explicit", "EVID004", "SELECT c.package_id, c.id AS entity_id, '' AS detail FROM concepts c LEFT JOIN evidence e ON e.package_id = c.package_id AND e.id = c.eid AND NOT c.bare WHERE c.evidence_level = 'explicit' GROUP BY c.package_id, c.id HAVING NOT bool_or(coalesce(e.quote_verified, false))",
    lambda t: R.unverified_explicit(t("concepts"), t("evidence")),
)
_rule(
    "v18_evidence_outside_lesson", "EVID005", f"SELECT c.package_id, c.id AS entity_id, c.ref AS detail FROM ({_EACH_C}) c JOIN evidence e ON e.package_id = c.package_id AND e.id = c.ref JOIN lessons l ON l.package_id = c.package_id AND l.id = c.lesson_id WHERE e.pdf_page NOT BETWEEN l.pdf_start AND l.pdf_end",
    lambda t: R.evidence_outside_lesson(t("concepts"), t("evidence"), t("lessons")),
)
_rule("v19_printed_page", "EVID006", "SELECT e.package_id, e.id AS entity_id, printed_page::VARCHAR AS detail FROM evidence e JOIN offsets o USING (package_id) WHERE page_offset IS NOT NULL AND pdf_page - printed_page <> page_offset", lambda t: E.printed_pages(t("evidence"), t("offsets")))
_rule("v20_mostly_inferred", "EVID007", "SELECT package_id, package_id AS entity_id, '' AS detail FROM concepts GROUP BY package_id HAVING count(*) >= 5 AND avg((evidence_level = 'inferred')::INT) > 0.4", lambda t: R.mostly_inferred(t("concepts"), 0.4))
_rule("v21_not_observable", "PEDA001", "SELECT package_id, id AS entity_id, '' AS detail FROM objectives WHERE NOT observable", lambda t: R.where(t("objectives"), ~C("observable"), "PEDA001"))
_rule("v22_unknown_concept", "PEDA002", f"SELECT o.package_id, o.id AS entity_id, o.cid AS detail FROM ({_EACH_OC}) o WHERE NOT EXISTS (SELECT 1 FROM concepts c WHERE c.package_id = o.package_id AND c.id = o.cid AND c.okey % 37 > 0)", lambda t: R.missing_references(t("objectives"), "concept_ids", t("concepts").where("okey % 37 > 0"), "PEDA002"))
_rule("v23_duplicate_concepts", "PEDA003", "SELECT package_id, id AS entity_id, '' AS detail FROM (SELECT *, row_number() OVER (PARTITION BY package_id, lesson_id, label ORDER BY id) AS n FROM concepts) WHERE n > 1", lambda t: R.repeated(t("concepts"), ["lesson_id", "label"], ["id"], "PEDA003"))
_rule(
    "v26_objective_blocks", "PEDA006",
    f"SELECT DISTINCT o.package_id, o.id AS entity_id, e.block_id AS detail FROM objectives o JOIN evidence e ON e.package_id = o.package_id AND e.id = o.eid WHERE NOT EXISTS (SELECT 1 FROM ({_EACH_OC}) n JOIN ({_EACH_C}) c ON c.package_id = n.package_id AND c.id = n.cid JOIN evidence x ON x.package_id = c.package_id AND x.id = c.ref WHERE n.package_id = o.package_id AND n.id = o.id AND x.block_id = e.block_id)",
    lambda t: R.objectives_outside_concepts(t("objectives"), t("concepts"), t("evidence")),
)
_rule("v27_objective_lesson", "PEDA007", f"SELECT o.package_id, o.id AS entity_id, o.cid AS detail FROM ({_EACH_OC}) o JOIN concepts c ON c.package_id = o.package_id AND c.id = o.cid WHERE o.lesson_id <> c.lesson_id", lambda t: R.objective_lesson(t("objectives"), t("concepts")))
_rule("v28_repeated_objectives", "PEDA008", "SELECT package_id, id AS entity_id, '' AS detail FROM (SELECT *, row_number() OVER (PARTITION BY package_id, okey, statement ORDER BY id) AS n FROM objectives) WHERE n > 1", lambda t: R.repeated(t("objectives"), ["okey", "statement"], ["id"], "PEDA008"))
_rule(
    "v31_relation_faults", "FINAL001",
    "SELECT package_id, id AS entity_id, unnest(list_filter([CASE WHEN relation_type NOT IN ('prerequisite', 'part_of') THEN 'type' END, CASE WHEN NOT EXISTS (SELECT 1 FROM relations x WHERE x.package_id = r.package_id AND x.source_id = r.target_id) THEN 'target' END, CASE WHEN source_id = target_id THEN 'self' END], lambda x: x IS NOT NULL)) AS detail FROM relations r",
    lambda t: R.relation_faults(t("relations"), t("relations").select("package_id", C("source_id").alias("id")), ["prerequisite", "part_of"]),
)
_rule("v33_concept_lesson", "FINAL003", "SELECT c.package_id, c.id AS entity_id, c.lesson_id AS detail FROM concepts c WHERE NOT EXISTS (SELECT 1 FROM lessons l WHERE l.package_id = c.package_id AND l.id = c.lesson_id)", lambda t: R.missing_references(t("concepts"), "lesson_id", t("lessons"), "FINAL003"))
_rule("v34_duplicate_edges", "FINAL004", "SELECT package_id, id AS entity_id, '' AS detail FROM (SELECT *, row_number() OVER (PARTITION BY package_id, relation_type, source_id % 20 ORDER BY id) AS n FROM relations) WHERE n > 1", lambda t: R.repeated(t("relations").withColumn("slot", C("source_id") % 20), ["relation_type", "slot"], ["id"], "FINAL004"))
_rule("v35_provenance", "PROV001", "SELECT package_id, id AS entity_id, '' AS detail FROM concepts WHERE evidence_level <> 'human' AND model_id IS NULL", lambda t: R.where(t("concepts"), (C("evidence_level") != "human") & C("model_id").isNull(), "PROV001"))
_rule("v36_review", "PROV002", "SELECT package_id, id AS entity_id, '' AS detail FROM concepts WHERE review_status IN ('accepted', 'rejected', 'needs_changes') AND reviewed_by IS NULL", lambda t: R.where(t("concepts"), C("review_status").isin("accepted", "rejected", "needs_changes") & C("reviewed_by").isNull(), "PROV002"))
_REFS = " UNION ALL ".join([
    f"SELECT package_id, id, 'objective' AS kind, 'concept_ids' AS field, cid AS target, 'concept' AS expected FROM ({_EACH_OC})", "SELECT package_id, id, 'skill', 'concept_ids', cid, 'concept' FROM skills",
    "SELECT package_id, id, 'skill', 'objective_ids', oid, 'objective' FROM skills", "SELECT package_id, id, 'skill', 'lesson_ids', lid, 'lesson' FROM skills", "SELECT package_id, id, 'activity', 'objective_ids', oid, 'objective' FROM activities",
    "SELECT package_id, id, 'activity', 'question_ids', qid, 'question' FROM activities", "SELECT package_id, id, 'question', 'objective_ids', oid, 'objective' FROM questions", "SELECT package_id, id, 'objective', 'skill_id', skill_id, 'skill' FROM objectives",
])
_rule(
    "v37_reference_kinds", "LINK001",
    f"SELECT r.package_id, r.id AS entity_id, r.kind || ':' || field || ':' || target || ':' || CASE WHEN field = 'skill_id' THEN 'not a skill' ELSE coalesce(found, 'missing') END AS detail FROM ({_REFS}) r LEFT JOIN (SELECT package_id, id AS target, arg_max(kind, kind_rank) AS found FROM ({_ENTITIES}) WHERE kind NOT IN ('relation', 'evidence') GROUP BY ALL) k USING (package_id, target) WHERE target IS NOT NULL AND found IS DISTINCT FROM expected",
    lambda t: E.reference_findings(E.reference_table(tables := {kind: t(name) for kind, name in _KINDS.items()}), E.entity_table(tables)),
)
_rule("v38_question_objective", "LINK002", "SELECT package_id, id AS entity_id, '' AS detail FROM questions WHERE oid IS NULL", lambda t: R.where(t("questions"), C("oid").isNull(), "LINK002"))
_rule(
    "v39_unbacked_prerequisites", "LINK003",
    "SELECT r.package_id, r.id AS entity_id, '' AS detail FROM relations r WHERE relation_type = 'prerequisite' AND authored_by IS NULL AND NOT EXISTS (SELECT 1 FROM evidence e WHERE e.package_id = r.package_id AND e.id = 'e' || r.source_id || '-1' AND r.source_id % 4 <> 0 AND e.quote_verified)",
    lambda t: R.unbacked_prerequisites(t("relations"), t("evidence")),
)
_rule(
    "v41_one_sided_skills", "LINK005",
    "SELECT DISTINCT package_id, 's' || okey AS entity_id, id AS detail FROM objectives WHERE skill_id IS DISTINCT FROM 's' || okey",
    lambda t: R.skills_one_sided(t("objectives").groupBy("package_id", F.concat(F.lit("s"), C("okey").cast("string")).alias("id")).agg(F.collect_set("id").alias("objective_ids")), t("objectives")),
)
_TYPES = ", ".join(f"'{t}'" for t in GRADING)
_AUTO = ", ".join(f"'{t}'" for t, mode in GRADING.items() if mode == "auto")
_ACTIVITIES = ", ".join(f"'{t}'" for t in ACTIVITY_TYPES)
_rule(
    "v44_question_type", "QUEST001", f"SELECT package_id, id AS entity_id, question_type AS detail FROM questions WHERE question_type NOT IN ({_TYPES}) UNION ALL SELECT package_id, id, activity_type FROM activities WHERE activity_type NOT IN ({_ACTIVITIES})",
    lambda t: E.types_outside(t("questions"), C("question_type"), list(GRADING)).unionByName(E.types_outside(t("activities"), C("activity_type"), ACTIVITY_TYPES)),
)
_rule(
    "v45_missing_key", "QUEST002", f"SELECT package_id, id AS entity_id, '' AS detail FROM questions WHERE coalesce(grading, CASE WHEN question_type IN ({_AUTO}) THEN 'auto' ELSE 'other' END) = 'auto' AND answer IS NULL AND (n_options = 0 OR n_correct = 0)",
    lambda t: E.unmarkable(t("questions"), grading_mode(C("question_type"), C("grading")), answer_key(C("answer"), F.lit(None).cast("array<string>"))),
)
_rule(
    "v46_option_sets", "QUEST003", "SELECT package_id, id AS entity_id, unnest(list_filter([CASE WHEN question_type = 'multiple_choice' AND n_options < 2 THEN 'few' END, CASE WHEN shared AND n_options > 1 THEN 'shared' END, CASE WHEN n_options > 0 AND n_correct >= n_options THEN 'all correct' END], lambda x: x IS NOT NULL)) AS detail FROM questions",
    lambda t: E.option_sets(t("questions")),
)


def v32_prerequisite_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    edges = part.selectExpr("concat('g', p_partkey div 50) AS package_id", "p_partkey AS source_id", "CASE WHEN p_partkey % 50 = 9 AND (p_partkey div 50) % 2 = 0 THEN p_partkey - 6 WHEN p_partkey % 50 = 49 THEN p_partkey ELSE p_partkey + 1 END AS target_id", "'prerequisite' AS relation_type")
    return R.prerequisite_cycles(edges, Scratch(spark, "cycles"))


QUERIES["v32_prerequisite_cycles"] = v32_prerequisite_cycles
ORACLES["v32_prerequisite_cycles"] = "SELECT DISTINCT 'FINAL002' AS code, 'error' AS severity, 'g' || p_partkey // 50 AS package_id, 'g' || p_partkey // 50 AS entity_id, '' AS detail FROM part WHERE p_partkey % 50 = 9 AND (p_partkey // 50) % 2 = 0"


# --- traversals, unions and summaries over the same tables


def _query(name: str, sql: str):
    def keep(f):
        QUERIES[name] = f
        ORACLES[name] = _with(sql)
        return f

    return keep


@_query("j23_concepts_for_question", f"SELECT q.package_id, q.id AS question_id, o.cid AS concept_id, c.label FROM questions q JOIN ({_EACH_OC}) o ON o.package_id = q.package_id AND o.id = q.oid JOIN concepts c ON c.package_id = o.package_id AND c.id = o.cid")
def _j23(s, d):
    """Two hops: question to objective to concept, for all questions at once."""
    o = books(s, d, "objectives").select("package_id", C("id").alias("oid"), F.explode("concept_ids").alias("concept_id"))
    c = books(s, d, "concepts").select("package_id", C("id").alias("concept_id"), "label")
    return books(s, d, "questions").join(o, ["package_id", "oid"]).join(c, ["package_id", "concept_id"]).select("package_id", C("id").alias("question_id"), "concept_id", "label")


@_query("j24_related", "SELECT package_id, id, node, other, relation_type FROM (SELECT package_id, id, source_id AS node, target_id AS other, relation_type FROM relations UNION ALL SELECT package_id, id, target_id, source_id, relation_type FROM relations WHERE relation_type <> 'prerequisite')")
def _j24(s, d):
    """One hop out; edges other than prerequisites count both ways."""
    r = books(s, d, "relations")
    out = r.select("package_id", "id", C("source_id").alias("node"), C("target_id").alias("other"), "relation_type")
    back = r.where("relation_type <> 'prerequisite'").select("package_id", "id", C("target_id").alias("node"), C("source_id").alias("other"), "relation_type")
    return out.unionByName(back)


_ALL = "SELECT package_id, id, 'lesson' AS kind FROM lessons UNION ALL SELECT package_id, id, 'concept' FROM concepts UNION ALL SELECT package_id, id, 'objective' FROM objectives UNION ALL SELECT package_id, id, 'question' FROM questions UNION ALL SELECT package_id, id, 'relation' FROM relations"


def all_entities(s, d) -> DataFrame:
    out = None
    for n in ("lessons", "concepts", "objectives", "questions", "relations"):
        one = books(s, d, n).select("package_id", "id", F.lit(n[:-1]).alias("kind"))
        out = one if out is None else out.unionByName(one)
    return out


@_query("o7_all_entities", _ALL)
def _o7(s, d):
    return all_entities(s, d)


@_query("o8_id_collisions", "SELECT eid AS id, count(DISTINCT package_id) AS packages FROM (SELECT package_id, 'k' || (okey % 1000) AS eid FROM concepts) GROUP BY ALL HAVING count(DISTINCT package_id) > 1")
def _o8(s, d):
    ids = books(s, d, "concepts").select("package_id", F.concat(F.lit("k"), (C("okey") % 1000).cast("string")).alias("id"))
    return ids.groupBy("id").agg(F.count_distinct("package_id").alias("packages")).where("packages > 1")


@_query("o6_concepts_without_objectives", "SELECT package_id, id FROM concepts c WHERE NOT EXISTS (SELECT 1 FROM objectives o WHERE o.package_id = c.package_id AND o.cid1 = c.id AND o.observable)")
def _o6(s, d):
    done = books(s, d, "objectives").where("observable").select("package_id", C("cid1").alias("id"))
    return books(s, d, "concepts").join(done, ["package_id", "id"], "left_anti").select("package_id", "id")


@_query(
    "a16_skill_from_objectives",
    """SELECT o.package_id, skill_id, round(min(c.confidence), 4) AS confidence, bool_and(c.evidence_level = 'explicit') AS explicit, bool_or(c.review_status = 'pending') AS needs_review, string_agg(DISTINCT o.eid, ',' ORDER BY o.eid) AS evidence
FROM objectives o JOIN concepts c ON c.package_id = o.package_id AND c.id = o.cid1 WHERE skill_id IS NOT NULL GROUP BY ALL""",
)
def _a16(s, d):
    """Evidence together, the least confidence; explicit only if all are, review if any needs it."""
    c = books(s, d, "concepts").select("package_id", C("id").alias("cid1"), "confidence", "evidence_level", "review_status")
    j = books(s, d, "objectives").where("skill_id is not null").join(c, ["package_id", "cid1"])
    return j.groupBy("package_id", "skill_id").agg(
        F.round(F.min(C("confidence").cast("double")), 4).alias("confidence"), F.bool_and(C("evidence_level") == "explicit").alias("explicit"), F.bool_or(C("review_status") == "pending").alias("needs_review"),
        F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_list("evidence_ids")))), ",").alias("evidence"),
    )


@_query(
    "j20_admit_proposals",
    """SELECT package_id, id, CASE WHEN max(length(label)) = 0 THEN 'empty_label' WHEN count(DISTINCT ref) = 0 THEN 'no_citation' WHEN count(DISTINCT own) = 0 THEN 'all_foreign' ELSE 'accepted' END AS outcome,
CAST(count(DISTINCT ref) - count(DISTINCT own) AS INT) AS dropped
FROM (SELECT c.package_id, c.id, c.label, CASE WHEN bare THEN NULL ELSE c.eid END AS ref, CASE WHEN bare THEN NULL ELSE e.id END AS own FROM concepts c LEFT JOIN evidence e ON e.package_id = c.package_id AND e.id = c.eid) GROUP BY ALL""",
)
def _j20(s, d):
    """Claims without a citation, or with none inside their unit, are refused; foreign citations are dropped."""
    claims = books(s, d, "concepts")
    cited = claims.select("package_id", "id", F.explode("evidence_ids").alias("ref")).distinct()
    own = books(s, d, "evidence").select("package_id", C("id").alias("ref"), F.lit(1).alias("own")).distinct()
    counts = cited.join(own, ["package_id", "ref"], "left").groupBy("package_id", "id").agg(F.count("*").alias("cited"), F.count("own").alias("kept"))
    g = claims.groupBy("package_id", "id").agg(F.max(F.length("label")).alias("n")).join(counts, ["package_id", "id"], "left").na.fill(0)
    outcome = F.when(C("n") == 0, "empty_label").when(C("cited") == 0, "no_citation").when(C("kept") == 0, "all_foreign").otherwise("accepted")
    return g.select("package_id", "id", outcome.alias("outcome"), (C("cited") - C("kept")).cast("int").alias("dropped"))


@_query("w20_lesson_bounds", "SELECT package_id, id, pdf_start AS first_page, greatest(pdf_start, coalesce(lead(pdf_start) OVER (PARTITION BY package_id ORDER BY pdf_start, id) - 1, page_count)) AS last_page FROM lessons")
def _w20(s, d):
    """Each lesson runs to the page before the next one's."""
    w = W.partitionBy("package_id").orderBy("pdf_start", "id")
    return books(s, d, "lessons").select("package_id", "id", C("pdf_start").alias("first_page"), F.greatest("pdf_start", F.coalesce(F.lead("pdf_start").over(w) - 1, C("page_count"))).alias("last_page"))


@_query("w22_concepts_per_lesson", "SELECT package_id, id, count(*) OVER (PARTITION BY package_id, okey) > 3 AS crowded FROM objectives")
def _w22(s, d):
    w = W.partitionBy("package_id", "okey")
    return books(s, d, "objectives").select("package_id", "id", (F.count("*").over(w) > 3).alias("crowded"))
