"""All entities of packages in one table, and all their references in another: what is named twice, and what points at nothing or at the wrong kind.

Both tables are long (a row an id, a row a reference) and meet in equi-joins on (package, id), once for all rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.operators.rules import findings

#: Kinds of entities in their fixed order; a reference may point at all but the last two.
KINDS = ["lesson", "section", "concept", "objective", "skill", "misconception", "relation", "activity", "question", "evidence"]
NO_TARGET = ["relation", "evidence"]
#: Fixed reference fields: owner's kind, its id list, kind of what it names.
REFERENCES = [
    ("objective", "concept_ids", "concept"), ("skill", "concept_ids", "concept"), ("skill", "objective_ids", "objective"), ("skill", "lesson_ids", "lesson"),
    ("activity", "objective_ids", "objective"), ("activity", "question_ids", "question"), ("question", "objective_ids", "objective"), ("objective", "skill_id", "skill"),
]


def entity_table(tables: dict[str, DataFrame]) -> DataFrame:
    """(package_id, id, kind, rank of the kind) of every entity; ``tables`` by kind, each with package_id and id."""
    parts = [tables[k].select("package_id", "id", F.lit(k).alias("kind"), F.lit(n).alias("kind_rank")) for n, k in enumerate(KINDS) if k in tables]
    return reduce(DataFrame.unionByName, parts)


def reference_table(tables: dict[str, DataFrame], fields: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(package_id, id, kind, field, target, expected): a row for each id that an entity names; lists and single ids alike. Null and empty ones name nothing."""
    parts = []
    for kind, field, expected in fields or REFERENCES:
        if kind in tables and field in tables[kind].columns:
            many = dict(tables[kind].dtypes)[field].startswith("array")
            target = F.explode(field) if many else F.col(field)
            parts.append(tables[kind].select("package_id", "id", F.lit(kind).alias("kind"), F.lit(field).alias("field"), target.alias("target"), F.lit(expected).alias("expected")))
    return reduce(DataFrame.unionByName, parts).where("target is not null and target <> ''")


def duplicate_entities(entities: DataFrame) -> DataFrame:
    """STRUCT002: each claim of an id after the first, with the kinds of the claim before and of this one."""
    w = W.partitionBy("package_id", "id").orderBy("kind_rank")
    later = entities.withColumn("before", F.lag("kind").over(w)).where("before is not null")
    return findings(later, "STRUCT002", "id", F.concat_ws(">", "before", "kind"))


def _resolved(references: DataFrame, entities: DataFrame) -> DataFrame:
    """References with ``found``, the kind of what they name (of several the last in the order of kinds), or null."""
    kinds = entities.where(~F.col("kind").isin(NO_TARGET)).groupBy("package_id", F.col("id").alias("target")).agg(F.max_by("kind", "kind_rank").alias("found"))
    return references.join(kinds, ["package_id", "target"], "left")


def reference_findings(references: DataFrame, entities: DataFrame) -> DataFrame:
    """LINK001: references to nothing, and to another kind than their field asks for; a skill is only ever *not a skill*."""
    wrong = (
        F.when((F.col("field") == "skill_id") & (F.coalesce("found", F.lit("")) != "skill"), "not a skill")
        .when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("expected"), F.col("found"))
    )
    told = _resolved(references, entities).withColumn("wrong", wrong).where("wrong is not null")
    return findings(told, "LINK001", "id", F.concat_ws(":", "kind", "field", "target", "wrong"))


def missing_evidence(references: DataFrame, evidence: DataFrame) -> DataFrame:
    """EVID003: evidence ids that the package doesn't have. ``references`` of evidence fields."""
    gone = references.join(evidence.select("package_id", F.col("id").alias("target")), ["package_id", "target"], "left_anti")
    return findings(gone, "EVID003", "id", F.concat_ws(":", "kind", "target"))


def types_outside(df: DataFrame, kind: Column, known: list[str]) -> DataFrame:
    """QUEST001: a question's or activity's type outside its closed list."""
    return findings(df.where(~kind.isin(known)), "QUEST001", "id", kind)


def unmarkable(questions: DataFrame, mode: Column, key: Column) -> DataFrame:
    """QUEST002: marked automatically, with neither a correct option (``options``: option_id, is_correct) nor a key."""
    right = F.exists(F.coalesce("options", F.array().cast(questions.schema["options"].dataType)), lambda o: F.coalesce(o["is_correct"], F.lit(False)))
    return findings(questions.where((mode == "auto") & ~right & (F.size(key) == 0)), "QUEST002")


def option_sets(questions: DataFrame) -> DataFrame:
    """QUEST003, a finding each: a multiple choice of fewer than two options, options that share an id, and options that are all correct."""
    options = F.coalesce("options", F.array().cast(questions.schema["options"].dataType))
    ids = F.transform(options, lambda o: o["option_id"])
    faults = F.array_compact(
        F.array(
            F.when((F.col("question_type") == "multiple_choice") & (F.size(options) < 2), "few"),
            F.when(F.size(F.array_distinct(ids)) < F.size(ids), "shared"),
            F.when((F.size(options) > 0) & F.forall(options, lambda o: F.coalesce(o["is_correct"], F.lit(False))), "all correct"),
        )
    )
    return findings(questions.withColumn("fault", F.explode(faults)), "QUEST003", "id", F.col("fault"))


def printed_pages(evidence: DataFrame, offsets: DataFrame) -> DataFrame:
    """EVID006: evidence whose page and printed page differ by another number than the book's offset (``offsets``: package_id, page_offset)."""
    known = evidence.join(offsets.where("page_offset is not null"), "package_id").where("printed_page is not null")
    return findings(known.where(F.col("pdf_page") - F.col("printed_page") != F.col("page_offset")), "EVID006", "id", F.col("printed_page"))
