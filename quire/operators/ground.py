"""Grounding of proposed concepts and objectives: admission, verification, scores, reasons, wording, ids and duplicates in one chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions.text import make_id
from quire.operators.claims import check_wording, claim_confidence, claim_levels, first_twin, review_reasons, weigh_citations


def admit_concepts(proposals: DataFrame, citations: DataFrame, unit_blocks: DataFrame) -> DataFrame:
    """``outcome`` of each proposal: empty_label, no_citation, all_foreign or accepted, and how many foreign citations are dropped.

    ``proposals``: package_id, id, label; ``citations``: package_id, id, block_id; ``unit_blocks``: package_id, block_id.
    """
    own = unit_blocks.select("package_id", "block_id", F.lit(1).alias("own")).distinct()
    cited = citations.select("package_id", "id", "block_id").distinct().join(own, ["package_id", "block_id"], "left")
    counts = cited.groupBy("package_id", "id").agg(F.count("*").alias("cited"), F.count("own").alias("kept"))
    g = proposals.groupBy("package_id", "id").agg(F.max(F.length(F.btrim("label"))).alias("n")).join(counts, ["package_id", "id"], "left").na.fill(0)
    outcome = F.when(F.col("n") == 0, "empty_label").when(F.col("cited") == 0, "no_citation").when(F.col("kept") == 0, "all_foreign").otherwise("accepted")
    return g.select("package_id", "id", outcome.alias("outcome"), (F.col("cited") - F.col("kept")).cast("int").alias("dropped"))


def _grounded(claims: DataFrame, words: DataFrame | None, lesson_words: DataFrame | None, kind: str, label: Column) -> DataFrame:
    """Claims and their evidence with level, confidence, reasons, foreign words and the id made from their label."""
    scored = review_reasons(claim_confidence(claim_levels(claims)))
    if words is not None and lesson_words is not None:
        foreign = check_wording(words, lesson_words).groupBy("lesson_id", F.col("claim_id").alias("id")).agg(F.sort_array(F.collect_set("word")).alias("foreign_words"))
        scored = scored.join(foreign, ["lesson_id", "id"], "left")
        scored = scored.withColumn("needs_review", F.col("needs_review") | F.col("foreign_words").isNotNull())
    return scored.withColumn("new_id", make_id(F.col("package_id"), kind, label))


def ground_concepts(proposals: DataFrame, citations: DataFrame, unit_blocks: DataFrame, words: DataFrame | None = None, lesson_words: DataFrame | None = None) -> DataFrame:
    """Admitted concepts with level, confidence, reasons, foreign words, a new id, and ``duplicate_of``: the first of the lesson's earlier concepts with the same words.

    ``proposals``: package_id, lesson_id, id, label, claimed_level, model_confidence, density, a row each; ``citations``: package_id, id, block_id, matched,
    method, asset_id; ``words`` and ``lesson_words`` as in ``check_wording``.
    """
    own = unit_blocks.select("package_id", "block_id", F.lit(True).alias("own")).distinct()
    weighed = weigh_citations(citations.join(own, ["package_id", "block_id"], "left")).where("kept > 0").withColumn("dropped", (F.col("cited") - F.col("kept")).cast("int"))
    admitted = proposals.where(F.length(F.btrim("label")) > 0).join(weighed, ["package_id", "id"])  # what admit_concepts accepts
    return first_twin(_grounded(admitted, words, lesson_words, "concept", F.col("label"))).drop("cited", "kept")


def ground_objectives(proposals: DataFrame, concepts: DataFrame, citations: DataFrame, words: DataFrame | None = None, lesson_words: DataFrame | None = None, most: int = 3) -> DataFrame:
    """The same for objectives: allowed blocks are those their concept cites; ``crowded`` where a concept has over ``most`` of them.

    ``proposals`` as above with concept_id and statement; ``concepts``: package_id, concept_id, block_id.
    """
    allowed = concepts.select("package_id", "concept_id", "block_id", F.lit(True).alias("own")).distinct()
    cited = citations.join(proposals.select("package_id", "id", "concept_id"), ["package_id", "id"])
    weighed = weigh_citations(cited.join(allowed, ["package_id", "concept_id", "block_id"]), "concept_id").drop("cited", "kept")
    admitted = proposals.where(F.length(F.btrim("statement")) > 0).join(weighed, ["package_id", "id"])  # what admit_objectives accepts
    out = _grounded(admitted, words, lesson_words, "objective", F.col("statement"))
    return out.withColumn("crowded", F.count("*").over(W.partitionBy("package_id", "concept_id")) > most)
