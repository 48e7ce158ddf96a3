"""User-made pipelines over block tables, and keyed results of external readers."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.blocks import PAGE

Step = Callable[..., DataFrame]


def pipeline(df: DataFrame, steps: list[Step | tuple[Step, dict[str, Any]]]) -> DataFrame:
    """Apply steps in order; a step is a function of a DataFrame, alone or with its own configuration."""
    for step in steps:
        function, options = step if isinstance(step, tuple) else (step, {})
        df = df.transform(function, **options)
    return df


def replace_steps(steps: list[Step], replacements: dict[str, Step | None]) -> list[Step]:
    """Steps with those of a name replaced, or left out for None."""
    out = []
    for step in steps:
        new = replacements.get(step.__name__, step)
        out += [] if new is None else [new]
    return out


def apply_ocr_results(blocks: DataFrame, results: DataFrame) -> DataFrame:
    """Full-page results: pages with at least one good result lose their blocks for them.

    ``results``: doc_id, page_id, seq, block_type (null: unknown), text, failed. Unknown and failed rows are dropped.
    """
    good = results.where(~F.col("failed") & F.col("block_type").isNotNull())
    kept = blocks.join(good.select(*PAGE).distinct(), PAGE, "left_anti").select(*PAGE, "pos", "block_type", "text", F.lit("layout").alias("source"))
    return kept.unionByName(good.select(*PAGE, F.col("seq").alias("pos"), "block_type", "text", F.lit("reader").alias("source")))


def admit_objectives(proposals: DataFrame, concepts: DataFrame, citations: DataFrame) -> DataFrame:
    """``outcome``: the first reason against an objective, in order, or accepted.

    Allowed blocks are those its concept cites. ``proposals``: package_id, id, concept_id, statement;
    ``concepts``: package_id, concept_id, block_id; ``citations``: package_id, id, block_id.
    """
    allowed = concepts.select("package_id", "concept_id", "block_id").distinct()
    known = allowed.select("package_id", "concept_id").distinct().withColumn("known", F.lit(True))
    cited = citations.select("package_id", "id", "block_id").distinct().join(proposals.select("package_id", "id", "concept_id").distinct(), ["package_id", "id"])
    counts = cited.join(allowed.withColumn("ok", F.lit(1)), ["package_id", "concept_id", "block_id"], "left").groupBy("package_id", "id").agg(F.count("*").alias("cited"), F.count("ok").alias("inside"))
    j = proposals.join(known, ["package_id", "concept_id"], "left").join(counts, ["package_id", "id"], "left")
    reason = (
        F.when(F.length(F.btrim(F.coalesce("statement", F.lit("")))) == 0, "empty_statement").when(F.col("concept_id").isNull(), "no_concept").when(F.col("known").isNull(), "unknown_concept")
        .when(F.coalesce("cited", F.lit(0)) == 0, "no_citation").when(F.col("inside") == 0, "all_foreign").otherwise("accepted")
    )
    return j.select("package_id", "id", reason.alias("outcome"))
