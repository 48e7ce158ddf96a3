"""Evidence units, prompts, objective wording, authored rows, and the acceptance of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.blocks import CITABLE


def evidence_units(sections: DataFrame, blocks: DataFrame) -> DataFrame:
    """One packet per document: its sections in order, each with its citable blocks in order.

    ``sections``: doc_id, section, pos of every block; needs_images if the text is thin and there are pictures.
    """
    b = sections.join(blocks.select("doc_id", "pos", "block_id", "block_type", "text"), ["doc_id", "pos"])
    citable = F.col("block_type").isin(CITABLE) & (F.length(F.btrim("text")) > 0)
    per = b.groupBy("doc_id", "section").agg(
        F.min("pos").alias("first"), F.sort_array(F.collect_list(F.when(citable, F.struct("pos", "block_id", "text")))).alias("blocks"),
        F.sum(F.when(citable, F.length("text")).otherwise(0)).alias("chars"), F.count_if(F.col("block_type") == "Picture").alias("images"),
    )
    unit = per.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("first", "section", "blocks"))).alias("sections"), F.sum("chars").alias("chars"), F.sum("images").alias("images"))
    return unit.withColumn("needs_images", (F.col("chars") <= 1000) & (F.col("images") > 0))


def render_prompts(units: DataFrame, template: str) -> DataFrame:
    """``prompt``: the template with the unit's evidence; ``version``: first 8 hex digits of the template's hash."""
    line = lambda b: F.concat(F.lit("["), b["block_id"], F.lit("] "), b["text"])
    part = lambda s: F.concat(F.lit("# "), s["section"], F.lit("\n"), F.array_join(F.transform(s["blocks"], line), "\n"))
    evidence = F.array_join(F.transform("sections", part), "\n")
    note = F.when(F.col("needs_images"), "Look at the images.").otherwise("")
    return units.select(
        "doc_id", F.replace(F.replace(F.lit(template), F.lit("{evidence}"), evidence), F.lit("{note}"), note).alias("prompt"), F.substring(F.sha2(F.lit(template), 256), 1, 8).alias("version")
    )


def author_rows(rows: DataFrame) -> DataFrame:
    """``refused``: the first reason against a row made by a person, or null; ``id_list`` comes without repeats.

    ``rows``: author, kind, source_id, target_id, id_list, n_options, n_correct.
    """
    reason = (
        F.when(F.length(F.btrim(F.coalesce("author", F.lit("")))) == 0, "no_author").when((F.col("kind") == "relation") & (F.col("source_id") == F.col("target_id")), "self_edge")
        .when((F.col("kind") == "skill") & (F.size("id_list") == 0), "no_objective").when((F.col("kind") == "question") & (F.col("n_options") < 2), "few_options")
        .when((F.col("kind") == "question") & (F.col("n_correct") < 1), "no_correct_option")
    )
    return rows.withColumns({"refused": reason, "id_list": F.array_distinct("id_list")})


def accept_tables(tables: DataFrame, mode: str = "balanced") -> DataFrame:
    """``source``: text for tables whose score reaches the mode's threshold, else queued for a reader."""
    least = {"balanced": 0.75, "fast": 0.5}[mode]
    return tables.withColumn("source", F.when(F.col("score") >= least, "text").otherwise("reader"))


def table_stats(accepted: DataFrame, keys: list[str]) -> DataFrame:
    return accepted.groupBy(*keys).agg(F.count("*").alias("tables"), F.count_if(F.col("source") == "text").alias("from_text"), F.count_if(F.col("source") == "reader").alias("from_reader"))
