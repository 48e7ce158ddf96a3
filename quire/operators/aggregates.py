"""Aggregations over blocks, pages, tables and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions.text import digits_to_int
from quire.operators.blocks import PAGE


def page_stats(blocks: DataFrame) -> DataFrame:
    """Block types of a page by frequency, then by first place: ``Type=n`` joined by commas, and their number."""
    kinds = blocks.where("not removed").groupBy(*PAGE, "block_type").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    each = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "first", "block_type", "n")))
    return kinds.groupBy(*PAGE).agg(F.array_join(F.transform(each, lambda s: F.concat_ws("=", s["block_type"], s["n"].cast("string"))), ",").alias("block_counts"), F.sum("n").alias("n_blocks"))


def raw_text(lines: DataFrame) -> DataFrame:
    """Text of each page, a newline after each line."""
    each = F.sort_array(F.collect_list(F.struct("line_idx", "text")))
    return lines.groupBy(*PAGE).agg(F.array_join(F.transform(each, lambda s: F.concat(s["text"], F.lit("\n"))), "").alias("text"))


def ratio_of_sums(df: DataFrame, keys: list[str], part: Column, whole: Column, name: str) -> DataFrame:
    """Sum of parts over sum of wholes; 0 without any."""
    return df.groupBy(*keys).agg(F.sum(part).alias("p"), F.sum(whole).alias("w")).select(*keys, F.when(F.col("w") > 0, F.col("p") / F.col("w")).otherwise(0.0).alias(name))


def printed_folios(blocks: DataFrame, pages: DataFrame, band: float = 0.85) -> DataFrame:
    """(doc_id, page_id, folio): the first block of a page that can be its printed number.

    A number of any digits from 1 to 500, of at most four characters, in a page footer or a block that starts in the page's
    bottom 15 %. ``pages``: doc_id, page_id, top, bottom.
    """
    text = F.btrim("text")
    value = digits_to_int(text)
    low = F.col("y0") >= F.col("top") + band * (F.col("bottom") - F.col("top"))
    found = blocks.join(pages.select(*PAGE, "top", "bottom"), PAGE).where(F.char_length(text).between(1, 4) & ((F.col("block_type") == "PageFooter") | low) & value.between(1, 500))
    return found.groupBy(*PAGE).agg(F.min_by(value, "pos").alias("folio"))


def page_offset(folios: DataFrame) -> DataFrame:
    """(doc_id, page_offset, samples, agreement): the most frequent difference of page number (from 1) and folio; of several the one seen first."""
    votes = folios.select("doc_id", "page_id", (F.col("page_id") + 1 - F.col("folio")).alias("shift"))
    n = votes.groupBy("doc_id", "shift").agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
    best = n.withColumns({"rank": F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("n"), "first")), "samples": F.sum("n").over(W.partitionBy("doc_id"))}).where("rank = 1")
    return best.select("doc_id", F.col("shift").alias("page_offset"), "samples", F.bround(F.col("n") / F.col("samples"), 4).alias("agreement"))


def page_map(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Every page with its printed number and where that is from (``page_footer`` or ``inferred_from_offset``), and the document's
    offset with its evidence; no number at all in a document without a folio."""
    folios = printed_folios(blocks, pages)
    out = pages.select(*PAGE).join(folios, PAGE, "left").join(page_offset(folios), "doc_id", "left")
    inferred = F.col("page_id") + 1 - F.col("page_offset")
    source = F.when(F.col("folio").isNotNull(), "page_footer").when(F.col("page_offset").isNotNull(), "inferred_from_offset")
    return out.select(*PAGE, F.coalesce("folio", inferred).alias("printed_page"), source.alias("printed_source"), "page_offset", F.coalesce("samples", F.lit(0)).alias("samples"), "agreement")


def profile_columns() -> list[Column]:
    """Aggregates of blocks: images, text and headings."""
    text = ~F.col("block_type").isin("Picture", "PageHeader", "PageFooter")
    return [
        F.count_if(F.col("block_type") == "Picture").alias("images"), F.sum(F.when(text, F.length("text")).otherwise(0)).alias("text_chars"), F.count_if(text).alias("text_blocks"),
        F.count_if(F.col("block_type") == "SectionHeader").alias("headings"),
    ]


def density(chars: Column, low: int = 1000, high: int = 2500) -> Column:
    return F.when(chars <= low, "low").when(chars >= high, "high").otherwise("medium")


def material_profile(blocks: DataFrame, keys: list[str], low: int = 1000, high: int = 2500) -> DataFrame:
    """Images, text, headings of each lesson and its density."""
    return blocks.groupBy(*keys).agg(F.count_distinct("page_id").alias("pages"), *profile_columns()).withColumn("density", density(F.col("text_chars"), low, high))


def table_shape(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows: the most row spans in a column; columns: the most column spans in a row."""
    down = cells.groupBy(*keys, "col_id").agg(F.sum("rowspan").alias("r")).groupBy(*keys).agg(F.max("r").alias("n_rows"))
    across = cells.groupBy(*keys, "row_id").agg(F.sum("colspan").alias("c")).groupBy(*keys).agg(F.max("c").alias("n_cols"))
    return down.join(across, keys)


def top_by_count(df: DataFrame, keys: list[str], value: str, order: str, k: int = 1) -> DataFrame:
    """The most common values per key; ties by first place."""
    n = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))
    return n.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("n"), "first_seen", value))).where(F.col("rank") <= k)


def bench_summary(results: DataFrame, scanned: list[str]) -> DataFrame:
    """Pass rate of each category, and the means over categories: all, and without the scanned ones."""
    per = results.groupBy("category").agg(F.avg(F.col("passed").cast("double")).alias("score"), F.count("*").alias("tests"))
    whole = per.agg(F.avg("score").alias("score"), F.sum("tests").alias("tests")).select(F.lit("overall").alias("category"), "score", "tests")
    digital = per.where(~F.col("category").isin(scanned)).agg(F.avg("score").alias("score"), F.sum("tests").alias("tests")).select(F.lit("digital").alias("category"), "score", "tests")
    return per.unionByName(whole).unionByName(digital)


def throughput(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Pages a second, milliseconds a page, errors."""
    return runs.groupBy(*keys).agg(F.count("*").alias("pages"), F.sum("latency_ms").alias("ms"), F.count("error").alias("errors")).select(
        *keys, "pages", "errors", F.round(F.col("pages") * 1000 / F.col("ms"), 6).alias("pages_per_s"), F.round(F.col("ms") / F.col("pages"), 6).alias("ms_per_page")
    )


def findings_report(findings: DataFrame) -> DataFrame:
    """Counts by severity and code, with subtotals (null code) and the total (both null)."""
    return findings.rollup("severity", "code").agg(F.count("*").alias("n"))
