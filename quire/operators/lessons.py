"""Lessons of books from their contents lists, and packages that carry a book's content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions.text import ordinal_id
from quire.operators.aggregates import density, profile_columns
from quire.operators.blocks import PAGE
from quire.operators.books import lesson_pages, opening_title
from quire.operators.grouped import lesson_numbers
from quire.session import Scratch


def lesson_bounds(toc: DataFrame, pages: DataFrame) -> DataFrame:
    """Contents rows with ``first_page`` and ``last_page``: a lesson runs to the page before the next one's, the last to the end of the book."""
    count = pages.groupBy("doc_id").agg(F.max("page_id").alias("page_count"))
    order = W.partitionBy("doc_id").orderBy("printed_page", "seq")
    rows = toc.where("printed_page is not null").join(count, "doc_id")
    last = F.coalesce(F.lead("printed_page").over(order) - 1, F.col("page_count"))
    return rows.select("*", F.col("printed_page").alias("first_page"), F.greatest("printed_page", last).alias("last_page"))


def lesson_title(toc_title: Column, approximate: Column, opening: Column, printed: Column, verbatim: bool) -> Column:
    """Struct of title, source and approximate: the contents list if it is ordinary text, else the opening page, else the contents, else a number."""
    make = lambda t, source, a: F.struct(t.alias("title"), F.lit(source).alias("source"), a.alias("approximate"))
    has_toc, no = F.coalesce(F.length(toc_title), F.lit(0)) > 0, F.lit(False)
    number = F.when(printed.isNotNull(), F.concat(F.lit("درس "), printed.cast("string"))).otherwise("بدون عنوان")
    out = F.when(opening.isNotNull(), make(opening, "opening", has_toc & approximate & (F.lower(opening) != F.lower(toc_title)))).when(has_toc, make(toc_title, "toc", approximate)).otherwise(make(number, "fallback", ~no))
    return F.when(has_toc, make(toc_title, "toc", approximate)).otherwise(out) if verbatim else out


def page_content(blocks: DataFrame, short: int) -> DataFrame:
    """A row a page: its blocks in order (``listed``), the ``profile`` of its material, and its ``opening``."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("pos", "block_id"))), lambda x: x["block_id"])
    return blocks.groupBy(*PAGE).agg(listed.alias("listed"), F.struct(*profile_columns()).alias("profile"), opening_title(short).alias("opening"))


def segment_lessons(toc: DataFrame, blocks: DataFrame, verbatim: bool = False, short: int = 80) -> DataFrame:
    """Lessons of each book: id, number, title and where it comes from, pages, blocks in order, and the profile of their material.

    ``toc``: doc_id, seq, printed_page, printed (the number the book prints, or null), title, approximate. A lesson without a page is left out.
    """
    kept = Scratch(blocks.sparkSession, "lessons").keep(page_content(blocks, short), "pages")  # blocks are read once, lessons are made of whole pages
    pages = kept.select("doc_id", "page_id")
    bounds = lesson_bounds(toc, pages).withColumn("key", F.col("seq").cast("string"))
    held = lesson_pages(bounds.select("doc_id", F.col("key").alias("id"), "first_page", "last_page"), kept.withColumnRenamed("page_id", "page_key"), ["listed", "profile"])
    held = held.withColumnsRenamed({"lesson_id": "key", "page_key": "page_id"})
    sums = [F.sum(f"profile.{c}").alias(c) for c in ("images", "text_chars", "text_blocks", "headings")]
    listed = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("page_id", "listed"))), lambda x: x["listed"]))
    span = held.groupBy("doc_id", "key").agg(F.min("page_id").alias("pdf_start"), F.max("page_id").alias("pdf_end"), listed.alias("block_ids"), F.count_distinct("page_id").alias("pages"), *sums)
    span = span.withColumn("density", density(F.col("text_chars")))
    opening = kept.select("doc_id", F.col("page_id").alias("pdf_start"), "opening")
    j = bounds.join(span, ["doc_id", "key"]).join(opening, ["doc_id", "pdf_start"], "left")
    numbers = lesson_numbers(j.select(F.col("doc_id").alias("package_id"), F.col("key").alias("id"), "first_page", "printed")).select(F.col("package_id").alias("doc_id"), F.col("id").alias("key"), "number")
    j = j.join(numbers, ["doc_id", "key"])
    j = j.withColumn("t", lesson_title(F.col("title"), F.coalesce("approximate", F.lit(False)), F.col("opening"), F.col("printed"), verbatim))
    lesson_id = ordinal_id(F.col("doc_id").cast("string"), "lesson", F.col("number"))
    return j.select("doc_id", lesson_id.alias("id"), "number", "t.title", F.col("t.source").alias("title_source"), "t.approximate", "first_page", "last_page", "pdf_start", "pdf_end", "block_ids", "pages", "images", "text_chars", "text_blocks", "headings", "density")


def section_text(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Characters of each section over readable blocks, and its first and last page. ``placed``: blocks with their section's keys."""
    readable = ~F.col("block_type").isin("Picture", "PageHeader", "PageFooter")
    return placed.groupBy(*keys).agg(
        F.sum(F.when(readable, F.length("text")).otherwise(0)).alias("text_chars"), F.min("page_id").alias("first_page"), F.max("page_id").alias("last_page"), F.count("*").alias("n_blocks")
    )


def build_packages(books: DataFrame, entities: dict[str, DataFrame], findings: DataFrame, prompts: DataFrame | None = None) -> DataFrame:
    """One row a book: package_id, grade, subject, version of prompts by stage, an array of structs of each kind of entity in order of
    id, and ``stats``, their numbers. Books without an identity, or with findings of severity error, are refused.

    ``books``: package_id, grade, subject, title; ``entities``: kind to a table with package_id and id; ``prompts``: package_id, stage, version.
    A book's entities are gathered in one row, as books are bounded; nothing else is.
    """
    refused = findings.where("severity = 'error'").select("package_id").distinct()
    whole = books.where("grade is not null and length(subject) > 0 and length(title) > 0").join(refused, "package_id", "left_anti")
    out = whole.select("package_id", "grade", "subject", "title")
    for kind, table in entities.items():
        rest = [c for c in table.columns if c not in ("package_id", "id")]
        mine = table.groupBy("package_id").agg(F.sort_array(F.collect_list(F.struct("id", *rest))).alias(kind))
        out = out.join(mine, "package_id", "left")
    if prompts is not None:
        versions = prompts.groupBy("package_id").agg(F.map_from_entries(F.sort_array(F.collect_set(F.struct("stage", "version")))).alias("prompts"))
        out = out.join(versions, "package_id", "left")
    size = lambda k: F.coalesce(F.when(F.col(k).isNotNull(), F.size(k)), F.lit(0)).alias(k)
    name = F.concat_ws(":", F.concat(F.lit("grade-"), F.col("grade").cast("string")), "subject", "package_id")
    return out.select(name.alias("name"), *out.columns, F.struct(*[size(k) for k in entities]).alias("stats"))
