"""Lessons, sections and tables of whole books: interval and as-of joins, contents columns, table rendering."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions.markup import grid_of, html_to_markdown
from quire.functions.text import digits_to_int
from quire.operators.aggregates import table_shape
from quire.operators.blocks import PAGE


def lesson_pages(lessons: DataFrame, pages: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Pages of each lesson, with the pages' columns ``more``: an interval join inside the book. ``lessons``: doc_id, id, first_page, last_page."""
    j = lessons.alias("l").join(pages.alias("p"), (F.col("l.doc_id") == F.col("p.doc_id")) & F.col("p.page_key").between(F.col("l.first_page"), F.col("l.last_page")))
    return j.select("l.doc_id", F.col("l.id").alias("lesson_id"), "p.page_key", *[f"p.{c}" for c in more])


def blocks_to_sections(blocks: DataFrame, starts: DataFrame) -> DataFrame:
    """As-of join on (page, height): each block takes the last section that starts at or before it.

    ``starts``: doc_id, page_id, y0, section. One sort by document of both tables together.
    """
    marks = starts.select("doc_id", "page_id", "y0", F.lit(0).alias("kind"), F.lit(-1).alias("pos"), "section")
    rows = blocks.select("doc_id", "page_id", "y0", F.lit(1).alias("kind"), "pos", F.lit(None).cast("string").alias("section"))
    w = W.partitionBy("doc_id").orderBy("page_id", "y0", "kind", "pos").rowsBetween(W.unboundedPreceding, 0)
    return marks.unionByName(rows).withColumn("in_section", F.last("section", ignorenulls=True).over(w)).where("kind = 1").select("doc_id", "pos", F.coalesce("in_section", F.lit("front")).alias("section"))


#: Fixed kinds of blocks whose text a section counts.
READABLE = ["Text", "RecoveredText", "SectionHeader", "Caption", "ListGroup", "ListItem"]


def sections(lessons: DataFrame, blocks: DataFrame, pages: DataFrame, fallback: str = "page") -> DataFrame:
    """Sections of each lesson: doc_id, lesson_id, order (from 1), title, boundary_method, source_block, first_page, last_page, n_blocks, text_chars, block_ids in order.

    A section runs from a heading that isn't blank to the next one (``section_header``); a block as high as a heading is in the
    section that starts there. What stands before a lesson's first heading is a section of the lesson's own name
    (``page_fallback``). A lesson without headings is one section a page (``page_fallback``), or one in all (``whole_lesson``) if
    ``fallback`` is ``lesson``. ``lessons``: doc_id, id, title, first_page, last_page; ``pages``: doc_id, page_id, blank ones included.
    """
    if fallback not in ("page", "lesson"):
        raise ValueError("a lesson without headings falls back to page or lesson")
    keys = ["doc_id", "lesson_id"]
    inside = lesson_pages(lessons, pages.select("doc_id", F.col("page_id").alias("page_key")).distinct()).withColumnRenamed("page_key", "page_id")
    rows = inside.join(blocks.select(*PAGE, "y0", "x1", "pos", "block_id", "block_type", F.coalesce("text", F.lit("")).alias("text")), PAGE, "left")
    lesson = W.partitionBy(*keys)
    head = (F.col("block_type") == "SectionHeader") & (F.btrim("text") != "")
    rows = rows.withColumn("head", F.coalesce(head, F.lit(False)).cast("int")).withColumn("headed", F.max("head").over(lesson) == 1)
    by_page = F.dense_rank().over(lesson.orderBy("page_id")) if fallback == "page" else F.lit(1)
    # the sum takes in all blocks that are as high
    rows = rows.withColumn("part", F.when(F.col("headed"), F.sum("head").over(lesson.orderBy("page_id", "y0"))).otherwise(by_page).cast("long"))
    chars = F.when(F.col("block_type").isin(READABLE) & (F.btrim("text") != ""), F.char_length("text")).otherwise(0)
    each = F.struct("page_id", "y0", (-F.col("x1")).alias("k"), "pos", "block_id")
    filled = rows.where("block_id is not null or not headed").groupBy(*keys, "headed", "part").agg(
        F.min("page_id").alias("first_page"), F.max("page_id").alias("last_page"), F.count("block_id").alias("n_blocks"), F.sum(chars).alias("text_chars"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("block_id").isNotNull(), each))), lambda x: x["block_id"]).alias("block_ids"),
    )
    heads = rows.where("head = 1").select(*keys, F.row_number().over(lesson.orderBy("page_id", "y0", F.desc("x1"), "pos")).cast("long").alias("part"), F.btrim("text").alias("heading"), F.col("block_id").alias("source_block"), F.col("page_id").alias("at_page"))
    named = lessons.select("doc_id", F.col("id").alias("lesson_id"), F.col("title").alias("lesson_title"))
    out = filled.join(heads, [*keys, "part"], "full").join(named, keys)
    own = F.col("source_block").isNotNull()
    paged = ~F.coalesce("headed", F.lit(True)) & F.lit(fallback == "page")
    title = F.when(own, F.col("heading")).when(paged, F.concat("lesson_title", F.lit(" — صفحه "), F.col("first_page").cast("string"))).otherwise(F.col("lesson_title"))
    method = F.when(own, "section_header").when(F.coalesce("headed", F.lit(True)) | paged, "page_fallback").otherwise("whole_lesson")
    none = F.array().cast("array<string>")
    return out.select(
        *keys, F.row_number().over(lesson.orderBy("part")).alias("order"), title.alias("title"), method.alias("boundary_method"), "source_block", F.coalesce("first_page", "at_page").alias("first_page"),
        F.coalesce("last_page", "at_page").alias("last_page"), F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"), F.coalesce("text_chars", F.lit(0)).cast("long").alias("text_chars"), F.coalesce("block_ids", none).alias("block_ids"),
    )


def toc_columns(lines: DataFrame, wide: float = 0.6, gap: float = 0.02) -> DataFrame:
    """Column of each line: the x-intervals of lines narrower than 60 % of the page's extent, merged; gaps of 2 % split."""
    page = W.partitionBy(*PAGE)
    li = lines.withColumn("extent", F.max("x1").over(page) - F.min("x0").over(page))
    narrow = li.where(F.col("x1") - F.col("x0") < wide * F.col("extent"))
    order = page.orderBy("x0", "x1", "line_idx")
    narrow = narrow.withColumn("reach", F.max("x1").over(order.rowsBetween(W.unboundedPreceding, -1)))
    narrow = narrow.withColumn("col", F.sum(F.when(F.col("x0") - F.col("reach") >= gap * F.col("extent"), 1).otherwise(0)).over(order.rowsBetween(W.unboundedPreceding, 0)))
    columns = narrow.groupBy(*PAGE, "col").agg(F.min("x0").alias("cx0"), F.max("x1").alias("cx1"))
    middle = (F.col("x0") + F.col("x1")) / 2
    away = F.greatest(F.lit(0.0), F.col("cx0") - middle, middle - F.col("cx1"))
    j = li.join(columns, PAGE, "left")
    return j.groupBy(*PAGE, "line_idx").agg(F.min(F.struct(away.alias("d"), F.col("col"))).alias("m")).select(*PAGE, "line_idx", F.col("m.col").alias("column"))


def opening_title(most: int = 80) -> Column:
    """Aggregate of a page's blocks: the only short block that isn't a bare number, else the first heading, else none."""
    text = F.btrim("text")
    short = (F.length(text) <= most) & (F.length(text) > 0) & ~text.rlike(r"^\p{Nd}+$")
    first = lambda which: F.min(F.when(which, F.struct("pos", text.alias("t"))))["t"]
    return F.when(F.count_if(short) == 1, first(short)).otherwise(first(F.col("block_type") == "SectionHeader"))


def lesson_opening(blocks: DataFrame, most: int = 80) -> DataFrame:
    """Title of a page: the only short block that isn't a bare number, else the first heading, else none."""
    return blocks.groupBy(*PAGE).agg(opening_title(most).alias("title"))


def number_anchors(lines: DataFrame, least: float = 3.0) -> DataFrame:
    """Numeric lines (of any of the three kinds of digits) above the widest gap between a page's distinct heights (as a ratio, 3 at least).

    Heights count to a thousandth; of gaps as wide as each other the lowest holds.
    """
    numeric = lines.where(digits_to_int(F.col("text")).isNotNull()).withColumn("h", F.bround(F.col("y1") - F.col("y0"), 3)).where("h > 0")
    heights = numeric.select(*PAGE, "h").distinct()
    ratio = heights.withColumn("next", F.lead("h").over(W.partitionBy(*PAGE).orderBy("h"))).withColumn("ratio", F.col("next") / F.col("h")).where(F.col("ratio") >= least)
    cut = ratio.groupBy(*PAGE).agg(F.min(F.struct((-F.col("ratio")).alias("k"), "h", "next")).alias("m")).select(*PAGE, F.col("m.next").alias("cut"))
    return numeric.join(cut, PAGE).where(F.col("h") >= F.col("cut") - 1e-3).select(*PAGE, "line_idx", "h")


# --- tables


def cells_to_html(cells: DataFrame, keys: list[str], rows: DataFrame | None = None) -> DataFrame:
    """One ``<table>`` per key from cells (row_id, col_id, rowspan, colspan, is_header, text).

    ``rows`` names rows (keys, row_id) that are written even if they have no cell.
    """
    tag = F.when(F.col("is_header"), "th").otherwise("td")
    span = F.concat(F.when(F.col("rowspan") > 1, F.concat(F.lit(" rowspan="), F.col("rowspan"))).otherwise(""), F.when(F.col("colspan") > 1, F.concat(F.lit(" colspan="), F.col("colspan"))).otherwise(""))
    one = cells.select(*keys, "row_id", "col_id", F.concat(F.lit("<"), tag, span, F.lit(">"), F.coalesce("text", F.lit("")), F.lit("</"), tag, F.lit(">")).alias("cell"))
    if rows is not None:
        one = one.unionByName(rows.select(*keys, "row_id"), allowMissingColumns=True)
    ordered = lambda key, v: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(key, v))), lambda s: s[v]), "")
    lines = one.groupBy(*keys, "row_id").agg(F.concat(F.lit("<tr>"), ordered("col_id", "cell"), F.lit("</tr>")).alias("line"))
    return lines.groupBy(*keys).agg(F.concat(F.lit("<table><tbody>"), ordered("row_id", "line"), F.lit("</tbody></table>")).alias("html"))


def cells_to_markdown(cells: DataFrame, keys: list[str], tables: str = "pipe") -> DataFrame:
    """(keys, markdown): pipe tables (or html ones) of cells (row_id, col_id, rowspan, colspan, is_header, text as markup).

    A cell goes to its row's next free column; places that its spans cover are blank. Columns are padded to their widest cell, empty
    rows at the top are left out, a rule follows the first row, and a table of one row gets a second one.
    """
    return cells_to_html(cells, keys).select(*keys, html_to_markdown(F.col("html"), tables=tables).alias("markdown"))


def place_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Every place of each table's grid (keys, row_id, col_id from 0, text, first: a cell begins here): rows are numbered
    anew in order, a cell goes to its row's next free column, and its spans cover blank places."""
    line = F.sort_array(F.collect_list(F.struct("col_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("rowspan", F.lit(1)).cast("int").alias("rowspan"), F.coalesce("colspan", F.lit(1)).cast("int").alias("colspan"))))
    lines = cells.groupBy(*keys, "row_id").agg(line.alias("cells"))
    tables = lines.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("row_id", "cells"))), lambda r: r["cells"]).alias("rows"))

    @F.pandas_udf("array<struct<row_id: int, col_id: int, text: string, first: boolean>>")
    def grid(rows: pd.Series) -> pd.Series:
        out = []
        for table in rows:
            placed = grid_of([[(c["text"], c["rowspan"], c["colspan"]) for c in line] for line in table])
            out.append([(r, c, text, first) for r, line in enumerate(placed) for c, (text, first) in enumerate(line)])
        return pd.Series(out)

    return tables.select(*keys, F.explode(grid("rows")).alias("p")).select(*keys, "p.*")


def header_band(rows: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """First data row: the first of two tokens or more, over half numeric; else the first of two or more below sparse rows."""
    data = F.min(F.when((F.col("n_tokens") >= least) & (F.col("n_numeric") > 0.5 * F.col("n_tokens")), F.col("row_id")))
    rich = F.min(F.when(F.col("n_tokens") >= least, F.col("row_id")))
    g = rows.groupBy(*keys).agg(data.alias("data"), rich.alias("rich"), F.min("row_id").alias("top"))
    return g.select(*keys, F.coalesce("data", F.when(F.col("rich") > F.col("top"), F.col("rich"))).alias("first_data_row"))


def join_tables(cells: DataFrame, merges: DataFrame, keys: list[str]) -> DataFrame:
    """Tables accepted as continuations move to the table they continue.

    ``merges``: keys of the table (``*_1``), of its continuation (``*_2``) and ``direction``. Below (``bottom``), row ids shift by the first
    table's rows, refused if the column counts differ by two or more; beside it (``right``), column ids shift by its
    columns, refused if the row counts differ by five or more. Rows and columns are counted with spans.
    """
    shape = table_shape(cells, keys)
    named = lambda n: shape.select(*[F.col(k).alias(f"{k}_{n}") for k in keys], F.col("n_rows").alias(f"rows_{n}"), F.col("n_cols").alias(f"cols_{n}"))
    bottom = F.col("direction") == "bottom"
    fits = F.when(bottom, F.abs(F.col("cols_1") - F.col("cols_2")) < 2).otherwise((F.col("direction") == "right") & (F.abs(F.col("rows_1") - F.col("rows_2")) < 5))
    good = merges.join(named(1), [f"{k}_1" for k in keys]).join(named(2), [f"{k}_2" for k in keys]).where(fits)
    down, over = F.when(bottom, F.col("rows_1")).otherwise(0), F.when(bottom, 0).otherwise(F.col("cols_1"))
    moved = cells.join(good.select(*[F.col(f"{k}_2").alias(k) for k in keys], *[f"{k}_1" for k in keys], down.alias("down"), over.alias("over")), keys, "left")
    shifted = lambda c, by: (F.col(c) + F.coalesce(by, F.lit(0))).alias(c)
    return moved.select(*[F.coalesce(f"{k}_1", k).alias(k) for k in keys], shifted("row_id", "down"), shifted("col_id", "over"), "text")


def table_merge_candidates(tables: DataFrame, tall: float = 0.6, alike: float = 0.25, beside: float = 20.0, below: float = 10.0, gap: float = 50.0) -> DataFrame:
    """Tables in order, each with its run (``run``, a number of the document) and how it follows the one before (``how``; null where a run starts).

    ``tables``: doc_id, page_id, pos, box, page_height, n_rows, n_cols. Rows match if their counts differ by less than five, columns by less than
    two. A table goes on with the next one if that is

    * ``page``: on the next page, either takes over ``tall`` of the page's height, either is its page's only table, and rows or columns match;
    * ``beside``: on the same page, heights alike, its left edge near the right one of this, tops near each other, rows match;
    * ``below``: on the same page, widths alike, its top near the bottom of this, left edges near each other, columns match;
    * ``column``: on the same page, its left edge within ``gap`` of the right one of this, its top above the bottom of this, widths alike, columns match.
    """
    w = W.partitionBy("doc_id").orderBy("page_id", "pos")
    before = lambda c: F.lag(c).over(w)
    sized = tables.withColumns({"n_on_page": F.count("*").over(W.partitionBy(*PAGE)), "height": F.col("y1") - F.col("y0"), "width": F.col("x1") - F.col("x0")})
    rows, cols = F.abs(before("n_rows") - F.col("n_rows")) < 5, F.abs(before("n_cols") - F.col("n_cols")) < 2
    same = before("page_id") == F.col("page_id")
    near = lambda a, b, most: F.abs(F.col(a) - before(b)) < most
    ratio = lambda c: F.try_divide(before(c), F.col(c))
    close = lambda r: (r > 1 - alike) & (r < 1 + alike)
    page = (before("page_id") == F.col("page_id") - 1) & (F.greatest(before("height"), F.col("height")) / F.col("page_height") > tall) & ((F.col("n_on_page") == 1) | (before("n_on_page") == 1)) & (rows | cols)
    side = same & close(ratio("height")) & near("x0", "x1", beside) & near("y0", "y0", beside) & rows
    under = same & close(ratio("width")) & near("y0", "y1", below) & near("x0", "x0", below) & cols
    column = same & near("x0", "x1", gap) & (F.col("y0") < before("y1")) & (F.col("width") * (1 - alike) < before("width")) & (before("width") < F.col("width") * (1 + alike)) & cols
    how = F.when(page, "page").when(side, "beside").when(under, "below").when(column, "column")
    told = sized.withColumn("how", how)
    return told.withColumn("run", F.sum(F.when(F.col("how").isNull(), 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0))).drop("n_on_page", "height", "width")


def table_runs(candidates: DataFrame) -> DataFrame:
    """Runs of two tables or more: (doc_id, run, first page and place, n_tables, tables in order)."""
    each = F.sort_array(F.collect_list(F.struct("page_id", "pos", "how")))
    runs = candidates.groupBy("doc_id", "run").agg(each.alias("tables")).where(F.size("tables") > 1)
    return runs.select("doc_id", "run", F.get("tables", F.lit(0))["page_id"].alias("first_page"), F.get("tables", F.lit(0))["pos"].alias("first_pos"), F.size("tables").alias("n_tables"), "tables")
