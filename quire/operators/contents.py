"""Contents lists of books: rows from scattered lines, units and their pages, decorative spreads, and which list counts.

Joins and windows are inside one page; the two rules with a running state (rows of a page, the match of anchors to
numbers) are small helpers over a page's items.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from quire.functions import geometry as G
from quire.functions.text import UNIT_WORD, bind, compact, compact_heading, digits_to_int, split_trailing_page
from quire.operators.blocks import PAGE
from quire.operators.books import number_anchors, toc_columns
from quire.operators.grouped import rtl_reading_order
from quire.operators.pages import anchor_clusters
from quire.operators.streams import Columns, Groups, solve_groups


def least_cost(cost: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) pairs of least total cost, each row and column once; rows beyond the number of columns get none.

    Shortest augmenting paths: exact for any number of columns, in time that grows with their cube.
    """
    n_cols = cost.shape[1]
    cost = cost[:n_cols]
    owner = np.full(n_cols, -1)
    row_price, col_price = np.zeros(len(cost)), np.zeros(n_cols)
    for row in range(len(cost)):
        reach, came, done = np.full(n_cols, np.inf), np.full(n_cols, -1), np.zeros(n_cols, bool)
        at, i, far = -1, row, 0.0
        while i >= 0:  # grow the cheapest path until it ends at a free column
            step = far + cost[i] - row_price[i] - col_price
            better = ~done & (step < reach)
            reach[better], came[better] = step[better], at
            at = int(np.argmin(np.where(done, np.inf, reach)))
            far, done[at] = reach[at], True
            i = int(owner[at])
        row_price[row] += far
        for j in np.flatnonzero(done):
            if owner[j] >= 0:
                row_price[owner[j]] += far - reach[j]
            col_price[j] -= far - reach[j]
        while at >= 0:  # hand columns on along the path
            back = int(came[at])
            owner[at] = row if back < 0 else owner[back]
            at = back
    return sorted((int(i), j) for j, i in enumerate(owner) if i >= 0)


def assign_numbers(anchors: DataFrame, numbers: DataFrame) -> DataFrame:
    """(page, anchor, number): each anchor with at most one number of its page, so that the distances of centres are least in total.

    ``anchors``: doc_id, page_id, line_idx, box; ``numbers``: the same with ``value``. A value printed twice counts where it comes first.
    """
    item = lambda df, kind, value: df.select(*PAGE, "line_idx", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"), F.lit(kind).alias("kind"), value.cast("long").alias("value"))
    items = item(anchors, 0, F.lit(0)).unionByName(item(numbers.where("value is not null"), 1, F.col("value")))

    def match(columns: Columns, groups: Groups) -> tuple[list[int], dict[str, list[int]]]:
        kind, value, x, y = (columns[c] for c in ("kind", "value", "x", "y"))
        rows, found = [], []
        for start, stop in groups:
            split = start + int(np.searchsorted(kind[start:stop], 1))
            if start < split < stop:
                b = split + np.sort(np.unique(value[split:stop], return_index=True)[1])  # a value counts where it comes first
                cost = np.hypot(x[start:split, None] - x[b], y[start:split, None] - y[b])
                pairs = least_cost(cost)
                rows += [start + i for i, _ in pairs]
                found += [int(value[b[j]]) for _, j in pairs]
        return rows, {"number": found}

    return solve_groups(items, PAGE, ["kind", "line_idx"], [*PAGE, "line_idx"], {"number": T.LongType()}, match)


def decorative_toc(lines: DataFrame, counts: DataFrame, least: int = 3, same_row: float = 0.5) -> DataFrame:
    """Rows of contents pages set along curves: printed page (a large number), title (the fragments nearest to it, joined from the
    top), number and whether the title is approximate (over two fragments).

    ``counts``: doc_id, page_count. Pages with under three large numbers within the book's pages have none.
    """
    sized = number_anchors(lines).select(*PAGE, "line_idx").join(lines, [*PAGE, "line_idx"]).withColumn("value", digits_to_int(F.col("text"))).join(counts, "doc_id")
    sized = sized.where((F.col("value") > 0) & (F.col("value") <= F.col("page_count"))).withColumn("n", F.count("*").over(W.partitionBy(*PAGE)))
    anchors = sized.where(F.col("n") >= least).select(*PAGE, "line_idx", "value", "x0", "y0", "x1", "y1")
    rest = lines.join(anchors.select(*PAGE).distinct(), PAGE, "left_semi").join(anchors.select(*PAGE, "line_idx"), [*PAGE, "line_idx"], "left_anti")
    numbers = assign_numbers(anchors, rest.withColumn("value", digits_to_int(F.col("text"))))
    near = anchor_clusters(rest, anchors.withColumn("pos", F.col("line_idx"))).select(*PAGE, "line_idx", "anchor_pos")
    words = rest.where(F.col("text").rlike(r"[\u0600-\u06ff]")).join(near, [*PAGE, "line_idx"])
    order = W.partitionBy(*PAGE, "anchor_pos").orderBy("y0", "line_idx")
    piece, before = F.replace("text", F.lit("\n"), F.lit(" ")), F.lag("text").over(order)
    aligned = F.coalesce(G.vertical_overlap_ratio(F.lag(G.box()).over(order), G.box()) >= same_row, F.lit(True))
    gap = F.when(aligned | F.coalesce(before.endswith(" "), F.lit(True)) | piece.startswith(" "), "").otherwise(" ")
    joined = words.withColumn("piece", F.concat(gap, piece)).groupBy(*PAGE, "anchor_pos").agg(
        F.btrim(F.regexp_replace(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("y0", "line_idx", "piece"))), lambda x: x["piece"]), ""), r"\s+", " ")).alias("title"), F.count("*").alias("n"),
    )
    j = anchors.join(joined.withColumnRenamed("anchor_pos", "line_idx"), [*PAGE, "line_idx"], "left").join(numbers, [*PAGE, "line_idx"], "left")
    return j.select(*PAGE, "line_idx", F.col("value").alias("printed_page"), F.coalesce("title", F.lit("")).alias("title"), "number", (F.coalesce("n", F.lit(0)) > 2).alias("approximate"))


def contents_rows(lines: DataFrame) -> DataFrame:
    """Visual rows of a page's columns: fragments joined right to left, their box and number, and the title and page that the text splits into.

    ``row_id`` counts down the page.
    """
    placed = lines.join(toc_columns(lines), [*PAGE, "line_idx"])
    rows = rtl_reading_order(placed, keys={"column": "long"})
    j = placed.join(rows.select(*PAGE, "line_idx", "row"), [*PAGE, "line_idx"])
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("x1")).alias("k"), "line_idx", "text"))), lambda x: x["text"]), " ")
    g = j.groupBy(*PAGE, "column", "row").agg(F.btrim(F.regexp_replace(text, r"\s+", " ")).alias("text"), F.count("*").alias("fragments"), *G.merge_boxes()).where("text <> ''")
    split = split_trailing_page(F.col("text"))
    order = W.partitionBy(*PAGE).orderBy("y0", "column", "row")
    return g.select(*PAGE, (F.row_number().over(order) - 1).alias("row_id"), "text", F.coalesce(split["title"], F.btrim("text")).alias("title"), split["page"].alias("printed_page"), "fragments", "x0", "y0", "x1", "y1")


def label_units(rows: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows with ``unit_word`` and ``unit_index`` (null: no unit), and the page of a unit whose title wrapped.

    A row that starts with a word the page's other units have is a unit without an index. A unit without a page takes that of the next
    row down in its column, unless that is a unit. ``rows``: doc_id, page_id, row_id, title, printed_page, x0, x1.
    """
    page = W.partitionBy(*PAGE)
    read = bind(compact(F.col("title")), lambda t: F.struct(compact_heading(t).alias("m"), F.substring(t, 1, UNIT_WORD + 1).alias("plain")))  # a title is read once
    m = rows.withColumn("read", read).select(*rows.columns, "read.m", "read.plain")
    m = m.withColumn("known", F.collect_set(F.when(F.col("m.word") != "", F.col("m.word"))).over(page))
    starts = F.filter("known", lambda w: F.col("plain").startswith(w) & (F.char_length("plain") > F.char_length(w)))
    longest = F.array_max(F.transform(starts, lambda w: F.struct(F.char_length(w).alias("n"), w.alias("w"))))["w"]
    m = m.withColumns({"unit_word": F.coalesce(F.col("m.word"), longest), "unit_index": F.col("m.index")}).drop("m", "plain", "known")

    def below(f: Column) -> Column:
        common, narrow = F.least("x1", f["x1"]) - F.greatest("x0", f["x0"]), F.least(F.col("x1") - F.col("x0"), f["x1"] - f["x0"])
        return (f["row_id"] > F.col("row_id")) & (common > 0) & (narrow > 0) & (common / narrow >= least)

    m = m.withColumn("others", F.collect_list(F.struct("row_id", "unit_word", "printed_page", "x0", "x1")).over(page))
    next_row = F.array_min(F.filter("others", below))
    carried = F.when(F.col("unit_word").isNotNull() & F.col("printed_page").isNull(), bind(next_row, lambda f: F.when(f["unit_word"].isNull(), f["printed_page"])))
    return m.withColumn("printed_page", F.coalesce("printed_page", carried)).drop("others")


def plain_toc(labelled: DataFrame, counts: DataFrame, least: int = 5, distinct: float = 0.9, reach: float = 0.4) -> DataFrame:
    """Unit rows with a page of the book, on pages that are contents lists: at least five such rows, 90 % different pages, reaching 40 % into the book.

    ``counts``: doc_id, page_count.
    """
    rows = labelled.join(counts, "doc_id").where("unit_word is not null and printed_page > 0 and printed_page <= page_count")
    page = W.partitionBy(*PAGE)
    g = rows.withColumns({"n": F.count("*").over(page), "d": F.size(F.collect_set("printed_page").over(page)), "top": F.max("printed_page").over(page), "pages": F.max("page_count").over(page)})
    good = (F.col("n") >= least) & (F.col("d") >= distinct * F.col("n")) & (F.col("top") >= reach * F.col("pages"))
    return g.where(good).select(*PAGE, "row_id", "title", "printed_page", F.col("unit_index").alias("number"))


def choose_toc(decorative: DataFrame, plain: DataFrame) -> DataFrame:
    """The rows of each book's contents, with ``toc_source``: a decorative list wins over a plain one. ``row_id`` is the row, or the anchor's line."""
    columns = ["doc_id", "page_id", "row_id", "title", "printed_page", "number"]
    first = decorative.withColumnsRenamed({"line_idx": "row_id"}).select(*columns, F.lit("decorative").alias("toc_source"))
    second = plain.join(decorative.select("doc_id").distinct(), "doc_id", "left_anti").select(*columns, F.lit("plain").alias("toc_source"))
    return first.unionByName(second)
