"""Operators whose rule keeps a running state inside one page, list or document.

Each group is a page or a document (tens of rows), dealt by its key and handled by a small helper that gets many groups
at a time; no group grows with the data.
"""

from __future__ import annotations

from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from quire.functions import geometry as G
from quire.operators.blocks import PAGE, by_page
from quire.operators.streams import Columns, Groups, solve_groups


def rtl_reading_order(lines: DataFrame, least: float = 0.5, keys: dict[str, str] | None = None) -> DataFrame:
    """Lines in rows (half of the lower height in common with the row's first line), rows down, right to left inside.

    ``keys``: further columns (with their types) that part the lines of a page.
    """
    keys = keys or {}
    group = [*PAGE, *keys]

    def order(columns: Columns, groups: Groups) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        top, low, right, line = (columns[c] for c in ("y0", "y1", "x1", "line_idx"))
        sizes = [b - a for a, b in groups]
        of = np.repeat(np.arange(len(groups)), sizes)
        row, first = np.empty(len(of), np.int64), np.empty(len(of))
        tops, lows, at, group_of = top.tolist(), low.tolist(), np.lexsort((line, -right, top, of)).tolist(), of.tolist()
        heads: list[tuple[float, float]] = []
        now = -1
        for i in at:
            if group_of[i] != now:
                now, heads = group_of[i], []
            y0, y1 = tops[i], lows[i]
            for k, (a, b) in enumerate(heads):
                least_height = min(b - a, y1 - y0)
                if least_height > 0 and (min(b, y1) - max(a, y0)) / least_height >= least:
                    break
            else:
                k = len(heads)
                heads.append((y0, y1))
            row[i], first[i] = k, heads[k][0]
        out = np.lexsort((line, -right, row, first, of))  # a row's first line is its highest
        return out, {"row": row[out], "new_pos": np.arange(len(of)) - np.repeat([a for a, _ in groups], sizes)}

    return solve_groups(lines.select(*group, "line_idx", "x1", "y0", "y1"), group, ["line_idx"], [*group, "line_idx"], {"row": T.IntegerType(), "new_pos": T.IntegerType()}, order)


def split_heights(values: list[float], k: int) -> list[float]:
    """Least value of each of the k classes of exact one-dimensional k-means, tallest first.

    Equal values are one weighted point, and a layer of the recurrence is a vector operation for each end.
    """
    v, weight = np.unique(np.asarray(values, dtype=float), return_counts=True)
    n, k = len(v), min(k, len(v))
    w, total, square = (np.concatenate([[0.0], np.cumsum(x)]) for x in (weight, weight * v, weight * v * v))
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    cuts = []
    for _ in range(k):
        row, at = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=int)
        for j in range(1, n + 1):
            option = best[:j] + square[j] - square[:j] - (total[j] - total[:j]) ** 2 / (w[j] - w[:j])
            at[j] = int(np.argmin(option))
            row[j] = option[at[j]]
        best = row
        cuts.append(at)
    edges, j = [], n
    for at in reversed(cuts):
        j = at[j]
        edges.append(float(v[j]))
    return edges


def heading_levels(headings: DataFrame, levels: int = 4, default: int = 2, tolerance: float = 0.99) -> DataFrame:
    """Level of each heading of a document by its line height, tallest first; few headings get the default."""

    def classify(columns: Columns, groups: Groups) -> tuple[np.ndarray, dict[str, list[int]]]:
        level: list[int] = []
        for a, b in groups:
            heights = columns["height"][a:b]
            if b - a <= levels:
                level += [default] * (b - a)
            else:
                edges = split_heights(heights.round(3).tolist(), levels)
                level += [next((i + 1 for i, e in enumerate(edges) if h >= e * tolerance), default) for h in heights.tolist()]
        return np.arange(len(level)), {"level": level}

    return solve_groups(headings.select("doc_id", "pos", F.col("height").cast("double").alias("height")), ["doc_id"], ["pos"], ["doc_id", "pos"], {"level": T.IntegerType()}, classify)


def blockquotes(blocks: DataFrame, indent: float = 0.1, same: float = 0.01) -> DataFrame:
    """Quote level of the text blocks of a page: indented below the one before is a quote, aligned with a quote keeps it.

    A block neither indented nor aligned, or not right behind another, ends all quotes: the level is the number of indents since.
    """
    w = by_page()
    before = lambda c: F.lag(c).over(w)
    width = before("x1") - before("x0")
    next_to = F.col("pos") == before("pos") + 1
    inner = next_to & (F.col("x0") > before("x0") + indent * width) & (F.col("y0") > before("y1"))
    aligned = next_to & (F.abs(F.col("x0") - before("x0")) < same * width) & (F.abs(F.col("x1") - before("x1")) < same * width)
    yes = lambda c: F.coalesce(c, F.lit(False))
    marked = blocks.select(*PAGE, "pos", yes(inner).alias("inner"), (~yes(inner | aligned)).cast("int").alias("fresh"), "x0", "y0")
    runs = marked.withColumn("run", F.sum("fresh").over(w.rowsBetween(W.unboundedPreceding, 0)))
    inside = W.partitionBy(*PAGE, "run").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    return runs.select(*PAGE, "pos", F.count_if("inner").over(inside).cast("int").alias("level"))


def list_indent(items: DataFrame, page_width: float, least: float = 0.01) -> DataFrame:
    """Nesting level of list items by their left edges; a column break starts anew."""
    step = least * page_width

    def nest(columns: Columns, groups: Groups) -> tuple[np.ndarray, dict[str, list[int]]]:
        x0, y0, x1 = (columns[c].tolist() for c in ("x0", "y0", "x1"))
        level: list[int] = []
        for a, b in groups:
            stack: list[tuple[float, float, int]] = []
            for i in range(a, b):
                left, top = x0[i], y0[i]
                while stack and left <= stack[-1][0] + step:
                    stack.pop()
                level.append(stack[-1][2] + 1 if stack and top > stack[-1][1] else 0)
                if i + 1 < b and x0[i + 1] > x1[i]:
                    stack = []
                else:
                    stack.append((left, top, level[-1]))
        return np.arange(len(level)), {"level": level}

    return solve_groups(items.select(*PAGE, "pos", "x0", "y0", "x1", "y1"), PAGE, ["pos"], [*PAGE, "pos"], {"level": T.IntegerType()}, nest)


def group_captions(blocks: DataFrame, page_height: float, near: float = 0.05) -> DataFrame:
    """Tables and pictures with the caption or footnote right before or after, closer than 5 % of the page; a caption before is taken once.

    What stands two before decides whether the caption before is taken, so windows suffice.
    """
    w = by_page()
    owner, caption = F.col("block_type").isin("Table", "Figure", "Picture"), F.col("block_type").isin("Caption", "Footnote")
    b = blocks.select(*PAGE, "pos", "block_type", F.struct("pos", "x0", "y0", "x1", "y1").alias("me"), owner.alias("owner"), caption.alias("caption"))
    b = b.withColumn("close", F.coalesce(G.minimum_gap(F.col("me"), F.lead("me").over(w)) < near * page_height, F.lit(False)))  # to the next
    at = lambda c, k: F.coalesce(F.lag(c, k).over(w), F.lit(False))
    takes_before = at("caption", 1) & at("close", 1) & ~(at("owner", 2) & at("close", 2))
    takes_after = F.coalesce(F.lead("caption").over(w), F.lit(False)) & F.col("close")
    b = b.withColumn("members", F.array_compact(F.array(F.when(takes_before, F.lag("me").over(w)), F.col("me"), F.when(takes_after, F.lead("me").over(w)))))
    found = b.where(F.col("owner") & (F.size("members") > 1))
    edge = lambda k, f: f(F.transform("members", lambda m: m[k])).alias(k)
    return found.select(
        *PAGE, "pos", F.concat("block_type", F.lit("Group")).alias("block_type"), F.array_join(F.transform("members", lambda m: m["pos"].cast("string")), ",").alias("members"),
        edge("x0", F.array_min), edge("y0", F.array_min), edge("x1", F.array_max), edge("y1", F.array_max),
    )


def merge_math_lines(lines: DataFrame, overlap: float = 0.015, vertical: float = 0.8) -> DataFrame:
    """Runs of neighbouring lines on one baseline whose boxes overlap: ``run`` starts at the first line; runs of two or more are maths."""

    def runs(columns: Columns, groups: Groups) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        x0, y0, x1, y1 = (columns[c] for c in ("x0", "y0", "x1", "y1"))
        wide = np.maximum(0.0, np.minimum(x1[1:], x1[:-1]) - np.maximum(x0[1:], x0[:-1])) * np.maximum(0.0, np.minimum(y1[1:], y1[:-1]) - np.maximum(y0[1:], y0[:-1]))
        touch = (wide / np.maximum(1.0, (x1[1:] - x0[1:]) * (y1[1:] - y0[1:])) >= overlap).tolist()
        tops, ends, head = y0.tolist(), y1.tolist(), []
        for start, stop in groups:
            first = start
            for i in range(start, stop):
                if i > start and not (touch[i - 1] and (min(ends[first], ends[i]) - max(tops[first], tops[i])) / max(1.0, ends[i] - tops[i]) > vertical):
                    first = i
                head.append(first)
        at = np.array(head, int)
        return np.arange(len(at)), {"run": columns["line_idx"][at], "math": np.bincount(at)[at] > 1}

    return solve_groups(lines.select(*PAGE, "line_idx", "x0", "y0", "x1", "y1"), PAGE, ["line_idx"], [*PAGE, "line_idx"], {"run": T.IntegerType(), "math": T.BooleanType()}, runs)


# --- helpers on columns


_CELL = T.ArrayType(T.StructType([T.StructField(k, t) for k, t in (("row_id", T.IntegerType()), ("col_id", T.IntegerType()), ("rowspan", T.IntegerType()), ("colspan", T.IntegerType()), ("is_header", T.BooleanType()), ("text", T.StringType()))]))


def parse_table(html: str) -> list[tuple[int, int, int, int, bool, str]]:
    """Cells of the first table with their places on the grid; spans are clipped at its edges."""
    rows: list[list[list]] = []

    class Reader(HTMLParser):
        inside = 0

        def handle_starttag(self, tag, attrs):
            if tag == "table":
                self.inside += 1
            if self.inside <= 0:
                return
            if tag == "tr":
                rows.append([])
            elif tag in ("td", "th") and rows:
                number = lambda k: int(v) if (v := dict(attrs).get(k) or "1").isdigit() else 1
                rows[-1].append([tag == "th", number("rowspan"), number("colspan"), ""])
            elif tag == "br" and rows and rows[-1]:
                rows[-1][-1][3] += "<br>"

        def handle_endtag(self, tag):
            if tag == "table" and self.inside:
                self.inside = -1000  # only the first table

        def handle_data(self, data):
            if self.inside > 0 and rows and rows[-1]:
                rows[-1][-1][3] += data

    Reader().feed(html)
    width = max((sum(c[2] for c in r) for r in rows), default=0)
    free = np.ones((len(rows), width), dtype=bool)
    out = []
    for i, row in enumerate(rows):
        at = 0
        for header, down, across, text in row:
            while at < width and not free[i, at]:
                at += 1
            if at >= width:
                break
            down, across = min(down, len(rows) - i), min(across, width - at)
            if down and across:
                free[i : i + down, at : at + across] = False
                out.append((i, at, down, across, header, text.strip()))
                at += across
    return out


@F.pandas_udf(_CELL)
def html_to_cells(s: pd.Series) -> pd.Series:
    names = ("row_id", "col_id", "rowspan", "colspan", "is_header", "text")
    return pd.Series([None if h is None else [dict(zip(names, c, strict=True)) for c in parse_table(h)] for h in s], dtype=object)


def number_lessons(printed: list[int | None]) -> list[int]:
    """Each printed number if it is still free, else the lowest free one; what is lowest only grows, so one pass does."""
    used: set[int] = set()
    lowest, out = 1, []
    for number in printed:
        if number is None or number in used:
            while lowest in used:
                lowest += 1
            number = lowest
        used.add(number)
        out.append(number)
    return out


def lesson_numbers(lessons: DataFrame) -> DataFrame:
    """Printed number if it is still free in the book, else the lowest free one, in page order (first_page, id)."""

    def number(columns: Columns, books: Groups) -> tuple[np.ndarray, dict[str, list[int]]]:
        printed = [None if pd.isna(x) else int(x) for x in columns["printed"].tolist()]
        return np.arange(len(printed)), {"number": [n for start, stop in books for n in number_lessons(printed[start:stop])]}

    rows = lessons.select("package_id", "id", "first_page", "printed")
    return solve_groups(rows, ["package_id"], ["first_page", "id", "printed"], ["package_id", "id"], {"number": T.IntegerType()}, number)
