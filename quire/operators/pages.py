"""Joins of lines, blocks and other page items by geometry, order or key.

Each is an equi-join on (doc_id, page_id) with a predicate inside the page; pages hold tens of items, so a
page's pairs are bounded by the page, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions import geometry as G
from quire.operators.blocks import PAGE


def _on_page(left: str, right: str) -> Column:
    return (F.col(f"{left}.doc_id") == F.col(f"{right}.doc_id")) & (F.col(f"{left}.page_id") == F.col(f"{right}.page_id"))


def assign_lines_to_blocks(lines: DataFrame, blocks: DataFrame, far: float = 20.0) -> DataFrame:
    """(doc_id, page_id, line_idx, pos, how): the block with the largest overlap (first on ties), else the
    nearest by centre, horizontal distance weighed five times, under ``far``; else none (``orphan``)."""
    j = lines.alias("l").join(blocks.alias("b"), _on_page("l", "b"), "left")
    a, b = G.box(alias="l"), G.box(alias="b")
    found = j.groupBy("l.doc_id", "l.page_id", "l.line_idx").agg(
        F.min(F.when(G.intersection_area(a, b) > 0, F.struct((-G.intersection_area(a, b)).alias("k"), F.col("b.pos").alias("pos")))).alias("best"),
        F.min(F.when(F.col("b.pos").isNotNull(), F.struct(G.center_distance(a, b, 5.0).alias("k"), F.col("b.pos").alias("pos")))).alias("near"),
    )
    close = F.col("near.k") < far
    return found.select(
        *PAGE, "line_idx", F.coalesce(F.col("best.pos"), F.when(close, F.col("near.pos"))).alias("pos"),
        F.when(F.col("best").isNotNull(), "overlap").when(close, "distance").otherwise("orphan").alias("how"),
    )


def orphan_line_blocks(lines: DataFrame, gap: float = 20.0) -> DataFrame:
    """Runs of neighbouring unassigned lines, each at most ``gap`` from the one before, as new blocks."""
    w = W.partitionBy(*PAGE).orderBy("line_idx")
    far = F.greatest(F.abs(F.col("x0") - F.lag("x0").over(w)), F.abs(F.col("y0") - F.lag("y1").over(w)))
    runs = lines.where("y1 - y0 > 1").withColumn("far", far)
    runs = runs.withColumn("run", F.sum(F.when(F.col("far") <= gap, 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return runs.groupBy(*PAGE, "run").agg(F.min("line_idx").alias("first_line"), F.count("*").alias("n_lines"), *G.merge_boxes())


def line_coverage(blocks: DataFrame, lines: DataFrame, excluded: list[str], least: float = 0.25) -> DataFrame:
    """(page, covered, total, ok): blocks that touch a line."""
    b = blocks.where(~F.col("block_type").isin(excluded))
    hit = b.alias("b").join(lines.alias("l"), _on_page("b", "l") & (G.intersection_area(G.box(alias="b"), G.box(alias="l")) > 0), "left_semi").select(*PAGE, "pos", F.lit(1).alias("hit"))
    joined = b.select(*PAGE, "pos").join(hit, [*PAGE, "pos"], "left").groupBy(*PAGE).agg(F.count("hit").alias("covered"), F.count("*").alias("total"))
    return joined.withColumn("ok", F.col("covered") / F.col("total") >= least)


def line_self_overlap(lines: DataFrame, least_area: float = 0.1, most: int = 2, share: float = 0.5) -> DataFrame:
    """(page, n_lines, n_bad, ok): a line is bad that overlaps more than ``most`` lines, itself counted."""
    j = lines.alias("a").join(lines.alias("b"), _on_page("a", "b") & (G.intersection_area(G.box(alias="a"), G.box(alias="b")) > least_area), "left")
    each = j.groupBy("a.doc_id", "a.page_id", "a.line_idx").agg(F.count("b.line_idx").alias("n"))
    page = each.groupBy(*PAGE).agg(F.count("*").alias("n_lines"), F.count_if(F.col("n") > most).alias("n_bad"))
    return page.withColumn("ok", F.col("n_bad") / F.col("n_lines") <= share)


def choose_text_source(pages: DataFrame) -> DataFrame:
    """``source``: embedded for pages with lines whose text, coverage and overlaps are all good, else ocr."""
    good = (F.coalesce("n_lines", F.lit(0)) > 0) & ~F.coalesce("bad_text", F.lit(False)) & F.coalesce("coverage_ok", F.lit(True)) & F.coalesce("overlap_ok", F.lit(True))
    return pages.withColumn("source", F.when(good, "embedded").otherwise("ocr"))


def refs_to_blocks(refs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each reference point with the block whose top left corner is nearest (first on ties)."""
    d = F.sqrt(F.pow(F.col("r.x") - F.col("b.x0"), 2) + F.pow(F.col("r.y") - F.col("b.y0"), 2))
    j = refs.alias("r").join(blocks.alias("b"), _on_page("r", "b"))
    return j.groupBy("r.doc_id", "r.page_id", "r.ref").agg(F.min(F.struct(d.alias("d"), F.col("b.pos").alias("pos"))).alias("m")).select(*PAGE, "ref", "m.pos")


def drop_contained_in_tables(blocks: DataFrame, tables: DataFrame, share: float = 0.95) -> DataFrame:
    inside = G.intersection_pct(G.box(alias="b"), G.box(alias="t")) > share
    return blocks.alias("b").join(tables.alias("t"), _on_page("b", "t") & inside, "left_anti")


def expand_layout_blocks(blocks: DataFrame, types: list[str], page: tuple[float, float], most: float = 0.05) -> DataFrame:
    """Boxes of the given types grow by the smallest gap to any other block of the page, at most 5 % of their size."""
    grow = blocks.where(F.col("block_type").isin(types))
    gap = F.min(G.minimum_gap(G.box(alias="a"), G.box(alias="b"))).alias("gap")
    j = grow.alias("a").join(blocks.alias("b"), _on_page("a", "b") & (F.col("a.pos") != F.col("b.pos")), "left")
    g = j.groupBy("a.doc_id", "a.page_id", "a.pos", "a.x0", "a.y0", "a.x1", "a.y1").agg(gap)
    w, h = (F.col("x1") - F.col("x0")) * most, (F.col("y1") - F.col("y0")) * most
    dx, dy = F.least(F.coalesce("gap", w), w), F.least(F.coalesce("gap", h), h)
    return g.select(*PAGE, "pos", F.greatest(F.lit(0.0), F.col("x0") - dx).alias("x0"), F.greatest(F.lit(0.0), F.col("y0") - dy).alias("y0"), F.least(F.lit(page[0]), F.col("x1") + dx).alias("x1"), F.least(F.lit(page[1]), F.col("y1") + dy).alias("y1"))


def recover_lines(lines: DataFrame, blocks: DataFrame, most: float = 0.5) -> DataFrame:
    """Lines that text-bearing blocks cover by less than half."""
    over = F.sum(G.intersection_area(G.box(alias="l"), G.box(alias="b")))
    j = lines.alias("l").join(blocks.alias("b"), _on_page("l", "b"), "left")
    size = F.max(G.area(G.box(alias="l")))
    g = j.groupBy("l.doc_id", "l.page_id", "l.line_idx").agg(over.alias("over"), size.alias("size"))
    covered = F.when(F.col("size") <= 0, 0.0).otherwise(F.least(F.lit(1.0), F.coalesce("over", F.lit(0.0)) / F.col("size")))
    return g.select(*PAGE, "line_idx", covered.alias("covered")).where(F.col("covered") < most)


def last_before(points: DataFrame, marks: DataFrame, value: str) -> DataFrame:
    """As-of join within a page: each point takes ``value`` of the last mark at or above its y0.

    One sort by page and height of both tables together, no pairs.
    """
    tagged = marks.select(*PAGE, "y0", F.lit(0).alias("kind"), F.col("pos").alias("at"), F.col(value).alias("v")).unionByName(points.select(*PAGE, "y0", F.lit(1).alias("kind"), F.col("line_idx").alias("at"), F.lit(None).cast("string").alias("v")))
    w = W.partitionBy(*PAGE).orderBy("y0", "kind", "at")
    out = tagged.withColumn(value, F.last("v", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return out.where("kind = 1").select(*PAGE, F.col("at").alias("line_idx"), value)


def nearest_caption(assets: DataFrame, captions: DataFrame) -> DataFrame:
    """The caption nearest to an image's bottom, those below it first."""
    below = (F.col("c.y0") >= F.col("a.y1") - 1).cast("int")
    key = F.struct((-below).alias("b"), F.abs(F.col("c.y0") - F.col("a.y1")).alias("d"), F.col("c.pos").alias("pos"))
    j = assets.alias("a").join(captions.alias("c"), _on_page("a", "c"), "left")
    return j.groupBy("a.doc_id", "a.page_id", "a.pos").agg(F.min(F.when(F.col("c.pos").isNotNull(), key)).alias("k")).select(*PAGE, "pos", F.col("k.pos").alias("caption_pos"))


def anchor_clusters(lines: DataFrame, anchors: DataFrame) -> DataFrame:
    """Each line with the anchor whose centre is nearest."""
    d = G.center_distance(G.box(alias="l"), G.box(alias="a"))
    j = lines.alias("l").join(anchors.alias("a"), _on_page("l", "a"))
    return j.groupBy("l.doc_id", "l.page_id", "l.line_idx").agg(F.min(F.struct(d.alias("d"), F.col("a.pos").alias("pos"))).alias("m")).select(*PAGE, "line_idx", F.col("m.pos").alias("anchor_pos"))


def apply_corrections(blocks: DataFrame, corrections: DataFrame, least: float = 0.5) -> DataFrame:
    """Keyed rewrites; one shorter than half the text is refused and counted, unknown ids do nothing."""
    j = blocks.join(corrections.select("doc_id", "block_id", F.col("html").alias("new_html")), ["doc_id", "block_id"], "left")
    short = F.length("new_html") < least * F.length("text")
    return j.select(
        "doc_id", "block_id", F.when(F.col("new_html").isNull() | short, F.col("text")).otherwise(F.col("new_html")).alias("text"),
        F.coalesce(short, F.lit(False)).cast("int").alias("errors"),
    )


def apply_reorder(blocks: DataFrame, order: DataFrame) -> DataFrame:
    """A page's new order holds only if it names exactly the page's blocks."""
    have = blocks.groupBy(*PAGE).agg(F.sort_array(F.collect_set("pos")).alias("have"))
    want = order.groupBy(*PAGE).agg(F.sort_array(F.collect_list("pos")).alias("want"))
    good = have.join(want, PAGE).where("have = want").select(*PAGE, F.lit(True).alias("good"))
    j = blocks.join(good, PAGE, "left").join(order.select(*PAGE, "pos", F.col("new_pos").alias("np")), [*PAGE, "pos"], "left")
    return j.select(*PAGE, "pos", F.when(F.col("good"), F.col("np")).otherwise(F.col("pos")).alias("new_pos"))
