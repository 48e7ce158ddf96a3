"""Filters, relabels, orders and windows over block tables (doc_id, page_id, pos, block_type, box, text).

Documents are small and many: every window is partitioned by document or page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions.similarity import fuzz_ratio
from quire.functions.text import header_clean

PAGE = ["doc_id", "page_id"]
ORD = ["page_id", "pos"]
TABLE_TYPES = ["Table", "Form", "TableOfContents"]
CITABLE = ["Text", "SectionHeader", "ListItem", "Table", "Caption", "Footnote"]


def by_document() -> W:
    return W.partitionBy("doc_id").orderBy(*ORD)


def by_page() -> W:
    return W.partitionBy(*PAGE).orderBy("pos")


def blocks_of_type(blocks: DataFrame, types: list[str]) -> DataFrame:
    return blocks.where(~F.col("removed") & F.col("block_type").isin(types))


def tables_only(blocks: DataFrame) -> DataFrame:
    return blocks.where(F.col("block_type").isin(TABLE_TYPES))


def parse_relabel_rules(rules: str) -> list[tuple[str, str, float]]:
    """``Old:New:threshold`` parts of a comma list; malformed parts are skipped."""
    out = []
    for part in rules.split(","):
        bits = part.strip().split(":")
        try:
            out.append((bits[0], bits[1], float(bits[2])))
        except (IndexError, ValueError):
            continue
    return out


def relabel_blocks(blocks: DataFrame, rules: str, confidence: Column) -> DataFrame:
    """Relabel a block whose confidence in its own type is at most the rule's threshold; first rule wins."""
    new = F.lit(None).cast("string")
    for old, to, most in reversed(parse_relabel_rules(rules)):
        new = F.when((F.col("block_type") == old) & (F.coalesce(confidence, F.lit(0)) <= most), F.lit(to)).otherwise(new)
    out = blocks.withColumn("new_type", new)
    return out.withColumns({
        "block_type": F.coalesce("new_type", "block_type"), "source": F.when(F.col("new_type").isNotNull(), "heuristics").otherwise(F.lit("layout")),
    }).drop("new_type")


def visible_blocks(blocks: DataFrame, keep_header: bool = False, keep_footer: bool = False) -> DataFrame:
    hidden = [t for t, keep in (("PageHeader", keep_header), ("PageFooter", keep_footer)) if not keep]
    return blocks.where(~F.col("removed") & ~F.col("block_type").isin(hidden))


def usable_lines(lines: DataFrame, min_height: float = 2.0) -> DataFrame:
    return lines.where((F.length(F.btrim("text")) > 0) & (F.col("y1") - F.col("y0") >= min_height))


def citable_blocks(blocks: DataFrame) -> DataFrame:
    return blocks.where(F.col("block_type").isin(CITABLE) & (F.length(F.btrim("text")) > 0))


def headers_first_footnotes_last(blocks: DataFrame) -> DataFrame:
    """Page headers move to the page's start, footnotes to its end; the rest keep their order (``new_pos`` from 0)."""
    rank = F.when(F.col("block_type") == "PageHeader", 0).when(F.col("block_type") == "Footnote", 2).otherwise(1)
    return blocks.withColumn("new_pos", F.row_number().over(W.partitionBy(*PAGE).orderBy(rank, "pos")) - 1)


def footnote_marks(blocks: DataFrame) -> DataFrame:
    """Footnotes whose text starts with digits or other non-word characters."""
    return blocks.where(F.col("block_type") == "Footnote").withColumn("superscript", F.col("text").rlike(r"^[0-9\W]+"))


def line_number_blocks(blocks: DataFrame, least: int = 4, share: float = 0.6) -> DataFrame:
    """Blocks of mostly numbers that are taller than wide."""
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    digits = F.filter(words, lambda w: w.rlike("^[0-9]+$"))
    tall = F.col("y1") - F.col("y0") > F.col("x1") - F.col("x0")
    return blocks.withColumn("ignored", (F.size(words) >= least) & (F.size(digits) > share * F.size(words)) & tall)


def model_queue(blocks: DataFrame, page_height: float, min_equation: float = 0.06) -> DataFrame:
    """Blocks that an external model would be asked about, with the task's name and the request."""
    empty = F.length(F.btrim("text")) == 0
    task = (
        F.when(F.col("block_type").isin("Text", "Handwriting") & empty, "handwriting")
        .when((F.col("block_type") == "Equation") & ((F.col("y1") - F.col("y0")) / page_height >= min_equation), "equation")
        .when((F.col("block_type") == "Table") & ~empty, "form").when(F.col("block_type").isin("Picture", "Figure"), "image")
    )
    request = F.to_json(F.struct(F.col("block_id").alias("id"), F.col("block_type").alias("type")))
    return blocks.select("*", task.alias("task"), request.alias("request")).where("task is not null")


# --- windows over blocks


def neighbours(blocks: DataFrame, ignored: list[str]) -> DataFrame:
    """next_id and prev_id of each block: the nearest that aren't of an ignored type, across pages."""
    seen = F.when(~F.col("block_type").isin(ignored), F.col("block_id"))
    after = by_document().rowsBetween(1, W.unboundedFollowing)
    before = by_document().rowsBetween(W.unboundedPreceding, -1)
    return blocks.withColumns({"next_id": F.first(seen, ignorenulls=True).over(after), "prev_id": F.last(seen, ignorenulls=True).over(before)})


def reading_order(blocks: DataFrame, first_char: Column) -> DataFrame:
    """Order by the first character's place; a block without text follows the one before it."""
    placed = blocks.withColumn("at", F.coalesce(F.last(first_char, ignorenulls=True).over(by_page().rowsBetween(W.unboundedPreceding, 0)), F.lit(-1)))
    return placed.withColumn("new_pos", F.row_number().over(W.partitionBy(*PAGE).orderBy("at", "pos")) - 1).drop("at")


def ltr_line_order(lines: DataFrame, tolerance: float = 1.25) -> DataFrame:
    """Lines of a page in rows of equal rounded height, left to right."""
    row = F.bround(F.col("y0") / tolerance)
    return lines.withColumn("new_pos", F.row_number().over(W.partitionBy(*PAGE).orderBy(row, "x0", "line_idx")) - 1)


def section_hierarchy(blocks: DataFrame, levels: int = 6) -> DataFrame:
    """``hierarchy``: map of level to the heading above, carried through the document.

    A heading ends those of its own level and deeper, and sees itself: level L holds if its last
    heading came after the last heading of every lesser level.
    """
    upto = by_document().rowsBetween(W.unboundedPreceding, 0)
    at = F.struct("page_id", "pos", "block_id")
    out = blocks
    for level in range(1, levels + 1):
        out = out.withColumn(f"_h{level}", F.max(F.when(F.col("heading_level") == level, at)).over(upto))
    entries = []
    for level in range(1, levels + 1):
        mine = F.col(f"_h{level}")
        higher = F.greatest(*[F.col(f"_h{i}") for i in range(1, level)]) if level > 2 else F.col("_h1") if level == 2 else F.lit(None)
        keep = mine.isNotNull() & (F.lit(True) if level == 1 else (higher.isNull() | (mine > higher)))
        entries.append(F.when(keep, F.struct(F.lit(level).alias("key"), mine["block_id"].alias("value"))))
    return out.withColumn("hierarchy", F.map_from_entries(F.array_compact(F.array(*entries)))).drop(*[f"_h{i}" for i in range(1, levels + 1)])


def document_toc(blocks: DataFrame) -> DataFrame:
    """Headings in order, with ``seq`` from 0."""
    heads = blocks.where((F.col("block_type") == "SectionHeader") & ~F.col("removed"))
    return heads.select("doc_id", (F.row_number().over(by_document()) - 1).alias("seq"), F.btrim("text").alias("title"), "heading_level", "page_id", "x0", "y0", "x1", "y1")


def marginalia(blocks: DataFrame, page_height: float, top: float = 0.08, bottom: float = 0.13, low: float = 0.035, most_chars: int = 150) -> DataFrame:
    """``ignored``: small short text wholly at a page's edge and outside the band of the other text."""
    text = F.col("block_type").isin("Text", "SectionHeader", "ListItem")
    small = text & ((F.col("y1") - F.col("y0")) <= low * page_height) & (F.length("text") <= most_chars) & ((F.col("y1") <= top * page_height) | (F.col("y0") >= (1 - bottom) * page_height))
    page = W.partitionBy(*PAGE)
    body_top, body_bottom = F.min(F.when(text & ~small, F.col("y0"))).over(page), F.max(F.when(text & ~small, F.col("y1"))).over(page)
    n = F.count(F.when(text, 1)).over(page)
    outside = (F.col("y1") <= body_top) | (F.col("y0") >= body_bottom)
    return blocks.withColumn("ignored", F.coalesce(small & (n >= 2) & outside, F.lit(False)))


def text_continuation(blocks: DataFrame, lines: DataFrame, page_width: float, page_height: float, column_gap: float = 0.02) -> DataFrame:
    """``has_continuation`` of each text block: of two lines or more, it goes on in the next visible block over a column or page break.

    The next block, past page headers and footers, must be text with lines. At a column break it starts no lower than this one and over ``column_gap`` of
    this one's width to its right; at a page break it starts in the page's first quadrant. The last line reaches the widest
    one's right edge (in whole points) or ends in a hyphen, and the next block's first line isn't indented. ``lines``: doc_id,
    page_id, block (pos of its block), line_idx, text, x0, x1; lines of at most one point in width don't count as ends.
    """
    text = ["Text", "TextInlineMath"]
    wide = F.col("x1") - F.col("x0") > 1
    shape = lines.groupBy(*PAGE, F.col("block").alias("pos")).agg(
        F.count("*").alias("n_lines"), F.floor(F.max(F.when(wide, F.col("x1")))).alias("reach"), F.max_by(F.when(wide, F.col("x1")), F.when(wide, F.col("line_idx"))).alias("last_x1"),
        F.max_by(F.when(wide, F.col("text")), F.when(wide, F.col("line_idx"))).alias("last_text"), F.min_by("x0", "line_idx").alias("first_x0"), F.ceil(F.min("x0")).alias("left"),
    )
    seen = blocks.where(~F.col("block_type").isin("PageHeader", "PageFooter")).join(shape, [*PAGE, "pos"], "left")
    w = by_document()
    nxt = lambda c: F.lead(c).over(w)
    same_page = nxt("page_id") == F.col("page_id")
    column = same_page & (F.floor(nxt("y0")) <= F.ceil("y0")) & (nxt("x0") > F.col("x1") + column_gap * (F.col("x1") - F.col("x0")))
    page = ~same_page & (nxt("x0") < float(page_width // 2)) & (nxt("y0") < float(page_height // 2))
    ends = (F.col("last_x1") >= F.col("reach")) | F.btrim("last_text").rlike(r"(?s)[\p{Ll}|\p{Nd}][-—¬]\s?$")
    flush = nxt("first_x0") <= nxt("left")
    follows = nxt("block_type").isin(text) & (nxt("n_lines") > 0) & ~nxt("removed")
    found = F.coalesce((F.col("n_lines") >= 2) & follows & (column | page) & ends & flush, F.lit(False))
    return seen.withColumn("has_continuation", found).where(F.col("block_type").isin(text))


def group_lists(blocks: DataFrame, page_height: float, most_gap: float = 0.1) -> DataFrame:
    """Runs of neighbouring list items, less than a tenth of the page apart; a run of one is text."""
    w = by_page()
    items = blocks.withColumns({"was": F.lag("block_type").over(w), "gap": F.col("y0") - F.lag("y1").over(w)})
    fresh = ~((F.col("block_type") == "ListItem") & F.coalesce(F.col("was") == "ListItem", F.lit(False)) & (F.coalesce("gap", F.lit(0.0)) < most_gap * page_height))
    runs = items.withColumn("run", F.sum(fresh.cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0))).where("block_type = 'ListItem'")
    return runs.groupBy(*PAGE, "run").agg(F.min("pos").alias("first_pos"), F.count("*").alias("n_items"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")).select(
        *PAGE, "first_pos", "n_items", F.when(F.col("n_items") > 1, "ListGroup").otherwise("Text").alias("block_type"), "x0", "y0", "x1", "y1"
    )


def split_list_groups(lines: DataFrame, starts: Column) -> DataFrame:
    """Lines of a group as items that begin where ``starts`` holds; a group without a start is one text."""
    w = W.partitionBy(*PAGE).orderBy("line_idx")
    out = lines.withColumn("start", starts.cast("int"))
    out = out.withColumns({"item": F.sum("start").over(w.rowsBetween(W.unboundedPreceding, 0)), "any": F.max("start").over(W.partitionBy(*PAGE))})
    return out.groupBy(*PAGE, "item").agg(
        F.min("line_idx").alias("first_line"), F.count("*").alias("n_lines"), F.when(F.max("any") == 1, "ListItem").otherwise("Text").alias("block_type"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_idx", "text"))), lambda s: s["text"]), "\n").alias("text"),
    )


def inline_math_blocks(blocks: DataFrame, flag: Column, escalate: float = 0.3) -> DataFrame:
    """Flagged text blocks; on a page with over 30 % flagged, all of them."""
    text = blocks.where(F.col("block_type").isin("Text", "ListItem")).withColumn("flag", flag)
    share = F.avg(F.col("flag").cast("int")).over(W.partitionBy(*PAGE))
    return text.withColumn("share", share).where("flag or share > %r" % escalate).drop("share", "flag")


def list_continuation(groups: DataFrame) -> DataFrame:
    """List groups followed by a list group in a new column or on a new page."""
    w = W.partitionBy("doc_id").orderBy("page_id", "first_pos")
    nxt_type, nxt_page, nxt_y = F.lead("block_type").over(w), F.lead("page_id").over(w), F.lead("y0").over(w)
    return groups.withColumn("has_continuation", F.coalesce((F.col("block_type") == "ListGroup") & (nxt_type == "ListGroup") & ((nxt_page > F.col("page_id")) | (nxt_y < F.col("y0"))), F.lit(False)))


def block_position_sort(blocks: DataFrame) -> DataFrame:
    """Top first, then rightmost."""
    return blocks.withColumn("new_pos", F.row_number().over(W.partitionBy(*PAGE).orderBy("y0", F.desc("x1"), "pos")) - 1)


def line_number_spans(lines: DataFrame, share: float = 0.6, least: int = 4, more: int = 10) -> DataFrame:
    """``dropped``: which spans of a line are numbers of lines: ``first``, ``last``, or none (null).

    On a page where over 60 % of the lines start with a number (their leftmost span, ``first``), those go. In a block
    of four lines or more where over 60 % start (or end) with a span of digits before (behind) over ten other characters,
    those go. ``lines``: doc_id, page_id, block, line_idx, first, last (texts of the outermost spans), n_chars (of the line).
    """
    numbered = F.col("first").rlike(r"(?U)^\s*\d+\s*$")
    of_page = F.avg(numbered.cast("int")).over(W.partitionBy(*PAGE))
    block = W.partitionBy(*PAGE, "block")
    digits = lambda c: F.coalesce(F.col(c).rlike(r"(?U)^\s*\d+\s*$") & (F.col("n_chars") - F.length(F.btrim(c)) > more), F.lit(False))
    often = lambda c: (F.count("*").over(block) >= least) & (F.avg(digits(c).cast("int")).over(block) > share)
    dropped = F.when(numbered & (of_page > share), "first").when(digits("first") & often("first"), "first").when(digits("last") & often("last"), "last")
    return lines.withColumn("dropped", dropped)


def _edge_texts(blocks: DataFrame) -> DataFrame:
    """First and last text block of each page (one block may be both), with the cleaned text and the side."""
    page = W.partitionBy(*PAGE)
    text = blocks.where(F.col("block_type").isin("Text", "SectionHeader", "TextInlineMath"))
    ends = text.withColumns({"lo": F.min("pos").over(page), "hi": F.max("pos").over(page)})
    sides = F.array_compact(F.array(F.when(F.col("pos") == F.col("lo"), F.lit(True)), F.when(F.col("pos") == F.col("hi"), F.lit(False))))
    return ends.select(*PAGE, "pos", F.explode(sides).alias("at_top"), header_clean(F.col("text")).alias("clean"))


def repeated_headers(blocks: DataFrame) -> DataFrame:
    """Common texts of a document's first blocks of pages, and of its last ones (doc_id, at_top, clean, n, streak).

    Common: over three times, and a fifth of the pages or three pages in a row; numbers at both ends don't count.
    """
    ends = _edge_texts(blocks)
    side = W.partitionBy("doc_id", "at_top")
    ends = ends.withColumn("island", F.row_number().over(side.orderBy("page_id")) - F.row_number().over(W.partitionBy("doc_id", "at_top", "clean").orderBy("page_id")))
    ends = ends.withColumns({
        "n": F.count("*").over(W.partitionBy("doc_id", "at_top", "clean")), "streak": F.count("*").over(W.partitionBy("doc_id", "at_top", "clean", "island")), "total": F.count("*").over(side),
    })
    common = ends.groupBy("doc_id", "at_top", "clean").agg(F.max("n").alias("n"), F.max("streak").alias("streak"), F.max("total").alias("total"))
    return common.where((F.col("n") > 3) & ((F.col("n") >= 0.2 * F.col("total")) | (F.col("streak") >= 3))).select("doc_id", "at_top", "clean", "n", "streak")


#: Classes of characters that are counted to bound how much two texts may share.
CLASSES = 16


def ignored_headers(blocks: DataFrame, over: float = 90.0) -> DataFrame:
    """Blocks (doc_id, page_id, pos, at_top) at a page's edge that are like a common text of their document's side, over ``over`` of 100.

    Distinct edge texts meet the few common ones of their document and side; lengths, and counts of characters by class, bound what two
    texts can share, and only pairs that may pass are compared.
    """
    ends, common = _edge_texts(blocks), repeated_headers(blocks).select("doc_id", "at_top", F.col("clean").alias("common"))
    j = ends.select("doc_id", "at_top", "clean").distinct().join(common, ["doc_id", "at_top"])
    a, b = F.char_length("clean"), F.char_length("common")
    j = j.where((F.col("clean") == F.col("common")) | (200 * F.least(a, b) > over * (a + b)))
    counts = lambda t: F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), lambda k: F.size(F.filter(F.split(t, ""), lambda c: (c != "") & (F.ascii(c) % CLASSES == k))))
    shared = F.aggregate(F.arrays_zip(counts("clean").alias("x"), counts("common").alias("y")), F.lit(0), lambda n, z: n + F.least(z["x"], z["y"]))
    j = j.where((F.col("clean") == F.col("common")) | (200 * shared > over * (a + b)))
    like = j.where(fuzz_ratio("clean", "common") > over).select("doc_id", "at_top", "clean").distinct()
    return ends.join(like, ["doc_id", "at_top", "clean"], "left_semi").select(*PAGE, "pos", "at_top").distinct()
