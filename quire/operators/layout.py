"""Layout labels, blocks that need reading again, and pages as lines for readers of OCR output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions import geometry as G
from quire.operators.blocks import PAGE

#: Fixed layout labels that are block types of the same name.
LABELS = (
    "Text", "SectionHeader", "PageHeader", "PageFooter", "Caption", "Footnote", "Code", "Bibliography", "Picture", "Figure", "Diagram", "Table", "Form", "Equation", "ListGroup",
    "TableOfContents", "ChemicalBlock",
)


def assign_labels(boxes: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Blocks from layout boxes (doc_id, page_id, position, label, box, image and page sizes): unknown and blank labels go,
    boxes are rescaled to the page and kept inside it; ``pos`` counts from 0 in order of position.

    ``more``: further block types that a label may name.
    """
    known = boxes.where(F.col("label").isin(*LABELS, *more))
    at = lambda c, image, page: F.greatest(F.lit(0.0), F.least(F.col(c) * (F.col(page) / F.col(image)), F.col(page))).alias(c)
    sized = [at("x0", "image_width", "page_width"), at("y0", "image_height", "page_height"), at("x1", "image_width", "page_width"), at("y1", "image_height", "page_height")]
    order = W.partitionBy(*PAGE).orderBy("position")
    return known.select(*PAGE, (F.row_number().over(order) - 1).alias("pos"), F.col("label").alias("block_type"), *sized)


def forced_layout(pages: DataFrame, block_type: str) -> DataFrame:
    """One block of the type over each page."""
    return pages.select(*PAGE, F.lit(0).alias("pos"), F.lit(block_type).alias("block_type"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.col("page_width").alias("x1"), F.col("page_height").alias("y1"))


def flag_bad_blocks(blocks: DataFrame, page_area: float, mode: str = "balanced", skipped: tuple[str, ...] = (), least_area: float = 0.01, contained: float = 0.75, least_chars: int = 50) -> DataFrame:
    """(page, pos, reread, promoted): blocks to read again, and pages to read again whole.

    An empty block is bad if it takes 1 % of the page, has ink, and isn't 75 % inside a block with text; one of 50
    characters if it was judged garbled. A page with a bad block (fast: over half of them) is promoted. ``blocks`` has
    text, has_ink and garbled.
    """
    b = blocks.withColumn("text", F.btrim(F.coalesce("text", F.lit(""))))
    mine = b.where(~F.col("block_type").isin(*skipped)) if skipped else b
    empty = mine.where((F.col("text") == "") & F.col("has_ink") & (G.area(G.box()) >= least_area * page_area))
    inside = (
        (F.col("e.doc_id") == F.col("t.doc_id")) & (F.col("e.page_id") == F.col("t.page_id")) & (F.col("e.pos") != F.col("t.pos"))
        & (G.intersection_pct(G.box(alias="e"), G.box(alias="t")) >= contained)
    )
    bare = empty.alias("e").join(b.where("text <> ''").alias("t"), inside, "left_anti").select(*PAGE, "pos")
    garbled = mine.where((F.char_length("text") >= least_chars) & F.col("garbled")).select(*PAGE, "pos")
    bad = bare.unionByName(garbled).withColumn("bad", F.lit(True))
    flagged = mine.select(*PAGE, "pos").join(bad, [*PAGE, "pos"], "left").withColumn("reread", F.coalesce("bad", F.lit(False)))
    share = F.avg(F.col("reread").cast("int")).over(W.partitionBy(*PAGE))
    return flagged.select(*PAGE, "pos", "reread", (share > {"balanced": 0.0, "fast": 0.5}[mode]).alias("promoted"))


def render_ocr_lines(lines: DataFrame, blocks: DataFrame, with_chars: Column | None = None) -> DataFrame:
    """A row for each page: ``children`` (id, block_type, html, bbox, children) are its blocks that carry html themselves, its
    lines but those of equations, then its equations.

    ``lines``: doc_id, page_id, id, pos, html, box, equation_id (null outside equations); ``blocks``: doc_id, page_id, id, pos,
    block_type, html, box, removed. ``with_chars``: the characters of a line (array of structs), where they are wanted.
    """
    chars = F.lit(None).cast("array<struct<id:string,text:string>>") if with_chars is None else with_chars
    box = F.array("x0", "y0", "x1", "y1").alias("bbox")
    live = blocks.where(~F.col("removed"))
    none = F.lit(None).cast(lines.select(chars.alias("c")).schema["c"].dataType).alias("children")
    html = live.where((F.col("block_type") != "Equation") & (F.length("html") > 0)).select(*PAGE, F.lit(0).alias("kind"), "pos", "id", "block_type", "html", box, none)
    equations = live.where(F.col("block_type") == "Equation")
    formulas = equations.select(*PAGE, F.lit(2).alias("kind"), "pos", "id", "block_type", "html", box, none)
    owned = equations.select("doc_id", F.col("id").alias("equation_id"))
    plain = lines.join(owned, ["doc_id", "equation_id"], "left_anti").select(*PAGE, F.lit(1).alias("kind"), "pos", "id", F.lit("Line").alias("block_type"), "html", box, chars.alias("children"))
    each = F.struct("kind", "pos", F.struct("id", "block_type", "html", "bbox", "children").alias("line"))
    return html.unionByName(plain).unionByName(formulas).groupBy(*PAGE).agg(F.transform(F.sort_array(F.collect_list(each)), lambda x: x["line"]).alias("children"))
