"""Rendering: a text per document from a tree of blocks, spliced bottom-up, one aggregation for each level of the tree.

Nodes of the tree are rows: doc_id, page_id, block_id, parent_id (null at the top of a page), depth (1 at the top of a page), pos (order
among siblings), block_type, text, and, where they apply (``NODE``, absent columns are null): html (markup that stands for the
block's own), heading_level, has_continuation, quote_level, indent_level, ref (a reference's name), description, image (base64
payload), formats, url, superscript (spans), removed, x0, y0, x1, y1. Ids are unique in a document.

Each level reads its own nodes and deals them by page; its aggregation groups by (document, page, parent), which that
partitioning serves, so that a node is shuffled once and nothing is written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions.markup import html_to_markdown
from quire.functions.text import HYPHENS, format_span, merge_consecutive_math, merge_consecutive_tags, replace_bullets
from quire.operators.blocks import PAGE, section_hierarchy

#: Columns of a node that may be absent.
NODE = {
    "html": "string", "heading_level": "int", "has_continuation": "boolean", "quote_level": "int", "indent_level": "int", "ref": "string", "description": "string", "image": "string",
    "formats": "array<string>", "url": "string", "superscript": "boolean", "removed": "boolean", "x0": "double", "y0": "double", "x1": "double", "y1": "double",
}
#: Those that spans alone have, and one that nodes left over don't need.
SPAN = {"formats", "url", "superscript", "removed"}
#: Members of a group.
KIDS = "array<struct<id:string,block_type:string,html:string,bbox:array<double>,images:map<string,string>>>"
IMAGES = ["Picture", "Figure", "Diagram"]
GROUPS = ["ListGroup", "TableGroup", "FigureGroup", "PictureGroup"]
#: Blocks whose markup is taken as it is, in a paragraph, or behind what refers to them.
MARKED = ["Equation", "ChemicalBlock"]


def escape_html(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for char, entity in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def _joined(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def block_html(content: Column, refs: Column, keep: list[str] | None = None) -> Column:
    """A block's markup by its type, from that of its children (``content``; ``refs`` of references alone).

    Page headers and footers render nothing unless ``keep`` names them.
    """
    kind, html, own = F.col("block_type"), F.col("html"), F.col("html").isNotNull() & (F.col("html") != "")
    flat = F.replace(content, F.lit("\n"), F.lit(" "))
    named = _joined(" block-type='", kind, "'")
    goes_on = F.when(F.coalesce("has_continuation", F.lit(False)), F.lit(" class='has-continuation'")).otherwise("")
    level = F.coalesce("heading_level", F.lit(2)).cast("string")
    quotes = F.coalesce("quote_level", F.lit(0))
    paragraph = _joined(F.repeat(F.lit("<blockquote>"), quotes), "<p", named, goes_on, ">", flat, "</p>", F.repeat(F.lit("</blockquote>"), quotes))
    item = F.when(own, F.regexp_replace(F.btrim(_joined(refs, html)), "</?li>", "")).otherwise(replace_bullets(flat))
    indent = F.coalesce("indent_level", F.lit(0))
    bare = F.regexp_extract(F.btrim("html"), r"(?s)^<p[^>]*>(.*)</p>$", 1)
    inner = F.when((bare != "") & ~F.contains(bare, F.lit("<p")) & (kind == "Equation"), bare).otherwise(F.btrim("html"))
    described = F.when(F.col("description").isNotNull(), _joined("<p role='img' data-original-image-id='", F.col("block_id"), "'>Image ", F.col("block_id"), " description: ", F.col("description"), "</p>")).otherwise("")
    skipped = kind.isin("PageHeader", "PageFooter") & ~kind.isin(*(keep or [""]))
    return (
        F.when(F.coalesce("removed", F.lit(False)) | skipped, F.lit(""))
        .when(kind.isin("Line", "Span"), content)
        .when(kind == "ListItem", F.when(indent > 0, _joined("<ul><li", named, " class='list-indent-", indent.cast("string"), "'>", item, "</li></ul>")).otherwise(_joined("<li", named, ">", item, "</li>")))
        .when(kind.isin(*MARKED) & own, _joined(refs, "<p", named, ">", inner, "</p>"))
        .when(kind.isin(*MARKED), _joined("<p", named, ">", content, "</p>"))
        .when(own & kind.isin("Code", "PageHeader", "PageFooter"), html)
        .when(own, _joined(refs, html))
        .when(kind == "Code", _joined("<pre>", F.col("shown"), "</pre>"))
        .when(kind == "SectionHeader", _joined("<h", level, ">", flat, "</h", level, ">"))
        .when(kind == "ListGroup", _joined("<p", named, goes_on, "><ul>", content, "</ul></p>"))
        .when(kind == "Reference", _joined("<span id='", F.col("ref"), "'>", content, "</span>"))
        .when(kind.isin(*IMAGES), _joined(refs, described))
        .when(kind.isin("TableGroup", "FigureGroup", "PictureGroup", "Table", "Form", "TableOfContents"), content)
        .when(kind.isin("Caption", "Footnote", "PageHeader", "PageFooter", "ComplexRegion"), _joined("<p>", content, "</p>"))
        .otherwise(paragraph)
    )


def _with_id(html: Column) -> Column:
    """The block's id on its outermost tag, or on a span around plain text; lines and spans carry none."""
    mark = _joined('data-block-id="', F.col("block_id"), '"')
    tagged = F.regexp_replace(html, F.lit(r"(?s)^([^<]*<[a-zA-Z][a-zA-Z0-9]*)"), _joined("$1 ", mark))
    out = F.when(html.rlike(r"<[a-zA-Z]"), tagged).when(html != "", _joined("<span ", mark, ">", html, "</span>")).otherwise("")
    return F.when(F.col("block_type").isin("Line", "Span"), html).otherwise(out)


def _line_ended(html: Column, cut: Column, last: Column) -> Column:
    """A line that ends in a hyphen before one that goes on in lower case loses it; the last one is trimmed, the others end in a break."""
    stripped = F.regexp_replace(html, rf"[{HYPHENS}](\s*(?:</[a-z]+>)*\s*)$", "$1")
    return F.when(last, F.btrim(html, F.lit(" "))).when(cut, F.rtrim(stripped)).otherwise(_joined(html, "\n"))


def _with_line_ends(list_: Column) -> Column:
    """Sorted siblings, their lines ended."""

    def ended(c: Column, k: Column) -> Column:
        after = F.get(list_, k + 1)
        last = F.coalesce(after["block_type"], F.lit("")) != "Line"
        return F.when(c["block_type"] == "Line", c.withField("html", _line_ended(c["html"], c["hyphen"] & after["lower"], last))).otherwise(c)

    return F.transform(list_, ended)


def assemble(nodes: DataFrame, levels: int = 4, images: bool = True, block_ids: bool = False, keep: list[str] | None = None) -> DataFrame:
    """The blocks at the top of pages with ``html`` spliced from all below, ``holes`` (that of a group with its members' places
    left open), ``kids`` (a group's members) and ``images`` (id to payload of the images in it).

    Spans have no children. Every level reads the nodes anew, so costly ones should be written first.
    """
    missing = [c for c in NODE if c not in nodes.columns]
    nodes = nodes.withColumns({c: F.lit(None).cast(NODE[c]) for c in missing}) if missing else nodes
    line, leaf = F.col("block_type") == "Line", F.col("block_type") == "Span"
    span = format_span(F.coalesce("text", F.lit("")), F.coalesce("formats", F.array().cast("array<string>")), F.col("url"), F.coalesce("superscript", F.lit(False)))
    shown = F.when(leaf, span).when(F.col("block_type").isin(*IMAGES, "Reference"), "").otherwise(escape_html(F.coalesce("text", F.lit(""))))
    hyphen = line & F.coalesce(F.btrim("text").rlike(rf"(?s)[\p{{Ll}}\d][{HYPHENS}]$"), F.lit(False))
    lower = line & F.coalesce(F.col("text").rlike(r"^\s*\p{Ll}"), F.lit(False))
    rows = nodes.where(~F.coalesce("removed", F.lit(False))).withColumns({"shown": shown, "hyphen": hyphen, "lower": lower})
    own = ["block_id", "parent_id", "pos", "block_type", "shown", "hyphen", "lower", *(c for c in NODE if c not in SPAN)]
    payloads = "array<struct<id:string,image:string>>"
    child = lambda html, inside: F.struct("pos", "block_id", "block_type", html.alias("html"), F.array("x0", "y0", "x1", "y1").alias("bbox"), "hyphen", "lower", inside.alias("inside"))
    below: DataFrame | None = None
    for depth in range(levels, 0, -1):
        head = (F.col("depth") == depth) & ~leaf if depth > 1 else F.col("depth") == 1
        here = rows.where(head)
        if below is None:
            level = here.select(*PAGE, *own).repartition(*PAGE).withColumns({"content": F.col("shown"), "refs": F.lit(""), "hole": F.lit(""), "kids": F.lit(None).cast(KIDS), "inside": F.lit(None).cast(payloads)})
        else:
            part = child(F.col("shown"), F.lit(None).cast(payloads))  # spans go to their parents at once
            met = rows.where(head | (leaf & (F.col("depth") == depth + 1))).select(
                *PAGE, F.when(head, F.col("block_id")).otherwise(F.col("parent_id")).alias("node"), F.when(head, F.struct(*own)).alias("own"), F.when(~head, part).alias("child"),
            ).repartition(*PAGE)
            made = below.select(*PAGE, F.col("parent_id").alias("node"), F.lit(None).cast(met.schema["own"].dataType).alias("own"), child(F.col("made"), F.col("inside")).alias("child"))
            met = met.unionByName(made).groupBy(*PAGE, "node").agg(F.first("own", ignorenulls=True).alias("own"), F.collect_list("child").alias("list")).where("own is not null")
            level = met.withColumn("list", F.sort_array("list")).withColumn("list", _with_line_ends(F.col("list"))).select(*PAGE, "own.*", "list")
            text = lambda list_: F.array_join(F.transform(list_, lambda c: c["html"]), "")
            marked = F.filter("list", lambda c: c["inside"].isNotNull())
            level = level.select(
                *PAGE, *own, F.when(F.size("list") > 0, text(F.col("list"))).otherwise(F.col("shown")).alias("content"), text(F.filter("list", lambda c: c["block_type"] == "Reference")).alias("refs"),
                F.when(F.col("block_type").isin(*GROUPS), F.array_join(F.transform("list", lambda c: _joined("<content-ref src='", c["block_id"], "'></content-ref>")), "")).alias("hole"),
                F.when(F.col("block_type").isin(*GROUPS), F.transform("list", lambda c: F.struct(c["block_id"].alias("id"), c["block_type"].alias("block_type"), c["html"].alias("html"), c["bbox"].alias("bbox"), _image_map(c["inside"]).alias("images")))).alias("kids"),
                F.when(F.exists("list", lambda c: c["inside"].isNotNull()), F.flatten(F.transform(marked, lambda c: c["inside"]))).alias("inside"),
            )
        if depth == 1:  # lines with no block around them follow one another in the page
            after = F.lead(F.struct("block_type", "lower")).over(W.partitionBy(*PAGE, "parent_id").orderBy("pos", "block_id"))
            last = F.coalesce(F.col("after.block_type"), F.lit("")) != "Line"
            level = level.withColumn("after", after).withColumn("content", F.when(line, _line_ended(F.col("content"), F.col("hyphen") & F.col("after.lower"), last)).otherwise(F.col("content"))).drop("after")
        level = level.withColumn("removed", F.lit(False)).withColumn("made", block_html(F.col("content"), F.col("refs"), keep))
        if depth == 1:
            level = level.withColumn("holes", F.when(F.col("block_type").isin(*GROUPS), block_html(F.col("hole"), F.col("refs"), keep)))
        image = F.col("block_type").isin(*IMAGES)
        if images:
            name = _joined(F.replace("block_id", F.lit("/"), F.lit("_")), ".jpeg")
            level = level.withColumn("inside", F.when(~image, F.col("inside")).when(F.col("image").isNotNull(), F.array(F.struct(F.col("block_id").alias("id"), F.col("image").alias("image")))))
            level = level.withColumn("made", F.when(image, _joined("<p>", F.col("made"), "<img src='", name, "'></p>")).otherwise(F.col("made")))
        if block_ids:
            level = level.withColumn("made", _with_id(F.col("made")))
        below = level
    return below.select(*PAGE, "block_id", "pos", "block_type", "heading_level", F.col("made").alias("html"), F.coalesce("holes", "made").alias("holes"), "kids", _image_map(F.col("inside")).alias("images"), *["x0", "y0", "x1", "y1"])


def _image_map(inside: Column) -> Column:
    return F.map_from_entries(F.coalesce(inside, F.array().cast("array<struct<id:string,image:string>>")))


def _ordered(order: list[str], value: str, sep: str) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, value))), lambda s: s[value]), sep)


def _documents(pages: DataFrame | None, tops: DataFrame, paginate: bool) -> DataFrame:
    """(doc_id, html): the pages' markup in order; ``pages`` names those that may have no block."""
    parts = tops.select(*PAGE, "pos", "block_id", "html")
    if pages is not None:
        parts = parts.unionByName(pages.select(*PAGE, F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("block_id"), F.lit("").alias("html")).repartition(*PAGE))
    made = parts.groupBy(*PAGE).agg(_ordered(["pos", "block_id"], "html", "").alias("html"))
    if paginate:
        made = made.withColumn("html", _joined("<div class='page' data-page-id='", F.col("page_id").cast("string"), "'>", F.col("html"), "</div>"))
    docs = made.groupBy("doc_id").agg(_ordered(["page_id"], "html", "").alias("html"))
    merged = reduce(lambda t, tag: merge_consecutive_tags(t, tag), ["b", "i"], F.col("html"))
    return docs.select("doc_id", merge_consecutive_math(merged).alias("html"))


def render_html(nodes: DataFrame, paginate: bool = False, pages: DataFrame | None = None, **options) -> DataFrame:
    """(doc_id, html): whole documents; adjacent bold, italic and inline maths are merged. ``options`` are those of ``assemble``."""
    docs = _documents(pages, assemble(nodes, **options), paginate)
    return docs.select("doc_id", _joined('<!DOCTYPE html>\n<html>\n<head>\n<meta charset="utf-8" />\n</head>\n<body>\n', F.col("html"), "\n</body>\n</html>\n").alias("html"))


def render_markdown(nodes: DataFrame, paginate: bool = False, tables: str = "pipe", pages: DataFrame | None = None, **options) -> DataFrame:
    """(doc_id, markdown) of whole documents; a rule with its number before each page if asked for."""
    docs = _documents(pages, assemble(nodes, **options), paginate)
    return docs.select("doc_id", html_to_markdown(F.col("html"), paginate, tables).alias("markdown"))


def corners() -> Column:
    """The four corners of a box, clockwise from the top left."""
    return F.array(F.array("x0", "y0"), F.array("x1", "y0"), F.array("x1", "y1"), F.array("x0", "y1"))


def render_chunks(nodes: DataFrame, **options) -> DataFrame:
    """Blocks at the top of pages: whole html, page, corners, box, the headings above (level to id), and their images."""
    tops = section_hierarchy(assemble(nodes, **options))
    return tops.select("doc_id", F.col("block_id").alias("id"), "block_type", "page_id", "pos", "html", corners().alias("polygon"), F.array("x0", "y0", "x1", "y1").alias("bbox"), "hierarchy", "images")


def page_info(pages: DataFrame) -> DataFrame:
    """(doc_id, page_info): each page's box and corners by its number."""
    info = F.struct("page_id", F.struct(F.array("x0", "y0", "x1", "y1").alias("bbox"), corners().alias("polygon")).alias("info"))
    return pages.groupBy("doc_id").agg(F.map_from_entries(F.sort_array(F.collect_list(info))).alias("page_info"))


def render_json(nodes: DataFrame, **options) -> DataFrame:
    """(doc_id, json): pages with their blocks, a group's members below it (its own html keeps their places open)."""
    tops = section_hierarchy(assemble(nodes, **options))
    keyed = F.map_from_entries(F.transform(F.map_entries("hierarchy"), lambda e: F.struct(e["key"].cast("string").alias("key"), e["value"].alias("value"))))
    child = F.struct(
        F.col("block_id").alias("id"), "block_type", F.col("holes").alias("html"), corners().alias("polygon"), F.array("x0", "y0", "x1", "y1").alias("bbox"),
        F.col("kids").alias("children"), keyed.alias("section_hierarchy"), F.when(~F.col("block_type").isin(*GROUPS), F.col("images")).alias("images"),
    )
    pages = tops.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("pos", "block_id", child.alias("b"))), lambda a, b: F.when((a["pos"] < b["pos"]) | ((a["pos"] == b["pos"]) & (a["block_id"] < b["block_id"])), -1).otherwise(1)).alias("list"))
    page = F.struct(F.concat(F.lit("/page/"), F.col("page_id").cast("string"), F.lit("/Page/"), F.col("page_id").cast("string")).alias("id"), F.lit("Page").alias("block_type"), F.transform("list", lambda c: c["b"]).alias("children"))
    docs = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_id", page.alias("p"))), lambda a, b: a["page_id"].cast("int") - b["page_id"].cast("int")).alias("pages"))
    return docs.select("doc_id", F.to_json(F.struct(F.transform("pages", lambda p: p["p"]).alias("children"), F.lit("Document").alias("block_type"))).alias("json"))
