"""Sources and sinks: folders of files, page ranges, resuming, block trees, packages, rendered documents."""

from __future__ import annotations

import base64
import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.books import cells_to_html
from quire.sources.store import commit_file


def read_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Files of a folder (path, length, content), the first ``max_files`` by path; only those are read."""
    files = spark.read.format("binaryFile").load(path)
    if max_files is None:
        return files
    first = [row["path"] for row in files.select("path").orderBy("path").limit(max_files).collect()]
    return spark.read.format("binaryFile").load(first) if first else files.limit(0)


def _archive_kind(content: bytes | None) -> str | None:
    """Kind of an archive by the names in its directory, which lies at its end; None for other archives and broken ones."""
    if content is None:
        return None
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            names = archive.namelist()
            if "mimetype" in names and archive.read("mimetype").startswith(b"application/epub"):
                return "epub"
    except (zipfile.BadZipFile, NotImplementedError, ValueError):
        return None
    return next((kind for folder, kind in (("word/", "docx"), ("xl/", "xlsx"), ("ppt/", "pptx")) if any(n.startswith(folder) for n in names)), None)


def route_doctype(content: Column, path: Column) -> Column:
    """Kind of a file by its first bytes, an archive's directory, an html tag anywhere in a text, its extension; else pdf."""
    head = F.upper(F.hex(F.substring(content, 1, 12)))
    starts = lambda *marks: head.rlike("^(" + "|".join(marks) + ")")

    @F.pandas_udf("string")
    def archive(contents: pd.Series) -> pd.Series:
        return pd.Series([_archive_kind(c) for c in contents], dtype=object)

    text = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string"))
    extension = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    by_name = F.when(extension.isin("png", "jpg", "jpeg", "gif", "tiff", "webp", "bmp"), "image").when(extension.isin("docx", "xlsx", "pptx", "epub", "html", "pdf"), extension)
    return F.coalesce(
        F.when(starts("25504446"), "pdf"), F.when(starts("89504E47", "FFD8FF", "474946", "49492A00", "4D4D002A", "424D", "52494646.{8}57454250"), "image"),
        archive(F.when(starts("504B0304", "504B0506"), content)), F.when(text.rlike(r"<[a-zA-Z][^<>]*>"), "html"), by_name, F.lit("pdf"),
    )


def skip_existing(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Inputs whose base name has no output yet; both have ``path``."""
    name = lambda c: F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.[^.]+$", "")
    done = outputs.where(F.col("path").rlike(r"\.(md|html|json)$")).select(name(F.col("path")).alias("base")).distinct()
    return inputs.withColumn("base", name(F.col("path"))).join(done, "base", "left_anti")


def page_range(spec: str) -> list[int]:
    """Pages of a list such as ``0,5-10,20``, sorted, each once."""
    pages: set[int] = set()
    for part in spec.split(","):
        first, dash, last = part.strip().partition("-")
        pages.update(range(int(first), int(last) + 1) if dash else [int(first)])
    return sorted(pages)


def select_pages(pages: DataFrame, spec: str, key: str = "page_id") -> DataFrame:
    """Pages in a range list; ranges stay ranges, so a wide one costs nothing."""
    keep = F.lit(False)
    for part in spec.split(","):
        first, dash, last = part.strip().partition("-")
        keep = keep | (F.col(key).between(int(first), int(last)) if dash else F.col(key) == int(first))
    return pages.where(keep)


def content_key(content: Column, flags: str, pages: str | None) -> Column:
    """First 16 hex digits of the hash of the content's hash, the flags and the pages."""
    return F.substring(F.sha2(F.concat_ws("|", F.sha2(content, 256), F.lit(flags), F.lit(pages or "all")), 256), 1, 16)


def version_gate(packages: DataFrame, current: str) -> DataFrame:
    """``accepted``: same major and a minor up to the current one; the patch doesn't matter. ``reason`` otherwise.

    A version is three numbers apart by dots. Accepted packages carry the current version from here on; ``stored_version`` keeps the old one.
    """
    major, minor = (int(x) for x in current.split(".")[:2])
    stored = F.coalesce("version", F.lit(""))
    parts = F.split(stored, r"\.")
    a, b = F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")
    malformed = (F.size(parts) != 3) | F.exists(parts, lambda x: x.try_cast("int").isNull())
    reason = F.when(malformed, "malformed").when(a != major, "major").when(b > minor, "newer")
    return packages.withColumns({"stored_version": F.col("version"), "reason": reason, "accepted": reason.isNull(), "version": F.when(reason.isNull(), F.lit(current)).otherwise(F.col("version"))})


def block_tree_schema(depth: int) -> T.StructType:
    """Schema of a nested block of at most ``depth`` levels below it; deeper ones are kept as JSON text."""
    below = block_tree_schema(depth - 1) if depth else T.StringType()
    return T.StructType([T.StructField("id", T.StringType()), T.StructField("block_type", T.StringType()), T.StructField("html", T.StringType()), T.StructField("children", T.ArrayType(below))])


def leaf_blocks(trees: DataFrame, json_col: str, keys: list[str], depth: int = 8) -> DataFrame:
    """Leaf blocks of JSON trees (keys, path of positions, id, block_type, html). A tree of more than ``depth`` levels is an error."""
    level = trees.select(*keys, F.from_json(json_col, block_tree_schema(depth)).alias("b"), F.array().cast("array<int>").alias("path"))
    out = None
    for d in range(depth + 1):
        below = F.coalesce(F.size("b.children"), F.lit(0)) > 0
        if d == depth:
            level = level.withColumn("b", F.when(below, F.raise_error(F.lit(f"a block lies more than {depth} levels deep")).cast(level.schema["b"].dataType)).otherwise(F.col("b")))
        part = level.where(~below).select(*keys, "path", "b.id", "b.block_type", "b.html") if d < depth else level.select(*keys, "path", "b.id", "b.block_type", "b.html")
        out = part if out is None else out.unionByName(part)
        if d < depth:
            level = level.select(*keys, "path", F.posexplode("b.children").alias("i", "b")).select(*keys, "b", F.concat("path", F.array("i")).alias("path"))
    return out


def sheet_cells(cells: DataFrame, merged: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of sheets with merged ranges as table cells: covered cells go, the top left one carries the spans."""
    on = [F.col(f"c.{k}") == F.col(f"m.{k}") for k in keys]
    inside = (F.col("c.row_id").between(F.col("m.r0"), F.col("m.r1"))) & (F.col("c.col_id").between(F.col("m.c0"), F.col("m.c1")))
    j = cells.alias("c").join(merged.alias("m"), on + [inside], "left")
    keep = F.col("m.r0").isNull() | ((F.col("c.row_id") == F.col("m.r0")) & (F.col("c.col_id") == F.col("m.c0")))
    return j.where(keep).select(
        *[F.col(f"c.{k}") for k in keys], "c.row_id", "c.col_id", "c.text", F.coalesce(F.col("m.r1") - F.col("m.r0") + 1, F.lit(1)).alias("rowspan"), F.coalesce(F.col("m.c1") - F.col("m.c0") + 1, F.lit(1)).alias("colspan"),
    )


def sheet_to_html(cells: DataFrame, merged: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, html): one ``<table>`` a sheet; an empty cell is an empty text, a row whose cells are all covered stays as an empty row."""
    placed = sheet_cells(cells, merged, keys).withColumn("is_header", F.lit(False))
    rows = cells.select(*keys, "row_id").distinct()
    return cells_to_html(placed, keys, rows=rows)


_FILES = "doc_id string, name string, bytes long"


def write_outputs(rendered: DataFrame, folder: str, fmt: str) -> DataFrame:
    """Write each document's files and return their names and sizes (doc_id as text, name, bytes).

    ``rendered``: doc_id, name (base name), text, and, if there, metadata (a struct or JSON text) and images (map of name to base64). A
    document gets ``name/name.<fmt>``, ``name/name_meta.json`` and its images. Files are written under temporary names and renamed; a
    repeated task writes them again. null text: an empty file. Two documents of one name are an error.
    """
    if fmt not in ("md", "html", "json"):
        raise ValueError("outputs are md, html or json")
    has = lambda c: c in rendered.columns
    meta = F.lit("{}") if not has("metadata") else F.coalesce(F.col("metadata") if rendered.schema["metadata"].dataType == T.StringType() else F.to_json("metadata"), F.lit("{}"))
    images = F.col("images") if has("images") else F.lit(None)
    if rendered.groupBy("name").count().where("count > 1").limit(1).count():
        raise ValueError("two documents have one name")
    rows = rendered.select(F.col("doc_id").cast("string").alias("doc_id"), "name", F.coalesce("text", F.lit("")).alias("text"), meta.alias("meta"), F.to_json(images.cast("map<string,string>")).alias("images"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for doc, name, text, meta_, images_ in batch[["doc_id", "name", "text", "meta", "images"]].itertuples(index=False):
                files = {f"{name}.{fmt}": text.encode("utf-8"), f"{name}_meta.json": meta_.encode("utf-8")}
                files |= {k.replace("/", "_"): base64.b64decode(v) for k, v in json.loads(images_ or "{}").items() if v is not None}
                for file, data in files.items():
                    commit_file(folder, f"{name}/{file}", lambda out, data=data: out.write(data))
                    made.append((doc, f"{name}/{file}", len(data)))
            yield pd.DataFrame(made, columns=["doc_id", "name", "bytes"])

    return rows.mapInPandas(write, _FILES)


def read_stage_artifacts(spark: SparkSession, glob: str, header: str, items: str, item: str, provenance: str) -> DataFrame:
    """Items of a stage's JSON artifacts, each with the artifact's header columns; provenance that an item lacks is the header's.

    ``header``, ``item`` and ``provenance`` are column lists (DDL), ``items`` the name of the artifact's list. No file under the
    path is an error.
    """
    inner = ", ".join(f"`{c.split()[0]}`: {c.split(maxsplit=1)[1]}" for c in item.split(","))
    given = ", ".join(f"`{c.split()[0]}`: {c.split(maxsplit=1)[1]}" for c in provenance.split(","))
    schema = f"{header}, provenance struct<{given}>, {items} array<struct<{inner}, provenance: struct<{given}>>>"
    each = spark.read.schema(schema).json(glob).select(*[c.split()[0] for c in header.split(",")], "provenance", F.explode(items).alias("i"))
    names = [c.split()[0] for c in provenance.split(",")]
    filled = F.struct(*[F.coalesce(F.col("i.provenance")[n], F.col("provenance")[n]).alias(n) for n in names])
    return each.select(*[c.split()[0] for c in header.split(",")], *[f"i.{c.split()[0]}" for c in item.split(",")], filled.alias("provenance"))


def assets_from_images(blocks: DataFrame, keys: list[str], images: str = "images") -> DataFrame:
    """A row for each entry of an image map: keys, asset_id (the name, ``/`` as ``_``) and content (the payload decoded)."""
    each = blocks.select(*keys, F.explode(images).alias("name", "payload"))
    return each.select(*keys, F.replace("name", F.lit("/"), F.lit("_")).alias("asset_id"), F.unbase64("payload").alias("content"))


def write_packages(packages: DataFrame, path: str) -> None:
    """Packages as JSON, a folder for each grade and subject; the stats are counted anew from what is written."""
    kinds = [f.name for f in packages.schema["stats"].dataType.fields]
    stats = F.struct(*[F.coalesce(F.when(F.col(k).isNotNull(), F.size(k)), F.lit(0)).alias(k) for k in kinds])
    folders = {"grade_dir": F.col("grade"), "subject_dir": F.col("subject")}
    packages.withColumn("stats", stats).withColumns(folders).write.partitionBy(*folders).json(path)


def read_packages(spark: SparkSession, root: str, schema: str, name: str = "*.json") -> DataFrame:
    """Every package file under a folder, at any depth."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).schema(schema).json(root)
