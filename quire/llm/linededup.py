"""Line dedup: lines that many documents share go; the others keep their place.

Lines are exploded with their position, normalised and hashed; the distinct documents of each
hash are counted; positions of lines over the threshold come back per document and are left out
when the text is put together again. Built-in expressions only.

* null text: one empty line, as an empty text; the kept text is then empty.
* An empty key (white space only) is never counted or dropped.
* A document is a distinct id (null counts as one id); a line repeated within a document counts once.
* Repeated rows each return a row; the positions that they drop are kept once for all of them. An empty table returns no rows.
* Extra columns travel in ``row``; their names can't clash with the outputs.

Scale: line texts are never shuffled, only (id, text hash, position, 128-bit line hash); the count
of a hot line is combined before its shuffle, first by (line, document), then by line. The join that
finds dropped positions is a plain equi-join that adaptive execution splits at hot lines. Texts are
shuffled once, by document, to meet their dropped positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.text import SPACES, ascii_lower, carried
from quire.session import Scratch


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Columns: row, n_lines, n_dropped (longs), kept_text."""
    scratch = Scratch(docs.sparkSession, "linededup")
    text = F.coalesce(docs[text_col], F.lit(""))
    base = carried(docs, id=docs[id_col], text_hash=F.xxhash64(text), lines=F.split(text, "\n"))
    key = line_key(F.col("line"))
    lines = scratch.keep(
        base.select("id", "text_hash", F.posexplode("lines").alias("pos", "line"))
        .select("id", "text_hash", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2")),
        "lines",
    )
    common = lines.groupBy("h1", "h2").agg(F.count_distinct(F.struct("id")).alias("n_docs")).where(F.col("n_docs") >= min_docs).select("h1", "h2")
    common = scratch.keep(common, "common")  # so that both sides of the join are scans, which a hot line can't hold up
    dropped = (
        lines.join(common, ["h1", "h2"], "left_semi")
        .groupBy("id", "text_hash")
        .agg(F.collect_set("pos").alias("drop_pos"))  # equal rows share their positions
    )
    at = (F.col("b.id").eqNullSafe(F.col("d.id"))) & (F.col("b.text_hash") == F.col("d.text_hash"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop_pos")), lambda p: F.get(F.col("lines"), p))
    return (
        base.alias("b").join(dropped.alias("d"), at, "left")
        .select("row", "lines", "drop_pos", F.when(F.col("drop_pos").isNull(), F.col("lines")).otherwise(kept).alias("kept"))
        .select(
            "row", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
            F.array_join("kept", "\n").alias("kept_text"),
        )
    )
