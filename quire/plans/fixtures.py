"""Document-structure tables derived from the driver's tables, in Spark and in DuckDB SQL.

Each is one SELECT that both engines read alike where possible; ``CTES`` holds the DuckDB texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import table


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each line of each document; 12 lines make a page."""
    docs = table(spark, sf_dir, "documents")
    lines = docs.select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("line_idx", "text"))
    return lines.withColumn("page_id", F.expr("cast(line_idx div 12 as int)"))


_BOX = [
    "cast(72 + 9 * (line_idx % 3) as double) AS x0", "cast(40 + 60 * (line_idx % 12) as double) AS y0",
    "cast(72 + 9 * (line_idx % 3) + 4 * least(length(text), 110) as double) AS x1", "cast(50 + 60 * (line_idx % 12) + length(text) % 7 as double) AS y1",
]
_TYPE = """CASE WHEN line_idx % 12 = 0 THEN 'PageHeader' WHEN line_idx % 12 = 11 THEN 'PageFooter' WHEN line_idx % 11 = 3 THEN 'SectionHeader'
  WHEN line_idx % 11 IN (5, 6) THEN 'ListItem' WHEN line_idx % 11 = 8 THEN 'Caption' WHEN line_idx % 11 = 9 THEN 'Picture'
  WHEN line_idx % 11 = 10 THEN 'Footnote' WHEN line_idx % 11 = 7 THEN 'Table' ELSE 'Text' END"""


def lines_boxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a box, in points; the origin is the top left."""
    return doc_lines(spark, sf_dir).selectExpr("doc_id", "source", "page_id", "line_idx", "text", *_BOX)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block for each line, typed by its place."""
    b = lines_boxed(spark, sf_dir).selectExpr("*", f"{_TYPE} AS block_type")
    return b.selectExpr(
        "doc_id", "source", "page_id", "line_idx AS pos", "text", "x0", "y0", "x1", "y1", "block_type", "concat('/page/', page_id, '/', block_type, '/', line_idx) AS block_id",
        "CASE WHEN block_type = 'SectionHeader' THEN 1 + length(text) % 4 END AS heading_level", "length(text) % 100 AS conf", "length(text) % 13 = 0 AS removed",
    )


def layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box around each three lines; every 11th is a picture."""
    g = lines_boxed(spark, sf_dir).selectExpr("*", "cast(line_idx div 3 as int) AS pos")
    return g.groupBy("doc_id", "page_id", "pos").agg(
        (F.min("x0") - 2).alias("x0"), (F.min("y0") - 2).alias("y0"), (F.max("x1") + 2).alias("x1"), (F.max("y1") + 2).alias("y1"),
    ).selectExpr("*", "CASE WHEN pos % 11 = 10 THEN 'Picture' ELSE 'Text' END AS block_type")


CTES = {
    "doc_lines": """doc_lines AS (SELECT doc_id, source, CAST(i - 1 AS INT) AS line_idx, string_split(text, chr(10))[i] AS text, CAST((i - 1) // 12 AS INT) AS page_id
  FROM (SELECT doc_id, source, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents))""",
    "lines_boxed": f"lines_boxed AS (SELECT doc_id, source, page_id, line_idx, text, {', '.join(_BOX)} FROM doc_lines)",
    "blocks": f"""blocks AS (SELECT doc_id, source, page_id, line_idx AS pos, text, x0, y0, x1, y1, block_type, concat('/page/', page_id, '/', block_type, '/', line_idx) AS block_id,
  CASE WHEN block_type = 'SectionHeader' THEN 1 + length(text) % 4 END AS heading_level, length(text) % 100 AS conf, length(text) % 13 = 0 AS removed
  FROM (SELECT *, {_TYPE} AS block_type FROM lines_boxed))""",
    "layout": """layout AS (SELECT doc_id, page_id, CAST(line_idx // 3 AS INT) AS pos, min(x0) - 2 AS x0, min(y0) - 2 AS y0, max(x1) + 2 AS x1, max(y1) + 2 AS y1,
  CASE WHEN CAST(line_idx // 3 AS INT) % 11 = 10 THEN 'Picture' ELSE 'Text' END AS block_type FROM lines_boxed GROUP BY doc_id, page_id, CAST(line_idx // 3 AS INT))""",
}
_NEEDS = {"doc_lines": [], "lines_boxed": ["doc_lines"], "blocks": ["doc_lines", "lines_boxed"], "layout": ["doc_lines", "lines_boxed"]}


def with_fixtures(sql: str, *names: str) -> str:
    """DuckDB SQL: the fixtures that ``names`` need, then ``sql`` (which may start with more CTEs after a comma)."""
    order: list[str] = []
    for n in names:
        order += [x for x in [*_NEEDS[n], n] if x not in order]
    return "WITH " + ",\n".join(CTES[n] for n in order) + ("" if sql.lstrip().startswith(",") else "\n") + sql
