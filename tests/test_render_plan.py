"""The renderers' shared step: what it shuffles, and lines whose ends hang on the next one."""

import time

from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import SF, connect
from quire.functions.markup import html_to_markdown
from quire.functions.text import dehyphenate
from quire.operators import render as M
from quire.operators import rules as R
from quire.plans.queries_render import tree
from quire.session import Scratch


def test_nodes_are_shuffled_once(spark):
    """A deal of each level's nodes by page, and no written copy of all nodes."""
    plan = M.assemble(tree(spark, SF))._jdf.queryExecution().toString()
    assert "quire-tree" not in plan
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning(doc_id") <= 5  # three levels, the last in one deal, and the groups' own


def test_ends_of_lines(spark):
    """Lines in a block and at the top of a page: cut at a hyphen, a break before the next, trimmed at the end; another block ends them too."""
    texts = ["An exam-", "ple that goes on", "to here "]
    line = lambda page, id_, parent, depth, pos, text, kind="Line": (1, page, id_, parent, depth, pos, kind, text)
    rows = [line(0, "b", None, 1, 0, None, "Text"), *(line(0, f"b{k}", "b", 2, k, t) for k, t in enumerate(texts))]
    rows += [*(line(1, f"c{k}", None, 1, k, t) for k, t in enumerate(texts[:2])), line(1, "c2", None, 1, 2, "x", "Text"), line(1, "c3", None, 1, 3, "last ")]
    nodes = spark.createDataFrame(rows, "doc_id long, page_id int, block_id string, parent_id string, depth int, pos int, block_type string, text string")
    made = {r.block_id: r.html for r in M.assemble(nodes).collect()}
    assert made["b"] == "<p block-type='Text'>An example that goes on to here</p>"
    assert [made[f"c{k}"] for k in range(4)] == ["An exam", "ple that goes on", "<p block-type='Text'>x</p>", "last"]


def test_pagination_is_held_whole(spark):
    """m4_paginate gives the digest of the whole paginated markdown, not its page numbers alone; its SQL gives the same one."""
    rows = {r.doc_id: r for r in entry.queries()["m4_paginate"](spark, SF).collect()}
    cur = connect(SF).execute(entry.oracle_sql()["m4_paginate"])
    at = [c[0] for c in cur.description].index("markdown")
    assert {r[0]: r[at] for r in cur.fetchall()} == {k: r["markdown"] for k, r in rows.items()}
    assert len({r["markdown"] for r in rows.values()}) > len({tuple(r["pages"]) for r in rows.values()})


def test_cycles_are_not_broadcast(spark):
    """The rounds of v32 join tables as large as the edges: none goes through the driver."""
    seen = []

    class Seen(Scratch):
        def keep(self, df, name):
            seen.append(df._jdf.queryExecution().executedPlan().toString())
            return super().keep(df, name)

    edges = spark.createDataFrame([("p", "prerequisite", a, b) for a, b in [("x", "y"), ("y", "x"), ("y", "z")]] + [("q", "prerequisite", "x", "y")], "package_id string, relation_type string, source_id string, target_id string")
    assert [r.package_id for r in R.prerequisite_cycles(edges, Seen(spark, "seen")).collect()] == ["p"]
    assert any("Join" in x for x in seen) and not any("Broadcast" in x for x in seen)


def test_markup_comes_in_bounded_batches(spark):
    """Whole texts go to Python at most 1,000 at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, 10_000)
    html_to_markdown(F.lit("<p>a</p>"))
    assert int(spark.conf.get(key)) == 1000


def test_hyphens_at_the_end_of_long_lines(spark):
    """One pass over a line, however long: a pattern tried again from each of its characters takes the square of its length."""
    rows = [("ab " * 100_000, "x"), ("ab " * 100_000 + "ab-", "x"), ("a-\n", " x"), ("a-", "X"), ("a\nb\u2014 ", "x"), (None, "x"), ("a-", None)]
    df = spark.createDataFrame(rows, "line string, after string")
    began = time.perf_counter()
    out = [r.v for r in df.select(dehyphenate(F.col("line"), F.col("after")).alias("v")).collect()]
    assert out == [rows[0][0], rows[1][0][:-1], "a\n", "a-", "a\nb ", None, "a-"]
    assert time.perf_counter() - began < 10
