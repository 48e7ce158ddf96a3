"""Operators with a running state: hand-made pages and brute-force versions."""

import random

import pytest
from pyspark.sql import functions as F

from quire.functions import similarity as M
from quire.operators import grouped as G

BOX = "doc_id long, page_id int, pos int, x0 double, y0 double, x1 double, y1 double, block_type string"


def boxes(spark, rows):
    return spark.createDataFrame([(1, 0, i, *map(float, r[:4]), r[4] if len(r) > 4 else "Text") for i, r in enumerate(rows)], BOX)


def test_rtl_order(spark):
    df = boxes(spark, [(0, 0, 50, 10), (60, 2, 110, 11), (0, 30, 50, 40), (60, 5, 90, 12)]).withColumnRenamed("pos", "line_idx")
    got = {r.line_idx: (r.row, r.new_pos) for r in G.rtl_reading_order(df).collect()}
    assert got == {1: (0, 0), 3: (0, 1), 0: (0, 2), 2: (1, 3)}


def test_heading_levels(spark):
    rows = [(1, i, h) for i, h in enumerate([30.0, 20.0, 20.5, 14.0, 10.0, 10.1, 30.5])] + [(2, 0, 9.0), (2, 1, 50.0)]
    got = {(r.doc_id, r.pos): r.level for r in G.heading_levels(spark.createDataFrame(rows, "doc_id long, pos int, height double")).collect()}
    assert [got[(1, i)] for i in range(7)] == [1, 2, 2, 3, 4, 4, 1] and got[(2, 0)] == got[(2, 1)] == 2


def test_split_heights_is_exact():
    from itertools import combinations

    r = random.Random(1)
    for _ in range(20):
        v = sorted(r.randint(1, 40) for _ in range(9))
        k = min(3, len(set(v)))
        var = lambda part: sum((x - sum(part) / len(part)) ** 2 for x in part)
        best = min(sum(var(v[a:b]) for a, b in zip((0, *c), (*c, 9), strict=True)) for c in combinations(range(1, 9), k - 1))
        starts = [v.index(e) for e in sorted(G.split_heights(v, 3))]
        assert abs(sum(var(v[a:b]) for a, b in zip(starts, [*starts[1:], 9], strict=True)) - best) < 1e-6


def test_blockquotes_and_indents(spark):
    df = boxes(spark, [(0, 0, 100, 10), (20, 12, 100, 22), (20, 24, 100, 34), (40, 36, 100, 46), (0, 50, 100, 60)])
    assert [r.level for r in G.blockquotes(df).orderBy("pos").collect()] == [0, 1, 1, 2, 0]
    items = boxes(spark, [(0, 0, 90, 10), (20, 12, 90, 22), (40, 24, 90, 34), (20, 36, 90, 46), (0, 48, 90, 58)])
    assert [r.level for r in G.list_indent(items, 100.0).orderBy("pos").collect()] == [0, 1, 2, 1, 0]


def test_captions(spark):
    df = boxes(spark, [(0, 0, 50, 10, "Caption"), (0, 12, 50, 60, "Picture"), (0, 62, 50, 70, "Caption"), (0, 72, 50, 90, "Table"), (0, 400, 50, 410, "Footnote")])
    got = [(r.block_type, r.members) for r in G.group_captions(df, 800.0).orderBy("pos").collect()]
    assert got == [("PictureGroup", "0,1,2")]


def test_math_lines(spark):
    df = boxes(spark, [(0, 0, 50, 10), (45, 0, 90, 10), (0, 20, 50, 30)]).withColumnRenamed("pos", "line_idx")
    assert [(r.run, r.math) for r in G.merge_math_lines(df).orderBy("line_idx").collect()] == [(0, True), (0, True), (2, False)]


def _slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = list(row)
        for j, y in enumerate(b, 1):
            row[j] = before[j - 1] + 1 if x == y else max(before[j], row[j - 1])
    return row[-1]


def _slow_partial(a, b):
    """Every window of the shorter text's length in the longer one, over its ends as well."""
    if not a or not b:
        return (100, 0) if not a and not b else (0, -1)
    q, t = (a, b) if len(a) <= len(b) else (b, a)
    if q in t:
        return 100, t.index(q)
    windows = [(max(0, i), t[max(0, i) : i + len(q)]) for i in range(1 - len(q), len(t))]
    scored = [(200 * _slow_lcs(q, w) / (len(q) + len(w)), -i) for i, w in windows]
    best = max(scored)
    return (best[0], -best[1]) if best[0] > 0 else (0, -1)


def test_ratios(spark):
    r = random.Random(2)
    rows = [("", ""), ("a", ""), ("same", "same")] + [("".join(r.choice("abc ") for _ in range(r.randint(0, 30))), "".join(r.choice("abc ") for _ in range(r.randint(0, 30)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", M.fuzz_ratio("a", "b").alias("r"), M.partial_ratio(F.col("a"), F.col("b")).alias("p"))
    for x in df.collect():
        want = 200 * _slow_lcs(x.a, x.b) / (len(x.a) + len(x.b)) if x.a or x.b else 100
        assert x.r == pytest.approx(want) and tuple(x.p) == pytest.approx(_slow_partial(x.a, x.b))
    cut = spark.createDataFrame(rows, "a string, b string").select("a", "b", M.partial_ratio(F.col("a"), F.col("b"), F.lit(80.0)).alias("p"))
    for x in cut.collect():
        score, start = _slow_partial(x.a, x.b)
        assert tuple(x.p) == pytest.approx((score, start) if score >= 80 else (0, -1))


def test_html_to_cells(spark):
    html = "<p>x</p><table><tr><th colspan=2>A</th><td rowspan='2'>B</td></tr><tr><td>c<br>d</td><td>e</td><td>too many</td></tr></table><table><tr><td>no</td></tr></table>"
    cells = spark.createDataFrame([(html,), ("none",), (None,)], "h string").select(F.explode_outer(G.html_to_cells("h")).alias("c")).where("c is not null").select("c.*").collect()
    assert [tuple(c) for c in cells] == [(0, 0, 1, 2, True, "A"), (0, 2, 2, 1, False, "B"), (1, 0, 1, 1, False, "c<br>d"), (1, 1, 1, 1, False, "e")]


def test_lesson_numbers(spark):
    rows = [("p", "a", 1, 1), ("p", "b", 2, 1), ("p", "c", 3, None), ("p", "d", 4, 3), ("p", "e", 5, 9), ("q", "a", 1, None)]
    df = spark.createDataFrame(rows, "package_id string, id string, first_page int, printed int")
    got = {(r.package_id, r.id): r.number for r in G.lesson_numbers(df).collect()}
    assert got == {("p", "a"): 1, ("p", "b"): 2, ("p", "c"): 3, ("p", "d"): 4, ("p", "e"): 9, ("q", "a"): 1}


def test_groups_by_the_batch(spark):
    """Groups that batches cut, null keys and rows without a group come out whole, and the helper is called for many groups at once."""
    from pyspark.sql import types as T

    from quire.operators.streams import solve_groups

    def solve(columns, groups):
        rows = [a for a, b in groups]
        return rows, {"n": [b - a for a, b in groups], "calls": [len(groups)] * len(groups)}

    df = spark.range(1, 20000, 1, 1).selectExpr("nullif(id div 7, 3) AS k", "concat('p', id % 2) AS p", "id")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    try:
        got = solve_groups(df, ["k", "p"], ["id"], ["k", "p", "id"], {"n": T.LongType(), "calls": T.IntegerType()}, solve).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = df.groupBy("k", "p").agg({"id": "min", "*": "count"}).collect()
    assert sorted((str(r.k), r.p, r.id, r.n) for r in got) == sorted((str(r.k), r.p, r["min(id)"], r["count(1)"]) for r in want)
    assert max(r.calls for r in got) > 100


def test_groups_of_a_union(spark):
    """Both sides are dealt by the key already; a group's rows of both still meet."""
    from pyspark.sql import types as T

    from quire.operators.streams import solve_groups

    side = lambda n: spark.range(300).selectExpr("id % 50 AS k", "id").groupBy("k").count().selectExpr("k", f"{n} AS kind")
    got = solve_groups(side(0).unionByName(side(1)), ["k"], ["kind"], ["k"], {"n": T.IntegerType()}, lambda columns, groups: ([a for a, _ in groups], {"n": [b - a for a, b in groups]})).collect()
    assert sorted((r.k, r.n) for r in got) == [(k, 2) for k in range(50)]


def test_windows_are_bounded_together(monkeypatch):
    """Texts of the same words in another order: few windows are compared, whatever the text's length."""
    import random

    from quire.functions import similarity

    r = random.Random(1)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(12)]
    passage, text = (" ".join(r.choice(words) for _ in range(n)) for n in (40, 400))
    compared = []
    plain = similarity._lcs
    monkeypatch.setattr(similarity, "_lcs", lambda a, b, masks=None: compared.append(len(b)) or plain(a, b, masks))
    assert similarity.best_window(passage, text, 90.0) == (0.0, -1)
    assert sum(compared) < 60 * len(text)
