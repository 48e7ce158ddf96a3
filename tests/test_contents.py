"""Contents lists and tables from the text layer against plain Python."""

import itertools
import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import SF
from quire.operators.contents import least_cost
from quire.operators.tables import reconstruct, reconstruct_lines, table_tokens
from quire.plans.fixtures import lines_boxed
from quire.plans.queries_contents import columns, spread


def _cheapest(cost):
    """Least total over every way to give the first rows columns of their own."""
    n = min(len(cost), len(cost[0]))
    return min(sum(cost[i][j] for i, j in enumerate(js)) for js in itertools.permutations(range(len(cost[0])), n))


@pytest.mark.parametrize("seed", range(30))
def test_least_cost(seed):
    r = random.Random(seed)
    cost = [[float(r.randint(0, 20)) for _ in range(r_cols)] for r_cols in [r.randint(1, 6)] for _ in range(r.randint(1, 6))]
    pairs = least_cost(np.array(cost))
    assert len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs) == min(len(cost), len(cost[0]))
    assert sum(cost[i][j] for i, j in pairs) == pytest.approx(_cheapest(cost))
    wide = least_cost(np.array([[5.0, 1.0] + [9.0] * 20, [4.0, 2.0] + [9.0] * 20]))
    assert wide == [(0, 1), (1, 0)]


def _middle(b):
    return (b["x0"] + b["x1"]) / 2, (b["y0"] + b["y1"]) / 2


def _by_page(df):
    pages = {}
    for r in df.collect():
        pages.setdefault((r.doc_id, r.page_id), []).append(r.asDict())
    return {k: sorted(v, key=lambda b: b["line_idx"]) for k, v in pages.items()}


def test_assign_numbers(spark):
    got = {}
    for r in entry.queries()["c2_assign_numbers"](spark, SF).collect():
        got.setdefault((r.doc_id, r.page_id), {})[r.line_idx] = r.number
    for page, lines in _by_page(lines_boxed(spark, SF)).items():
        anchors, numbers = [b for b in lines if b["line_idx"] % 4 == 0], {}
        for b in lines:
            if b["line_idx"] % 4 in (1, 2):
                numbers.setdefault(len(b["text"]) % 7, b)
        if not anchors or not numbers:
            assert page not in got
            continue
        cost = [[math.dist(_middle(a), _middle(n)) for n in numbers.values()] for a in anchors]
        values, mine = list(numbers), got[page]
        assert len(set(mine.values())) == len(mine) == min(len(anchors), len(values))
        assert sum(cost[i][values.index(mine[a["line_idx"]])] for i, a in enumerate(anchors) if a["line_idx"] in mine) == pytest.approx(_cheapest(cost))


def test_decorative_toc(spark):
    got = {}
    for r in entry.queries()["c3_decorative_toc"](spark, SF).collect():
        got.setdefault((r.doc_id, r.page_id), {})[r.line_idx] = (r.printed_page, r.title, r.number, r.approximate)
    seen = 0
    for page, lines in _by_page(spread(spark, SF)).items():
        anchors = [b for b in lines if b["line_idx"] % 4 == 0 and int(b["text"]) <= 45]
        if len(anchors) < 3 or not any(b["line_idx"] % 4 == 1 for b in lines):
            assert page not in got
            continue
        rest = [b for b in lines if b not in anchors]
        near = {}
        for b in rest:
            near.setdefault(min(anchors, key=lambda a: (math.dist(_middle(a), _middle(b)), a["line_idx"]))["line_idx"], []).append(b)
        for a in anchors:
            words = sorted((b for b in near.get(a["line_idx"], []) if "فصل" in b["text"]), key=lambda b: (b["y0"], b["line_idx"]))
            title = re.sub(r"\s+", " ", " ".join(b["text"] for b in words)).strip()  # no two fragments of these pages share a row
            page_no, text, number, rough = got[page][a["line_idx"]]
            assert (page_no, re.sub(r"\s+", " ", text), rough) == (int(a["text"]), title, len(words) > 2)
            assert number is None or number in {int(b["text"]) for b in rest if b["text"].isdigit()}
            seen += 1
    assert seen == sum(map(len, got.values())) > 20


def test_contents_rows(spark):
    got = {}
    for r in entry.queries()["c4_contents_rows"](spark, SF).collect():
        got.setdefault((r.doc_id, r.page_id), []).append((r.text, r.fragments, r.x0, r.y0, r.x1, r.y1, r.printed_page))
    for page, lines in _by_page(columns(spark, SF)).items():
        left, right = min(b["x0"] for b in lines), max(b["x1"] for b in lines)
        spans = []
        for a, b in sorted((b["x0"], b["x1"]) for b in lines if b["x1"] - b["x0"] < 0.6 * (right - left)):
            if spans and a - spans[-1][1] < 0.02 * (right - left):
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
        rows = {}
        for b in lines:
            x = _middle(b)[0]
            column = min(range(len(spans)), key=lambda k: max(0, spans[k][0] - x, x - spans[k][1])) if spans else None
            rows.setdefault((column, b["y0"]), []).append(b)
        want = []
        for row in rows.values():
            text = re.sub(r"\s+", " ", " ".join(b["text"] for b in sorted(row, key=lambda b: (-b["x1"], b["line_idx"])))).strip()
            if text:
                number = re.match(r"^(.*\S)[\s.·•…_\-]+([0-9]+)$", text)
                want.append((text, len(row), min(b["x0"] for b in row), row[0]["y0"], max(b["x1"] for b in row), row[0]["y1"], int(number[2]) if number and re.sub(r"[\s.·•…_\-]+$", "", number[1]) and not number[1].strip(" .").isdigit() else None))
        assert sorted(g[:6] for g in got.get(page, [])) == sorted(w[:6] for w in want)
        assert sorted(str(g) for g in got.get(page, []) if g[6] is not None) == sorted(str(w) for w in want if w[6] is not None)


def _tokens(rows):
    return pd.DataFrame([(i, j, t, float(x0), float(x1), 12.0 * i) for i, row in enumerate(rows) for j, (t, x0, x1) in enumerate(row)], columns=["line_idx", "seq", "text", "x0", "x1", "y0"])


def _row(*cells):
    return [(t, x, x + 5 * len(t)) for x, t in cells]


def test_reconstruct():
    rows = [
        _row((10, "Name"), (120, "Size"), (220, "Year")), _row((10, "Oak"), (120, "12.5"), (220, "1999")), _row((10, "Elm & co"), (120, "7"), (220, "2001")), _row((15, "of old")), _row((10, "Ash"), (120, "30%"), (220, "1987")),
    ]
    html, score = reconstruct(_tokens(rows))
    assert html == (
        "<table><thead><tr><th>Name</th><th>Size</th><th>Year</th></tr></thead><tbody><tr><td>Oak</td><td>12.5</td><td>1999</td></tr>"
        "<tr><td>Elm &amp; co of old</td><td>7</td><td>2001</td></tr><tr><td>Ash</td><td>30%</td><td>1987</td></tr></tbody></table>"
    )
    assert 0.9 < score <= 1
    signs = [_row((0, "☐"), (20, f"code{i}"), (150, str(i))) for i in range(4)]
    assert "<td>☐ code2</td><td>2</td>" in reconstruct(_tokens(signs))[0]
    plain = [_row((0, "a"), (100, "b")), _row((0, "c"), (100, "d")), _row((0, "e"), (100, "f"))]
    assert reconstruct(_tokens(plain))[0] == "<table><thead><tr><th>a</th><th>b</th></tr></thead><tbody><tr><td>c</td><td>d</td></tr><tr><td>e</td><td>f</td></tr></tbody></table>"
    assert reconstruct(_tokens(plain[:2])) is None  # too few rows
    assert reconstruct(_tokens([_row((0, ""), (100, "b"))] * 4)) is None  # garbled
    assert reconstruct(_tokens([_row((0, "one")), _row((0, "two")), _row((0, "three"))])) is None  # no columns


def test_reconstructed_pages(spark):
    rows = entry.queries()["r3_reconstruct_table"](spark, SF).collect()
    assert len(rows) > 100 and all(0 <= r.score <= 1 for r in rows)


def test_tables_by_lines_and_by_tokens(spark):
    """Rows of several tokens give what single tokens give, also of a document that comes twice, and go to their tables by one shuffle and one sort."""
    from quire.operators.tables import reconstruct_tables
    from quire.plans.queries_contents import word_tables

    lines = word_tables(spark, SF)
    lines = lines.union(lines.where("doc_id % 5 = 0"))
    single = lines.select("doc_id", "page_id", "pos", "line_idx", "y0", F.explode("tokens").alias("t")).select("*", "t.*").drop("t")
    got, want = reconstruct_lines(lines), reconstruct_tables(single)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 100
    plan = entry.queries()["r3_reconstruct_table"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1


def test_score_of_a_grid_of_equal_columns_is_not_taken_twice(monkeypatch):
    """Ways to cut that deal the tokens alike are judged once, and a grid's texts are put together for the chosen one."""
    from quire.operators import tables

    made = []
    score = tables.Grid.score
    monkeypatch.setattr(tables.Grid, "score", lambda self, n: made.append(1) or score(self, n))
    assert reconstruct(_tokens([_row((0, "a"), (100, "b")), _row((0, "c"), (100, "d")), _row((0, "e"), (100, "f"))])) is not None
    assert len(made) == 1


@pytest.mark.parametrize("name", ["c2_assign_numbers", "c3_decorative_toc", "c4_contents_rows", "r3_reconstruct_table", "w3_rtl_reading_order", "w17_merge_math_lines"])
def test_no_call_for_each_page(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan


def test_characters_of_tables_are_made_once(spark):
    """Behind the shuffle by page, and neither sorted nor exploded."""
    plan = entry.queries()["r1_table_tokens"](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("split(CASE") == 1 and "ShuffledHashJoin" in plan and "Window" not in plan and "Union" not in plan


def test_tokens_of_several_spans(spark):
    char = lambda c, x: (c, float(x), 0.0, x + 9.0, 10.0)
    span = lambda text, x0, x1, chars: (text, float(x0), 0.0, float(x1), 10.0, chars)
    lines = [
        (1, 0, 0, 0.0, 0.0, 300.0, 10.0, [span("", 0, 20, []), span("abcd", 0, 90, [char("a", -20), char("b", 0), char("c", 10), char("\0", 20), char(".", 60), char("d", 80)]), span("ef", 100, 120, [char("e", 100), char(" ", 110), char("f", 300)])]),
        (1, 0, 1, 0.0, 0.0, 300.0, 10.0, [span(" whole ", 0, 40, None), span("...", 50, 60, []), span("far", 290, 400, []), span("end", 100, 140, None)]), (1, 1, 0, 0.0, 0.0, 300.0, 10.0, [span("x", 0, 9, [])]), (1, 0, 2, 400.0, 0.0, 500.0, 10.0, [span("y", 0, 9, [])]),
    ]
    df = spark.createDataFrame(lines, "doc_id long, page_id int, line_idx int, x0 double, y0 double, x1 double, y1 double, spans array<struct<text:string,x0:double,y0:double,x1:double,y1:double,chars:array<struct<c:string,x0:double,y0:double,x1:double,y1:double>>>>")
    tables = spark.createDataFrame([(1, 0, 3, 0.0, 0.0, 200.0, 20.0), (1, 0, 4, 95.0, 0.0, 200.0, 20.0)], "doc_id long, page_id int, pos int, x0 double, y0 double, x1 double, y1 double")
    got = sorted((r.pos, r.line_idx, r.seq, r.text, r.x0, r.x1) for r in table_tokens(df, tables).collect())
    assert got == [(3, 0, 0, "bc\0", 0.0, 29.0), (3, 0, 1, "d", 80.0, 89.0), (3, 0, 2, "e", 100.0, 119.0), (3, 1, 0, "whole", 0.0, 40.0), (3, 1, 1, "end", 100.0, 140.0), (4, 0, 0, "e", 100.0, 119.0), (4, 1, 0, "end", 100.0, 140.0)]


def test_titles_are_read_once(spark):
    """One pass makes the units, and their pages judge them by windows: no row meets another by a join."""
    plan = entry.queries()["c6_plain_toc"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # rows, and the pages of their books
