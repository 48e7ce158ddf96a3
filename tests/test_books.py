"""Operators on whole books and files: running titles, merged tables, numbers of lessons, archives, outputs."""

import io
import itertools
import random
import time
import zipfile

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import SF, connect
from quire.operators.blocks import ignored_headers, text_continuation
from quire.operators.books import cells_to_html, number_anchors, place_cells
from quire.operators.contents import least_cost
from quire.operators.entities import option_sets
from quire.operators.grouped import number_lessons
from quire.plans import queries_blocks
from quire.sources import files as S
from test_grouped import _slow_lcs


def _common(texts):
    """Texts over three times that make a fifth of the list or stand three times in a row."""
    best, run = {}, 0
    for k, t in enumerate(texts):
        run = run + 1 if k and texts[k - 1] == t else 1
        best[t] = max(best.get(t, 0), run)
    return [t for t in best if texts.count(t) > 3 and (texts.count(t) >= 0.2 * len(texts) or best[t] >= 3)]


def test_ignored_headers_against_brute_force(spark):
    docs = {}
    for r in queries_blocks._running(spark, SF).orderBy("doc_id", "pos").collect():
        docs.setdefault(r.doc_id, {}).setdefault(r.page_id, []).append(r)
    import re

    want = set()
    for doc, pages in docs.items():
        for top in (True, False):
            ends = [p[0] if top else p[-1] for _, p in sorted(pages.items())]
            clean = [re.sub(r"\s*[0-9]+$", "", re.sub(r"^[0-9]+\s*", "", e.text.strip(" "))) for e in ends]
            common = _common(clean)
            for e, t in zip(ends, clean, strict=True):
                if any(t == c or (t or c) and 200 * _slow_lcs(t, c) / (len(t) + len(c)) > 90 for c in common):
                    want.add((doc, e.page_id, e.pos, top))
    got = {tuple(r) for r in entry.queries()["w7_ignored_headers"](spark, SF).collect()}
    assert got == want and len(got) > 20


def test_nearly_common_titles(spark):
    """A title with a letter less goes as well, a different one stays; nothing on three pages."""
    title = "The history of writing and of books"
    rows = [(1, p, 0, "Text", f"{p} {title}") for p in range(6)] + [(1, 6, 0, "Text", title[:-1]), (1, 7, 0, "Text", "Something else altogether")] + [(1, p, 5, "Text", f"own {chr(97 + p) * 9}") for p in range(8)]
    rows += [(2, p, 0, "Text", title) for p in range(3)]
    df = spark.createDataFrame(rows, "doc_id int, page_id int, pos int, block_type string, text string")
    assert sorted(tuple(r) for r in ignored_headers(df).collect()) == [(1, p, 0, True) for p in range(7)]
    assert ignored_headers(df.limit(0)).count() == 0


def test_tables_go_on_in_all_four_ways(spark):
    rows = connect(SF).execute(entry.oracle_sql()["w18_table_merge_candidates"]).fetchall()
    assert {h for r in rows for h in r[-1].split(",")} == {"start", "page", "beside", "below", "column"}
    assert any(r[1] for r in connect(SF).execute(f"SELECT doc_id, has_continuation FROM ({entry.oracle_sql()['w12_text_continuation']}) WHERE has_continuation").fetchall())


def test_continuation_needs_lines(spark):
    """Blocks of one line, without lines, or before a picture don't go on; a footer in between doesn't matter."""
    blocks = spark.createDataFrame([(1, 0, 0, "Text", False, 50.0, 50.0, 300.0, 90.0), (1, 0, 1, "PageFooter", False, 50.0, 700.0, 99.0, 710.0), (1, 1, 2, "Text", False, 50.0, 50.0, 300.0, 90.0), (1, 2, 3, "Picture", False, 50.0, 50.0, 300.0, 90.0)], "doc_id int, page_id int, pos int, block_type string, removed boolean, x0 double, y0 double, x1 double, y1 double")
    line = "doc_id int, page_id int, block int, line_idx int, text string, x0 double, x1 double"
    two = [(1, 0, 0, 0, "a", 50.0, 300.0), (1, 0, 0, 1, "b-", 50.0, 200.0), (1, 1, 2, 2, "c", 50.0, 300.0), (1, 1, 2, 3, "d", 50.0, 300.0)]
    got = lambda rows: {r.pos: r.has_continuation for r in text_continuation(blocks, spark.createDataFrame(rows, line), 612.0, 792.0).collect()}
    assert got(two) == {0: True, 2: False}
    assert got([two[1], *two[2:]]) == {0: False, 2: False} and got(two[:2]) == {0: False, 2: False}
    assert got([two[0], (*two[1][:4], "short", 50.0, 200.0), *two[2:]]) == {0: False, 2: False}


def test_numbers_of_many_lessons():
    rng = random.Random(3)
    for _ in range(200):
        printed = [rng.choice([None, rng.randint(1, 12)]) for _ in range(rng.randint(0, 20))]
        used, want = [], []
        for p in printed:
            want.append(p if p is not None and p not in used else next(k for k in itertools.count(1) if k not in used))
            used.append(want[-1])
        assert number_lessons(printed) == want
    began = time.time()
    assert len(set(number_lessons([rng.choice([None, rng.randint(1, 90_000)]) for _ in range(100_000)]))) == 100_000
    assert time.time() - began < 5


def test_assignment_is_exact_for_many_columns():
    rng = np.random.default_rng(5)
    for n in (3, 7):
        cost = rng.random((n, n))
        assert np.isclose(sum(cost[i, j] for i, j in least_cost(cost)), min(sum(cost[i, p[i]] for i in range(n)) for p in itertools.permutations(range(n))))
    hidden = rng.permutation(40)
    cost = 1 + rng.random((40, 40))
    cost[np.arange(40), hidden] = 0.5  # the best one, which taking the cheapest pair first also finds
    cost[0, hidden[1]] = 0.1  # but for this
    cost[1, hidden[0]] = 9.0
    assert least_cost(cost) == sorted(enumerate(hidden.tolist()))


def test_anchors_of_all_digits(spark):
    rows = [(1, 0, k, text, 0.0, float(h)) for k, (text, h) in enumerate([("۱", 40), ("٢", 40.0004), (" 3 ", 40), ("۴", 9), ("5a", 90), ("۶", 10.0)])]
    df = spark.createDataFrame(rows, "doc_id int, page_id int, line_idx int, text string, y0 double, y1 double")
    assert sorted((r.line_idx, round(r.h, 3)) for r in number_anchors(df).collect()) == [(0, 40.0), (1, 40.0), (2, 40.0)]


def test_options_and_shared_ids(spark):
    rows = [("p", "a", "multiple_choice", [("1", True)]), ("p", "b", "multiple_choice", []), ("p", "c", "true_false", [("1", True), ("1", False)]), ("p", "d", "true_false", [("1", True), ("2", True)]), ("p", "e", "multiple_choice", [("1", False), ("2", False)]), ("p", "f", "short_answer", None)]
    df = spark.createDataFrame(rows, "package_id string, id string, question_type string, options array<struct<option_id: string, is_correct: boolean>>")
    got = sorted((r.entity_id, r.detail) for r in option_sets(df).collect())
    assert got == [("a", "all correct"), ("a", "few"), ("b", "few"), ("c", "shared"), ("d", "all correct")]


def _archive(*members):
    file = io.BytesIO()
    with zipfile.ZipFile(file, "w") as archive:
        for name, data in members:
            archive.writestr(name, data)
    return file.getvalue()


def test_archives_by_their_directory(spark):
    filler = ("filler.bin", b"x" * 3_000_000)
    rows = [
        (1, "a", _archive(filler, ("word/document.xml", b"x"))), (2, "a", _archive(filler, ("xl/workbook.xml", b"x"))), (3, "a", _archive(filler, ("ppt/a.xml", b"x"))), (4, "a", _archive(("mimetype", b"application/epub+zip"), filler)),
        (5, "a.docx", _archive(filler)), (6, "a.docx", _archive(filler, ("word/document.xml", b"x"))[:100]), (7, "a", b"some text " * 1000 + b"<span>"), (8, "a.png", b"\xff\xfe<b>"), (9, "a", b""), (10, "a.html", None), (11, "a", b"RIFF1234WEBPVP8"),
    ]
    df = spark.createDataFrame([(i, p, bytearray(c) if c is not None else None) for i, p, c in rows], "id int, path string, content binary")
    got = {r.id: r.kind for r in df.select("id", S.route_doctype(F.col("content"), F.col("path")).alias("kind")).collect()}
    assert got == {1: "docx", 2: "xlsx", 3: "pptx", 4: "epub", 5: "docx", 6: "docx", 7: "html", 8: "image", 9: "pdf", 10: "html", 11: "image"}


def test_first_files_and_outputs(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "text", "{}", {"/page/0/Picture/1.png": "YWJj"}), (2, "b", None, None, None)], "doc_id int, name string, text string, metadata string, images map<string,string>")
    made = sorted((r.doc_id, r.name, r.bytes) for r in S.write_outputs(df, f"file:{tmp_path}/out", "md").collect())
    assert made == [("1", "a/_page_0_Picture_1.png", 3), ("1", "a/a.md", 4), ("1", "a/a_meta.json", 2), ("2", "b/b.md", 0), ("2", "b/b_meta.json", 2)]
    assert (tmp_path / "out/a/_page_0_Picture_1.png").read_bytes() == b"abc" and not list(tmp_path.rglob("*.tmp"))
    assert [r.path.rsplit("/", 1)[1] for r in S.read_files(spark, f"{tmp_path}/out/a", 1).collect()] == ["a.md"]
    assert S.read_files(spark, f"{tmp_path}/out/a", 0).count() == 0


def test_cells_take_free_places(spark):
    rows = [("t", 1, 5, "a", 2, 1), ("t", 1, 9, "b", 1, 2), ("t", 4, 0, "c", 5, 1), ("t", 4, 1, None, None, None)]
    cells = spark.createDataFrame([(*r, False) for r in rows], "k string, row_id int, col_id int, text string, rowspan int, colspan int, is_header boolean")
    got = sorted((r.row_id, r.col_id, r.text, r.first) for r in place_cells(cells, ["k"]).collect())
    assert got == [(0, 0, "a", True), (0, 1, "b", True), (0, 2, "", False), (1, 0, "", False), (1, 1, "c", True), (1, 2, "", True)]
    assert cells_to_html(cells, ["k"]).first().html.startswith("<table><tbody><tr><td rowspan=2>a</td><td colspan=2>b</td></tr>")


def test_lessons_are_numbered_many_books_a_call(spark):
    """And blocks are read for their pages once, not for each of what a lesson tells."""
    plan = entry.queries()["c7_segment_lessons"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan and "PageHeader" not in plan
