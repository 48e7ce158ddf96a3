"""The registered queries that SQL can't express, over the whole small tables, against plain Python."""

import pytest

import __spark_entry__ as entry
from oracle import SF
from quire.plans.fixtures import blocks, lines_boxed
from quire.plans.queries_rules import books
from test_grouped import _slow_lcs, _slow_partial


def _pages(df, key, *names):
    out = {}
    for r in df.collect():
        out.setdefault((r.doc_id, r.page_id), []).append({"pos": r[key], **{n: r[n] for n in ("x0", "y0", "x1", "y1", *names)}})
    return {k: sorted(v, key=lambda b: b["pos"]) for k, v in out.items()}


def _answer(spark, name):
    return entry.queries()[name](spark, SF).collect()


def test_rtl_reading_order(spark):
    got = {(r.doc_id, r.line_idx): (r.row, r.new_pos) for r in _answer(spark, "w3_rtl_reading_order")}
    n = 0
    for (doc, _), lines in _pages(lines_boxed(spark, SF), "line_idx").items():
        for b in lines:
            up = b["pos"] % 2 * 58
            b["y0"], b["y1"] = b["y0"] - up, b["y1"] - up
        rows = []
        for b in sorted(lines, key=lambda b: (b["y0"], -b["x1"], b["pos"])):
            for row in rows:
                head, low = row[0], min(row[0]["y1"] - row[0]["y0"], b["y1"] - b["y0"])
                if low > 0 and (min(head["y1"], b["y1"]) - max(head["y0"], b["y0"])) / low >= 0.5:
                    row.append(b)
                    break
            else:
                rows.append([b])
        order = [(k, b) for k, row in sorted(enumerate(rows), key=lambda e: (min(b["y0"] for b in e[1]), e[0])) for b in sorted(row, key=lambda b: (-b["x1"], b["pos"]))]
        for at, (k, b) in enumerate(order):
            assert got[(doc, b["pos"])] == (k, at)
            n += 1
    assert n == len(got)


def _classes(values, k):
    """Least values of the best k classes, by trying every cut of the sorted values."""
    v = sorted(values)
    cost = lambda part: sum(x * x for x in part) - sum(part) ** 2 / len(part)
    best = {0: (0.0, [])}
    for _ in range(min(k, len(set(v)))):
        best = {j: min((best[i][0] + cost(v[i:j]), [*best[i][1], v[i]]) for i in best if i < j) for j in range(1, len(v) + 1) if any(i < j for i in best)}
    return best[len(v)]


def test_heading_levels(spark):
    got = {}
    for r in _answer(spark, "w6_heading_levels"):
        got[(r.doc_id, r.pos)] = r.level
    docs = {}
    for r in blocks(spark, SF).where("block_type = 'SectionHeader'").collect():
        docs.setdefault(r.doc_id, []).append((r.pos, r.y1 - r.y0))
    assert len(got) == sum(map(len, docs.values()))
    for doc, heads in docs.items():
        if len(heads) <= 4:
            assert all(got[(doc, p)] == 2 for p, _ in heads)
        elif len(heads) <= 40:  # the slow search; longer documents only have more of the same seven heights
            edges = sorted(_classes([round(h, 3) for _, h in heads], 4)[1], reverse=True)
            for p, h in heads:
                assert got[(doc, p)] == next(i + 1 for i, e in enumerate(edges) if h >= e * 0.99)


def test_list_indent(spark):
    got = {(r.doc_id, r.pos): r.level for r in _answer(spark, "w14_list_indent")}
    pages = _pages(blocks(spark, SF).where("block_type = 'ListItem'"), "pos")
    for (doc, _), items in pages.items():
        stack = []
        for i, b in enumerate(items):
            while stack and b["x0"] <= stack[-1][0]["x0"] + 6.12:
                stack.pop()
            level = stack[-1][1] + 1 if stack and b["y0"] > stack[-1][0]["y0"] else 0
            assert got[(doc, b["pos"])] == level
            stack = [] if i + 1 < len(items) and items[i + 1]["x0"] > b["x1"] else [*stack, (b, level)]
    assert len(got) == sum(map(len, pages.values()))


def test_math_lines(spark):
    got = {(r.doc_id, r.line_idx): (r.run, r.math) for r in _answer(spark, "w17_merge_math_lines")}
    for (doc, _), lines in _pages(lines_boxed(spark, SF), "line_idx").items():
        runs = []
        for b in lines:
            b["y0"], b["y1"] = 40.0 + 60 * (b["pos"] % 12 // 2), 50.0 + 60 * (b["pos"] % 12 // 2)
            if runs:
                head, last = runs[-1][0], runs[-1][-1]
                area = max(0, min(last["x1"], b["x1"]) - max(last["x0"], b["x0"])) * max(0, min(last["y1"], b["y1"]) - max(last["y0"], b["y0"]))
                if (min(head["y1"], b["y1"]) - max(head["y0"], b["y0"])) / max(1, b["y1"] - b["y0"]) > 0.8 and area / max(1, (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])) >= 0.015:
                    runs[-1].append(b)
                    continue
            runs.append([b])
        for run in runs:
            for b in run:
                assert got[(doc, b["pos"])] == (run[0]["pos"], len(run) > 1)


def test_lesson_numbers(spark):
    got = {(r.package_id, r.id): r.number for r in _answer(spark, "w21_lesson_numbers")}
    packages = {}
    for r in books(spark, SF, "lessons").collect():
        packages.setdefault(r.package_id, []).append((r.pdf_start, r.id, r.lesson_number % 30 or None))
    for p, lessons in packages.items():
        taken = set()
        for _, i, printed in sorted(lessons):
            number = printed if printed and printed not in taken else next(n for n in range(1, 1000) if n not in taken)
            taken.add(number)
            assert got[(p, i)] == number


def test_fuzz_ratio(spark):
    texts = {(r.doc_id, r.line_idx): r.text for r in lines_boxed(spark, SF).collect()}
    rows = _answer(spark, "t29_fuzz_ratio")
    assert len(rows) == len(texts)
    for r in rows:
        a, b = texts[(r.doc_id, r.line_idx)], texts.get((r.doc_id, r.line_idx - 1), "")
        if len(a) * len(b) < 1500:
            assert r.ratio == pytest.approx(200 * _slow_lcs(a, b) / (len(a) + len(b)) if a or b else 100, abs=1e-3)


def test_check_rules(spark, tmp_path):
    """Whole documents against whole passages, by every window."""
    passages = ["the quick brown fox jumps", "over a lazy dog, twice", "nothing like it"]
    texts = [passages[0] + " and more", "x " * 9, "so " + passages[2][7:] + " after nothing", "", "a the quick brown f0x jumps b", passages[1], "over a lazy d0g, twice", None, "nothing like it", "…", "jumps the fox over", "7"]
    spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.type, r.passed) for r in entry.queries()["j25_check_rules"](spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        q, t, kind = passages[i % 3], t or "", ("present", "absent", "order", "baseline")[i % 4]
        least = lambda x: 100 - 100 * (len(q) // 10) / len(x)  # noqa: B023, E731
        find = lambda x: _slow_partial(x, t)  # noqa: B023, E731
        a, b = q[: len(q) // 2], q[len(q) // 2 :]
        order = find(a)[0] >= least(a) and find(b)[0] >= least(b) and find(a)[1] < find(b)[1]
        want = {"present": find(q)[0] >= least(q), "absent": find(q)[0] < least(q), "order": order, "baseline": any(c.isalnum() for c in t)}[kind]
        assert got[i] == (kind, want), i
