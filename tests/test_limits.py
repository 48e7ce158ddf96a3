"""Cases without a limit on depth, rounds or passes, and rules that the data tables don't reach."""

import json

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quire.functions import text as X
from quire.operators import contents as K
from quire.operators import rules as R
from quire.operators.benchmarks import check_rules
from quire.session import Scratch
from quire.sources import files as S


def test_nested_tags_merge(spark):
    rows = [("<b>a</b>" * 5,), ("<b>" * 6 + "x" + "</b>" * 6 + "<b>" * 6 + "y" + "</b>" * 6,), ("<b>a</b> \n <b>b</b>c",), ("<i>a</i><i>b</i>",), ("",), (None,)]
    out = [r[0] for r in spark.createDataFrame(rows, "t string").select(X.merge_consecutive_tags(F.col("t"), "b")).collect()]
    assert out == ["<b>aaaaa</b>", "<b>" * 6 + "xy" + "</b>" * 6, "<b>a bc</b>".replace("bc</b>", "b</b>c"), "<i>a</i><i>b</i>", "", None]


def _tree(depth):
    node = {"id": f"b{depth}", "block_type": "Text", "html": "x"}
    for d in range(depth - 1, -1, -1):
        node = {"id": f"b{d}", "block_type": "Group", "html": "", "children": [node, {"id": f"leaf{d}", "block_type": "Text", "html": "y"}]}
    return json.dumps(node)


def test_leaves_of_deep_trees(spark):
    df = spark.createDataFrame([(1, _tree(7)), (2, _tree(0))], "k long, j string")
    got = sorted((r.k, r.id, r.path) for r in S.leaf_blocks(df, "j", ["k"]).collect())
    assert (1, "b7", [0] * 7) in got and len(got) == 9 and (2, "b0", []) in got
    with pytest.raises(PySparkException):
        S.leaf_blocks(spark.createDataFrame([(1, _tree(9))], "k long, j string"), "j", ["k"]).collect()


def test_long_chains_are_no_cycles(spark):
    edges = [("chain", i, i + 1, "prerequisite") for i in range(18)] + [("ring", i, (i + 1) % 7, "prerequisite") for i in range(7)] + [("self", 1, 1, "prerequisite"), ("other", 1, 2, "part_of"), ("other", 2, 1, "part_of")]
    found = R.prerequisite_cycles(spark.createDataFrame(edges, "package_id string, source_id long, target_id long, relation_type string"), Scratch(spark, "t"))
    assert [r.package_id for r in found.collect()] == ["ring"]


def test_rules_over_parts_of_a_page(spark):
    rules = [
        (1, "present", "end of it", None, None, None, 9, 0), (1, "present", "end of it", None, None, 5, None, 0), (1, "absent", "start", None, None, None, 4, 0), (1, "present", "a **stort**", None, None, 9, None, 1),
        (1, "order", None, "start", "end", None, None, 0), (1, "order", None, "end", "start", None, None, 0), (1, "order", None, "nowhere at all", "end", None, None, 0), (2, "baseline", None, None, None, None, None, 0),
    ]
    df = spark.createDataFrame(rules, "doc_id long, type string, text string, before string, after string, first_n int, last_n int, max_diffs int")
    pages = spark.createDataFrame([(1, "a <b>start</b> of something and the end of it"), (2, " … \n")], "doc_id long, md string")
    got = sorted((r.type, r.text or r.before or "", r.first_n or 0, r.passed) for r in check_rules(df, pages, "doc_id").collect())
    assert got == sorted([
        ("present", "end of it", 0, True), ("present", "end of it", 5, False), ("absent", "start", 0, True), ("present", "a **stort**", 9, True),
        ("order", "start", 0, True), ("order", "end", 0, False), ("order", "nowhere at all", 0, False), ("baseline", "", 0, False),
    ])


def test_a_decorative_list_wins(spark):
    ddl = "doc_id long, page_id int, {} int, title string, printed_page long, number long"
    decorative = spark.createDataFrame([(1, 0, 4, "A", 3, 1)], ddl.format("line_idx"))
    plain = spark.createDataFrame([(1, 1, 0, "B", 5, 2), (2, 0, 0, "C", 7, None)], ddl.format("row_id"))
    assert sorted((r.doc_id, r.title, r.toc_source) for r in K.choose_toc(decorative, plain).collect()) == [(1, "A", "decorative"), (2, "C", "plain")]


def test_files_are_listed_by_path(spark, tmp_path):
    for name in ("c.txt", "a.txt", "b.txt"):
        (tmp_path / name).write_text(name)
    files = S.read_files(spark, str(tmp_path), 2).collect()
    assert [bytes(f.content) for f in files] == [b"a.txt", b"b.txt"]


def test_artifacts_must_exist(spark, tmp_path):
    with pytest.raises(PySparkException):
        S.read_stage_artifacts(spark, f"{tmp_path}/none/*.json", "lesson_id string", "concepts", "id string", "model_id string").collect()


def test_tokens_of_a_doubled_alef(spark, tmp_path):
    """A letter order that the normaliser would mend, which the query's SQL leaves."""
    spark.createDataFrame([(1, "ddf add dd f\nbddfa", "en", "s", 10)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = entry.queries()["t23_tokens"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == sorted(con.execute(entry.oracle_sql()["t23_tokens"]).fetchall())
    assert got[0].words.startswith("اال")


def test_duplicates_of_common_words(spark):
    """Every overlap from the threshold up is found, and a word that the whole lesson shares makes no pairs by itself."""
    import itertools
    import random

    from quire.operators.claims import flag_duplicates

    r = random.Random(5)
    rows = [("p", "l", f"c{i:03d}", "unit " + " ".join(r.choice("abcdefgh") * 2 for _ in range(r.randint(1, 9)))) for i in range(80)] + [("p", "l", "c000", "unit aa")]
    df = spark.createDataFrame(rows, "package_id string, lesson_id string, id string, label string")
    for least in (0.0, 0.5, 0.7, 0.9, 1.0):
        want = {(a[2], b[2]) for a, b in itertools.permutations(rows, 2) if a[2] < b[2] for x, y in [(set(a[3].split()), set(b[3].split()))] if len(x & y) / len(x | y) >= least}
        assert {(x.id_a, x.id_b) for x in flag_duplicates(df, least).collect()} == want
    apart = spark.range(3000).selectExpr("'p' AS package_id", "'l' AS lesson_id", "cast(id AS string) AS id", "concat('unit w', id) AS label")
    assert flag_duplicates(apart, 0.9).count() == 0


def test_duplicates_of_small_lessons_are_shuffled_once(spark):
    """Labels of small lessons are gathered by one shuffle, and no word is a row; small and large lessons give all their pairs, repeated and empty rows too."""
    import random

    from quire.operators.claims import IN_ROW, flag_duplicates

    r = random.Random(3)
    sizes = {f"l{i}": n for i, n in enumerate([1, 2, 5, IN_ROW - 1, IN_ROW, IN_ROW + 1, 2 * IN_ROW])}
    rows = [(p, l, f"c{r.randrange(3 * n):03d}", r.choice([None, "", "unit"] + [" ".join(r.choices("abcd", k=r.randint(1, 4))) for _ in range(9)])) for p in "pq" for l, n in sizes.items() for _ in range(n)]
    rows += [("p", "l2", None, "a"), ("p", None, "c1", "a"), ("p", None, "c2", "a"), (None, "l2", "c1", "a"), (None, "l2", "c2", "a")]
    schema = "package_id string, lesson_id string, id string, label string"
    whole, small = spark.createDataFrame(rows, schema), spark.createDataFrame([x for x in rows if sizes.get(x[1], 0) <= IN_ROW], schema)
    words = lambda t: set((t or "").split())
    for least in (0.5, 0.75, 1.0):
        want = {(*a[:3], b[2]) for a in rows for b in rows if None not in (*a[:3], *b[:3]) and a[:2] == b[:2] and a[2] < b[2] for x, y in [(words(a[3]), words(b[3]))] if x & y and len(x & y) / len(x | y) >= least}
        assert sorted(map(tuple, flag_duplicates(whole, least).collect())) == sorted(want)
    plan = flag_duplicates(small, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_block_json_keeps_the_markup_of_each_type(spark, tmp_path):
    import hashlib

    text = "\n".join(["a", "b", "c", "it's <b> & \"x\"", "e", "item", "item", "t", "cap", "pic"])
    spark.createDataFrame([(1, text, "en", "s", 10)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.block_type: r.html for r in entry.queries()["s6_read_block_json"](spark, str(tmp_path)).collect()}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    level = 1 + len("it's <b> & \"x\"") % 4
    assert got["SectionHeader"] == md5(f"<h{level}>it&#x27;s &lt;b&gt; &amp; &quot;x&quot;</h{level}>")
    assert got["ListItem"] == md5("<li>item</li>") and got["Picture"] == md5("") and got["Caption"] == md5("<p block-type='Caption'>cap</p>")


@pytest.mark.parametrize(("name", "reads"), [("c17_ground_concepts", 3), ("c17_ground_objectives", 4)])
def test_grounding_reads_each_table_once(spark, name, reads):
    """Proposals, citations and blocks; objectives join their proposals to the citations and again to what these weigh."""
    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == reads


def test_first_twin_is_the_first_duplicate(spark):
    import random

    from quire.operators.claims import first_twin, flag_duplicates

    r = random.Random(7)
    rows = [("p", r.choice(["l", "m", None]), f"c{i:03d}", r.choice([None, "", " "] + [" ".join(r.choices("abc", k=r.randint(1, 3))) for _ in range(9)])) for i in range(120)]
    df = spark.createDataFrame(rows, "package_id string, lesson_id string, id string, label string")
    want: dict[str, str] = {}
    for x in flag_duplicates(df, 1.0).collect():
        want[x.id_b] = min(want.get(x.id_b, x.id_a), x.id_a)
    assert {x.id: x.duplicate_of for x in first_twin(df).collect()} == {row[2]: want.get(row[2]) for row in rows} and len(want) > 20


def test_foreign_citations_weigh_nothing(spark):
    from quire.operators.ground import ground_concepts

    proposals = spark.createDataFrame([("p", "l", "c1", "a b", "explicit", 0.5, "high"), ("p", "l", "c2", "B  a", "explicit", 0.5, "low"), ("p", "l", "c3", "x", "explicit", 0.5, "high"), ("p", "l", "c4", " ", "explicit", 0.5, "high"), ("p", "l", "c5", "y", "explicit", 0.5, "high")], "package_id string, lesson_id string, id string, label string, claimed_level string, model_confidence double, density string")
    cites = [("c1", "b1", True, "exact", None), ("c1", "b1", False, "exact", None), ("c1", "z1", True, "exact", None), ("c1", "z1", True, "exact", None), ("c1", None, True, "exact", None), ("c2", "b2", True, "token_overlap", "i"), ("c2", "z2", True, "exact", None), ("c3", "z1", True, "exact", None), ("c4", "b1", True, "exact", None)]
    citations = spark.createDataFrame([("p", *c) for c in cites], "package_id string, id string, block_id string, matched boolean, method string, asset_id string")
    got = {r.id: (r.level, r.n_evidence, r.n_verified, r.exact, r.dropped, r.duplicate_of) for r in ground_concepts(proposals, citations, spark.createDataFrame([("p", "b1"), ("p", "b2"), ("p", "b2"), ("q", "z1")], "package_id string, block_id string")).collect()}
    assert got == {"c1": ("explicit", 2, 1, True, 2, None), "c2": ("needs_visual_review", 1, 1, False, 1, "c1")}
