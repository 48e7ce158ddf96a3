from collections import Counter

from oracle import SF, connect
from quire.llm.quality import BIN_FLOOR, SKETCH_BIN, measure_text, quality_rules
from quire.llm.queries import op10_quality


def _brute(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if n[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), sum(1 for i, x in enumerate(lines) if x in lines[:i]), len(covered)


def test_measures():
    for t in [None, "", " \n\t", "a", "a b c", "a b c a b c", "a a a a", "x y z w x y z", "# | <b>\n\n# | <b>\nq", "é\x85 b\xa0c", "one\n one\none", "a b c d a b c e f a b c " * 40]:
        assert measure_text(t)[:5] == _brute(t), t


def test_bins_hold_their_floor(spark):
    rows = spark.range(0, 100_000, 7).selectExpr("id AS value").selectExpr("value", f"{SKETCH_BIN} AS b").selectExpr("value", "b", f"{BIN_FLOOR} AS low")
    bad = rows.where("low > value or value - low > value / 64").count()
    assert bad == 0


def test_query_over_the_whole_table(spark):
    got = {r.doc_id: r for r in op10_quality(spark, SF).collect()}
    for d, t in connect().execute("SELECT doc_id, text FROM documents").fetchall():
        r, want = got[d], _brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_keeps_good_and_drops_bad(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    rows = op10_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("n_words >= 50").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1


def test_awkward_rows(documents):
    rows = [(None, None), (1, ""), (2, "w " * 60), (2, "w " * 60), (3, " ".join(map(str, range(30_000))))]
    out = {(r.row.doc_id, r.n_words): r.kept for r in quality_rules(documents(rows, extra=True)).collect()}
    assert out == {(None, 0): False, (1, 0): False, (2, 60): False, (3, 30_000): True}
    assert quality_rules(documents([])).count() == 0


def test_the_join_beyond_the_broadcast_gives_the_same(spark, documents, monkeypatch):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    key = lambda d: sorted((r.row.doc_id, r.kept) for r in d.collect())
    small = key(quality_rules(df))
    monkeypatch.setattr("quire.llm.quality.MAX_BROADCAST", 0)
    assert key(quality_rules(df)) == small


def _text(seed, lines=20, repeated=0, symbols=0):
    """Lines of 5 words of their own; the last ``repeated`` ones are copies of the first."""
    own = [" ".join(f"w{seed}x{i}y{j}" for j in range(5)) for i in range(lines - repeated)]
    return "\n".join(own + own[:1] * repeated + ["#" * symbols] * (symbols > 0))


def test_thresholds_follow_the_group_and_junk_raises_none(spark):
    rows = [(i, _text(i), "en", "strict", 0) for i in range(300)]
    rows += [(1000 + i, _text(i, repeated=i % 5), "en", "loose", 0) for i in range(300)]
    rows += [(2000 + i, _text(i, symbols=300 * (i % 5 < 2)), "en", "junk", 0) for i in range(300)]
    rows += [(3000, _text("p", repeated=4), "en", "strict", 0), (3001, _text("p", repeated=4), "en", "loose", 0), (3002, _text("p", repeated=4), "en", "few", 0)]
    out = {r.row.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert out[3000].dup_line_rate == out[3001].dup_line_rate == 200 and not out[3000].base_failed
    assert (out[3000].kept, out[3001].kept, out[3002].kept) == (False, True, True)
    assert out[3000].max_dup_line_rate < out[3001].max_dup_line_rate < 500
    assert all(out[i].kept for i in range(300)) and all(out[1000 + i].kept for i in range(300))
    assert [out[2000 + i].kept for i in range(300)] == [i % 5 >= 2 for i in range(300)]
    assert out[2000].max_symbol_rate <= out[3002].max_symbol_rate == 100 and out[0].max_symbol_rate < 100


def _floor(v):
    """Least value of the bin of v: 64 bins an octave from 128 on."""
    e = max(0, v.bit_length() - 7)
    return v >> e << e


def _limit(values, fixed):
    """Threshold of a group from (rate, passes the base rule) of its documents."""
    passed = [_floor(v) for v, ok in values if ok]

    def quantile(percent):
        return min((f for f in {_floor(v) for v, _ in values} if 100 * sum(p <= f for p in passed) >= percent * len(passed)), default=None)

    q25, q50, q99 = map(quantile, (25, 50, 99))
    return len(passed), max(fixed // 4, min(fixed, 2 * q99), q50 + 3 * (q50 - q25))


def test_verdicts_against_brute_force(spark):
    """Null languages and sources are groups; values at a threshold stay; small groups take their parent's threshold."""
    df = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "text", "if(doc_id % 9 = 0, null, lang) AS lang", "if(doc_id % 7 = 0, null, source) AS source")
    rules = {"symbol_rate": ("n_symbols", "n_words", 100), "dup_line_rate": ("n_dup_lines", "n_text_lines", 500), "repeat_rate": ("n_repeat_words", "n_words", 300)}
    docs = []
    for r in df.collect():
        n_words, _, n_symbols, n_dup, n_repeat = _brute(r.text)
        lines = sum(1 for x in (r.text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r"))
        m = {"n_words": n_words, "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat, "n_text_lines": lines}
        rates = {k: 1000 * m[a] // m[b] if m[b] else 0 for k, (a, b, _) in rules.items()}
        docs.append((r, rates, n_words >= 50 and 100 * n_repeat <= 50 * n_words))
    for least in (5, 30):
        got = {r.row.doc_id: r for r in quality_rules(df, min_group=least).collect()}
        assert len(got) == len(docs)
        for r, rates, ok in docs:
            over = False
            for k, (_, _, fixed) in rules.items():
                limit = None
                for group in ([d for d in docs], [d for d in docs if d[0].lang == r.lang], [d for d in docs if (d[0].lang, d[0].source) == (r.lang, r.source)]):
                    n, mine = _limit([(d[1][k], d[2]) for d in group], fixed)
                    limit = mine if limit is None else min(limit, mine) if n >= least else limit
                assert got[r.doc_id][f"max_{k}"] == limit, (r.doc_id, k)
                over |= rates[k] > limit
            assert got[r.doc_id].kept == (ok and not over)
