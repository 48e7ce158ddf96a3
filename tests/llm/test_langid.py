import random
import re

import numpy as np
from pyspark.sql import functions as F

from oracle import SF
from quire.llm.langid import CrossParser, identify, learn_languages, suffix_automaton
from quire.llm.queries import op6_langid


def _phrases(sample, text):
    """Greedy parse by brute force."""
    sample, n, at = "".join(map(chr, sample)), 0, 0
    while at < len(text):
        length = 1
        while at + length < len(text) and "".join(map(chr, text[at : at + length + 1])) in sample:
            length += 1
        if chr(text[at]) not in sample:
            length = 1
        n, at = n + 1, at + length
    return n


def test_phrases_against_brute_force():
    r = np.random.default_rng(3)
    samples = {"a": r.integers(97, 101, 400).tolist(), "b": r.integers(97, 105, 400).tolist()}
    automata = []
    for lang, s in samples.items():
        go = suffix_automaton(s)
        edges = np.array([(i, c, t) for i, to in enumerate(go) for c, t in sorted(to.items())], dtype="<i4")
        automata.append((lang, len(go), edges.tobytes()))
    parser = CrossParser(automata)
    for _ in range(20):
        text = r.integers(97, 106, r.integers(1, 120))
        got = parser.phrases([parser.classes[text]])[0].tolist()
        assert got == [_phrases(samples[x], text.tolist()) for x in ("a", "b")]


def test_held_out_accuracy(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op6_langid(spark, sf).join(truth, "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_rows(spark, documents):
    known = learn_languages(spark.createDataFrame([("the cat and the dog and the bird", "en"), ("le chat et le chien et la souris", "fr"), (None, "en"), ("text", None)], "text string, lang string"))
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "le chien"), (4, "le chien"), (5, "the dog " * 20_000), (None, "ЖЖЖ")]
    got = {(r.row.doc_id, (r.row.text or "")[:9]): (r.lang_pred, r.score) for r in identify(documents(rows, extra=True), known).collect()}
    assert got[(1, "")] == got[(2, "")] == got[(3, "123 !?")] == ("und", 0.0)
    assert got[(4, "le chien")][0] == "fr" and got[(5, "the dog t")][0] == "en" and got[(None, "ЖЖЖ")][0] == "en"
    assert {r.lang_pred for r in identify(documents(rows), []).collect()} == {"und"}
    assert identify(documents([]), known).count() == 0


def test_letters_beyond_the_table_keep_their_edges():
    r = np.random.default_rng(5)
    samples = {"a": r.integers(97, 123, 600).tolist(), "b": r.integers(0x4E00, 0x4E00 + 400, 900).tolist() * 2, "c": r.integers(0x4E00 + 200, 0x4E00 + 600, 900).tolist() * 2}
    automata = []
    for lang, s in samples.items():
        go = suffix_automaton(s)
        edges = np.array([(i, c, t) for i, to in enumerate(go) for c, t in sorted(to.items())], dtype="<i4")
        automata.append((lang, len(go), edges.tobytes()))
    parser = CrossParser(automata)
    for lang in samples:
        for _ in range(10):
            at = r.integers(0, 500)
            text = np.array([*samples[lang][at : at + 40], *r.integers(97, 123, 3), *r.integers(0x4E00, 0x4E00 + 700, 20), *samples[lang][:30]])
            got = parser.phrases([parser.classes[text], parser.classes[text[:50]]]).tolist()
            assert got == [[_phrases(samples[x], t) for x in samples] for t in (text.tolist(), text[:50].tolist())]
    assert [parser.predict(["".join(map(chr, samples[x][100:300]))])[0][0] for x in samples] == ["a", "b", "c"]


def test_every_labelled_language_has_a_sample(spark):
    r = np.random.default_rng(7)
    word = lambda low: "".join(map(chr, r.integers(97 + low, 97 + low + 5, 5)))
    long = {lang: [" ".join(word(low) for _ in range(2000)) for _ in range(2)] for lang, low in (("a", 0), ("b", 4), ("c", 8), ("d", 12), ("e", 16), ("f", 20))}
    copied, others = "qq " * 60, [" ".join(word(21) for _ in range(20)) for _ in range(2)]
    rows = [(t, lang) for lang, texts in long.items() for t in texts] + [(copied, "copies")] * 3000 + [(t, "copies") for t in others]
    found = learn_languages(spark.createDataFrame(rows, "text string, lang string").repartition(4), sample_chars=500)
    assert [x[0] for x in sorted(found)] == ["a", "b", "c", "copies", "d", "e", "f"]
    letters = {chr(c) for lang, _, e in found if lang == "copies" for c in np.frombuffer(e, dtype="<i4").reshape(-1, 3)[:, 1] if c}
    assert letters == set(copied + " ".join(others)) - {" "}


def _walk(edges, points):
    """Greedy parse of each block of 1,024 code points by the edges alone."""
    n = 0
    for lo in range(0, len(points), 1024):
        state = None
        for c in points[lo : lo + 1024]:
            if state is None or (state, c) not in edges:
                n, state = n + 1, edges.get((0, c))
            else:
                state = edges[(state, c)]
    return n


def test_query_over_the_whole_table(spark):
    """Every prediction against a plain parse with the automata of the query's own learning rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    models = {lang: {(a, b): c for a, b, c in np.frombuffer(e, dtype="<i4").reshape(-1, 3).tolist()} for lang, _, e in learn_languages(docs.where(~held_out))}
    got = {r.doc_id: r for r in op6_langid(spark, SF).collect()}
    rows = docs.withColumn("out", held_out).collect()
    assert len(got) == len(rows)
    for r in rows:
        folded = re.sub("\0+", "\0", "".join(c if c.isalpha() else "\0" for c in (r.text or "").lower()))
        counts = sorted((_walk(e, list(map(ord, folded))), lang) for lang, e in models.items())
        want = (counts[0][1], 1 - counts[0][0] / counts[1][0]) if folded.strip("\0") else ("und", 0.0)
        assert got[r.doc_id].lang_pred == want[0] and abs(got[r.doc_id].score - want[1]) < 1e-9 and got[r.doc_id].held_out == r.out


def test_seven_scripts(spark):
    """Languages of seven scripts, most of whose letters are beyond the table of steps."""
    r = random.Random(11)
    scripts = {"la": (0x61, 26), "el": (0x3B1, 25), "ru": (0x430, 32), "he": (0x5D0, 27), "th": (0xE01, 46), "ko": (0xAC00, 400), "hi": (0x904, 53)}
    known = {k: ["".join(chr(low + r.randrange(n)) for _ in range(r.randint(2, 7))) for _ in range(300)] for k, (low, n) in scripts.items()}
    text = lambda k: " ".join(r.choice(known[k]) for _ in range(r.randint(5, 40)))
    model = learn_languages(spark.createDataFrame([(text(k), k) for k in scripts for _ in range(60)], "text string, lang string"), sample_chars=6000)
    asked = spark.createDataFrame([(text(k), k) for k in scripts for _ in range(20)], "text string, lang string")
    out = identify(asked, model).collect()
    for k in scripts:
        assert sum(x.lang_pred == k for x in out if x.row.lang == k) >= 19, k


def test_the_model_is_bounded(spark, monkeypatch):
    monkeypatch.setattr("quire.llm.langid.MODEL_CHARS", 3000)
    r = random.Random(3)
    rows = [(" ".join("".join(r.choices("abcdefgh"[i % 3 :], k=5)) for _ in range(400)), f"l{i}") for i in range(4)]
    found = learn_languages(spark.createDataFrame(rows, "text string, lang string"))
    assert len(found) == 4 and all(states <= 2 * 750 + 1 for _, states, _ in found)
