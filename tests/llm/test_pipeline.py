"""The pipeline's stages against brute-force versions on the small table, each on its own input."""

import hashlib
import os

from tokenizers import Tokenizer

import corpus_pipeline as cp
from oracle import SF
from quire.llm.queries import TOKENIZERS
from test_minhash import _brute
from test_quality import _brute as _measures
from test_quality import _limit

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


RULES = {"symbols": 100, "lines": 500, "repeats": 300}


def _rated(docs):
    """Ids that the rules keep: 5 words, no more than half of them in repeated windows, no rate over its group's limit."""
    seen = []
    for r in docs.values():
        n_words, _, n_symbols, n_dup, n_repeat = _measures(r.text)
        lines = sum(1 for x in (r.text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r"))
        rates = dict(zip(RULES, (1000 * a // b if b else 0 for a, b in ((n_symbols, n_words), (n_dup, lines), (n_repeat, n_words))), strict=True))
        seen.append((r, rates, n_words >= cp.MIN_WORDS and 2 * n_repeat <= n_words))
    kept = set()
    for r, rates, ok in seen:
        for k, fixed in RULES.items():
            limit = None
            for same in (lambda d: True, lambda d: d.lang == r.lang, lambda d: (d.lang, d.source) == (r.lang, r.source)):  # noqa: B023
                n, mine = _limit([(d[1][k], d[2]) for d in seen if same(d[0])], fixed)
                limit = mine if limit is None else min(limit, mine) if n >= 100 else limit
            ok = ok and rates[k] <= limit
        if ok:
            kept.add(r.doc_id)
    return kept


def _lined(docs):
    """Texts without the lines of ten documents or more."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    where = {}
    for i, r in docs.items():
        for line in (r.text or "").split("\n"):
            where.setdefault(key(line), set()).add(i)
    gone = {k for k, ids in where.items() if k and len(ids) >= 10}
    return {i: "\n".join(x for x in (r.text or "").split("\n") if key(x) not in gone) for i, r in docs.items()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = [docs.cache()]
    for _, stage in cp.STAGES[:-1]:
        seen.append(stage(spark, seen[-1], SF).cache())
        assert seen[-1].columns == COLUMNS
    raw, rated, lined, single, mixed = ({r.doc_id: r for r in d.collect()} for d in seen)
    good = [d for d, r in labels.items() if r.quality == 1]
    bad = [d for d, r in labels.items() if r.quality == 0]
    assert sum(d in rated for d in good) / len(good) > 0.95 and sum(d in rated for d in bad) / len(bad) < 0.1
    assert set(rated) == _rated(raw) and all(rated[d] == raw[d] for d in rated)
    assert {d: r.text for d, r in lined.items()} == _lined(rated)
    assert all(r.n_chars == len(r.text) for r in lined.values())
    want = _brute([(r.doc_id, r.text) for r in lined.values()], 5, 80)
    assert set(single) == {d for d, (_, c) in want.items() if c == d}
    assert all(single[d] == lined[d] for d in single)
    assert set(mixed) <= set(single)
    toxic = [d for d in single if d in labels and labels[d].toxic == 1]
    clean = [d for d in single if d in labels and labels[d].toxic == 0 and labels[d].quality == 1]
    assert sum(d in mixed for d in clean) / len(clean) > 0.97 and sum(d in mixed for d in toxic) <= len(toxic) / 4
    library = Tokenizer.from_file(os.path.join(TOKENIZERS, "word_bpe_49k.json"))
    for r in cp.STAGES[-1][1](spark, seen[-1], SF).collect():
        ids = library.encode(mixed[r.doc_id].text, add_special_tokens=False).ids
        assert list(memoryview(bytes(r.ids)).cast("I")) == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_is_the_chain_of_stages(spark):
    out = cp.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and out.count() > 50


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs_out = stage(spark, docs, SF)
        assert docs_out.count() == 0


def test_lines_keep_every_row(spark, documents):
    copies = [(i, "a clean text\nof two lines") for i in range(12)]
    docs = documents([*copies, (20, "a clean text\nand one of its own"), (21, ""), (22, None)])
    got = {r.doc_id: (r.text, r.n_chars) for r in cp.stage_lines(spark, docs, SF).collect()}
    assert got == {**{i: ("", 0) for i, _ in copies}, 20: ("and one of its own", 18), 21: ("", 0), 22: ("", 0)}


def test_bpe_takes_one_worker_a_task(spark):
    """Two Python steps keep two workers for each task, which took the executor beyond its memory."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert cp.STAGES[-1][1](spark, docs, SF)._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
