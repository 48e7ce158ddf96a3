import random

import pandas as pd
import pytest

from quire.llm import minhash
from quire.llm.components import connected_components
from quire.llm.minhash import least_matches, minhash_groups
from quire.session import Scratch


def _shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def _brute(rows, k, percent):
    sets = [(d, _shingles(t, k)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: (len(s), find(d)) for d, s in sets}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_against_all_pairs(spark, documents, k, percent):
    """A large group around one text, whose members are altered too much or too little, and a shared passage."""
    r = random.Random(k)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (5, "two words"), (6, "two words")]
    for i in range(150):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 5, 8, 12])):
            w[r.randrange(len(w))] = word()
        rows.append((1000 - i, " ".join(w)))
    for i in range(80):
        rows.append((2000 + i, " ".join([word() for _ in range(70)] + passage)))
    rows.append((3000, " ".join(word() for _ in range(20_000))))
    want = _brute(rows, k, percent)
    got = minhash_groups(documents(rows, extra=True), k=k, percent=percent).collect()
    assert len(got) == len(rows)
    for g in got:
        assert (g.n_shingles, g.component_id) == want[g.doc_id], g
        assert g.kept == (g.doc_id == g.component_id)


def test_null_ids_and_repeated_rows(documents):
    text = " ".join(map(str, range(40)))
    got = minhash_groups(documents([(None, text), (7, text), (7, text), (9, text.upper())])).collect()
    assert sorted((str(g.doc_id), str(g.component_id), g.kept) for g in got) == [("7", "7", True), ("7", "7", True), ("9", "7", False), ("None", "None", True)]


def test_empty(documents):
    assert minhash_groups(documents([])).count() == 0


def test_posterior_bounds_rise_with_the_threshold():
    low, high = least_matches(0.5, 1e-6), least_matches(0.9, 1e-6)
    assert all(a < b for a, b in zip(low, high, strict=True)) and low == sorted(low)


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 90), (90, 95), (7, 7), (None, 3)]
    df = connected_components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t"))
    got = {r.node: r.component for r in df.collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in (90, 95, 100)} == {90} and len(got) == 64


def test_sketches_leave_no_words_behind():
    """Words remembered while sketching are gone when the task ends, so that a later stage of the same worker has their room."""
    made = list(minhash.sketches(iter([pd.Series(["a b c d", None, ""], dtype=object)]), 3))
    assert made[0]["n"].tolist() == [2, 0, 0]
    assert not minhash._words
