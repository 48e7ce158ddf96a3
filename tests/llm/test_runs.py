import random

import numpy as np
import pytest

from quire.llm.runs import COVER, V, CoverSuffixes, _grid, find_runs, periodic_runs


def _runs(words, least):
    """(start, end, period) of all runs, by comparing all places of all periods."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e, q) for (s, e), q in out.items())


def _random(rng):
    n, k = rng.choice([0, 1, 2, 5, 20, 60, 150, 300]), rng.choice([1, 2, 3, 5, 50])
    words = [rng.randrange(k) for _ in range(n)]
    if n and rng.random() < 0.5:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 3))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.3:
            words[rng.randrange(n)] = 99
    return words


@pytest.mark.parametrize("least", [1, 4, 12])
def test_against_brute_force(least):
    rng = random.Random(least)
    for _ in range(80):
        docs = [_random(rng) for _ in range(rng.randint(1, 6))]
        got = find_runs(np.array(sum(docs, []), np.int64), np.array([len(d) for d in docs]), least)
        for d, words in enumerate(docs):
            assert sorted((s, e, q) for x, s, e, q in got.tolist() if x == d) == _runs(words, least)


def test_cover_and_grid():
    assert {(a - b) % V for a in COVER for b in COVER} == set(range(V))
    place, period = _grid(1, 200, 60)
    assert sorted(zip(place.tolist(), period.tolist(), strict=True)) == [(x, q) for x in range(1, 200) for q in range(1, 61) if x % q == 0]
    parts = [_grid(lo, min(lo + 37, 200), 60) for lo in range(1, 200, 37)]
    assert np.concatenate([p[0] for p in parts]).tolist() == place.tolist()


def test_extensions_of_sorted_suffixes():
    rng = random.Random(8)
    words = np.array([rng.randrange(2) for _ in range(700)] + [7, 7] * 150 + [-1 - k for k in range(V + 1)], np.int64)
    suffixes = CoverSuffixes(words)
    at = [i for i in range(len(words) - V) if i % V in COVER]
    pairs = [(i, j) for i, j in (rng.sample(at, 2) for _ in range(3000))]
    got = suffixes.common(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    for (i, j), n in zip(pairs, got.tolist(), strict=True):
        want = 0
        while i + want < len(words) and j + want < len(words) and words[i + want] == words[j + want]:
            want += 1
        assert n == want


def test_documents(documents):
    """Nulls, white space that is none, repeated rows, clashing names, and a text far over the listed grid."""
    rng = random.Random(1)
    long = [f"w{rng.randrange(5000)}" for _ in range(40_000)]
    long[1000:1000] = ["again", "and", "again!"] * 50
    long += ["tail"] * 20_000
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b " * 9), (4, "a b " * 9), (None, "x\x1cy " * 20 + "end"), (5, "\n".join(["one two"] * 6) + "  three"), (6, "a b c d e f a b c d e f"), (7, "a b c d e f a b c d e"), (8, " ".join(long))]
    got = {r.row.doc_id: r for r in periodic_runs(documents(rows, extra=True)).collect()}
    assert len(got) == 9 and all(got[k].n_words == 0 and got[k].runs == [] and got[k].collapsed == "" for k in (1, 2, 3))
    spans = lambda k: [(r.start, r.length, r.period) for r in got[k].runs]
    assert spans(4) == [(0, 18, 2)] and got[4].collapsed == "a b"
    assert spans(None) == [(0, 20, 1)] and got[None].collapsed == "x\x1cy end"
    assert spans(5) == [(0, 12, 2)] and got[5].collapsed == "one two three"
    assert spans(6) == [(0, 12, 6)] and got[6].collapsed == "a b c d e f" and spans(7) == [] and got[7].collapsed == rows[8][1]
    assert (1000, 150, 3) in spans(8) and (40_150, 20_000, 1) in spans(8)
    kept = got[8].collapsed.split()
    assert kept[1000:1003] == ["again", "and", "again!"] and kept[-1] == "tail" and len(kept) == 40_000 + 3 + 1
    assert periodic_runs(documents([])).count() == 0


def test_overlapping_runs_and_ties(documents):
    """Two runs that start at one word, and runs whose dropped words overlap."""
    words = (["a"] * 13 + ["b"]) * 3
    row = periodic_runs(documents([(1, " ".join(words))])).first()
    want = _runs(words, 12)
    assert [(r.start, r.start + r.length, r.period) for r in row.runs] == sorted(want, key=lambda r: (r[0], r[2]))
    gone = {i for s, e, q in want for i in range(s + q, e)}
    assert row.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)
