"""Periodic runs of words: maximal stretches with a smallest period q that are at least 2q words long.

Every run of period q has a matching stretch (words equal to the ones q further on) of q words or more, so
it holds a multiple of q: the harmonic grid of the pairs (kq, kq + q), n log n of them in all. Where both words of a pair are
equal, its longest common extension to the right and to the left gives the stretch. Extensions are answered by a
difference cover modulo ``V``: words are compared one after another until both places fall on the cover (under
``V`` steps); behind that the sorted suffixes that start on the cover tell, by a range minimum over their common prefixes.
Only those suffixes are sorted, and only of documents that have a pair whose comparison gets so far.

All of a batch's documents are worked on together in numpy, each closed by a word of its own, so no
extension leaves its document.

* null text: no words, no runs. Repeated rows return alike; an empty table returns no rows.
* Very long texts are worked on whole; their grid is made in slices of ``SLICE`` places, so memory grows with the words
  and not with the pairs.
* Ties: runs of one stretch are one run, with its smallest period; two runs may overlap or start at one word.
* Other columns, whatever their names, come back inside ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quire.llm.text import carried
from quire.session import bounded_batches

#: A perfect difference set: every difference modulo V is one of two members.
V, COVER = 31, (0, 1, 3, 8, 12, 18)
#: Grid pairs are listed once up to this many words; longer documents make theirs in slices of places.
LISTED, SLICE = 1 << 15, 1 << 16
#: Pairs that are extended at a time.
PAIRS = 1 << 20

_IN_COVER = np.isin(np.arange(V), COVER)
#: Words to compare until both places are on the cover, by both places modulo V.
_STEPS = np.array([[next(d for d in range(V) if _IN_COVER[(a + d) % V] and _IN_COVER[(b + d) % V]) for b in range(V)] for a in range(V)], np.int64)


def _grid(lo: int, hi: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Places x from ``lo`` (at least 1) to before ``hi``, each with every period up to ``top`` that divides it, by place."""
    q = np.arange(1, min(top, hi - 1) + 1)
    first = -(-lo // q)
    n = np.maximum((hi - 1) // q - first + 1, 0)
    period = np.repeat(q, n)
    place = (np.arange(len(period)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)) * period
    order = np.argsort(place, kind="stable")
    return place[order], period[order]


class _Listed:
    """The grid of short documents: that of n words is a prefix of it."""

    made: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if cls.made is None:
            place, period = _grid(1, LISTED, LISTED)
            cls.made = place.astype(np.int32), period.astype(np.int32), np.searchsorted(place, np.arange(LISTED + 1))
        place, period, stop = cls.made
        k = stop[n]
        keep = period[:k] <= n // 2
        return place[:k][keep], period[:k][keep]


class CoverSuffixes:
    """Suffixes of a word sequence that start on the cover, in order, with the common prefixes of neighbours.

    ``words`` must hold a closing word of its own for each document, and ``V`` more such words at the end.
    """

    def __init__(self, words: np.ndarray):
        n = len(words) - V
        at = np.concatenate([np.arange(r, n, V) for r in COVER])  # each residue's places follow one another
        self.at, self.slot = at, np.full(n, -1, np.int64)
        self.slot[at] = np.arange(len(at))
        blocks = words[at[:, None] + np.arange(V)]
        keys = np.ascontiguousarray(blocks.astype(">i4")).view(f"V{4 * V}").ravel()
        ranks = [np.unique(keys, return_inverse=True)[1]]
        residue = np.repeat(np.arange(len(COVER)), [len(range(r, n, V)) for r in COVER])
        step = 1
        while ranks[-1].max(initial=0) < len(at) - 1:  # twice as many blocks each time, until all suffixes differ
            ahead = np.minimum(np.arange(len(at)) + step, len(at) - 1)
            inside = (np.arange(len(at)) + step < len(at)) & (residue[ahead] == residue)
            pair = ranks[-1] * (len(at) + 1) + np.where(inside, ranks[-1][ahead] + 1, 0)
            ranks.append(np.unique(pair, return_inverse=True)[1])
            step *= 2
        self.rank = ranks[-1]
        order = np.argsort(self.rank)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(len(at) - 1, 0), np.int64)
        for level in range(len(ranks) - 2, -1, -1):
            same = (a < len(at)) & (b < len(at))
            same[same] = ranks[level][a[same]] == ranks[level][b[same]]
            common += same * (V << level)
            a, b = a + (same << level), b + (same << level)
        here, there = at[np.minimum(order[:-1], len(at) - 1)] + common, at[np.minimum(order[1:], len(at) - 1)] + common
        last = len(words) - 1
        for _ in range(V):  # within the block that differs
            open_ = np.flatnonzero(words[np.minimum(here, last)] == words[np.minimum(there, last)])
            if not len(open_):
                break
            common[open_] += 1
            here[open_] += 1
            there[open_] += 1
        table = [common]
        while 2 << (len(table) - 1) <= len(common):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.table = table

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from two different places on the cover: the least common prefix between their ranks."""
        a, b = self.rank[self.slot[i]], self.rank[self.slot[j]]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            here = level == k
            out[here] = np.minimum(self.table[k][lo[here]], self.table[k][hi[here] - (1 << int(k))])
        return out


class _Extender:
    """Longest common extensions to the right in one sequence of closed documents."""

    def __init__(self, words: np.ndarray, starts: np.ndarray):
        self.words, self.starts = words, starts  # first place of each document, and the end of the last one
        self.suffixes: CoverSuffixes | None = None

    def compare(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal words from i and j on, and which pairs got as far as the cover without a difference."""
        steps = _STEPS[i % V, j % V]
        equal, words = np.zeros(len(i), np.int64), self.words
        going = np.arange(len(i))
        for k in range(V):
            going = going[(steps[going] > k)]
            going = going[words[i[going] + k] == words[j[going] + k]]
            if not len(going):
                break
            equal[going] += 1
        return equal, equal == steps

    def open(self, documents: np.ndarray) -> None:
        """Sort the cover's suffixes of these documents; a place's own modulus is kept."""
        lengths = self.starts[documents + 1] - self.starts[documents]
        room = -(-lengths // V) * V + V  # each document starts at its own place modulo V
        base = np.cumsum(room) - room
        begin = base + self.starts[documents] % V
        words = np.arange(int(room.sum()) + V, dtype=np.int64) * -1 - (1 << 30)  # words of their own
        inside = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
        source = np.repeat(self.starts[documents] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
        words[inside] = self.words[source]
        self.shift = np.zeros(len(self.starts), np.int64)
        self.shift[documents] = begin - self.starts[documents]
        self.suffixes = CoverSuffixes(words)

    def extend(self, document: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        equal, reached = self.compare(i, j)
        far = np.flatnonzero(reached)
        if len(far):
            shift = self.shift[document[far]] + equal[far]
            equal[far] += self.suffixes.common(i[far] + shift, j[far] + shift)
        return equal


def _pairs(words: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of (document, place, period) of the grid pairs whose two words are equal; places count over the batch."""
    held, size = [], 0
    for d, (start, n) in enumerate(zip(starts.tolist(), counts.tolist(), strict=False)):
        if n < 2:
            continue
        slices = [_Listed.upto(n)] if n <= LISTED else (_grid(lo, min(lo + SLICE, n), n // 2) for lo in range(1, n, SLICE))
        for place, period in slices:
            doc = words[start : start + n]
            same = np.flatnonzero(doc[place] == doc[place - period])
            held.append((np.full(len(same), d), place[same].astype(np.int64) + start, period[same].astype(np.int64)))
            size += len(same)
            if size >= PAIRS:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, size = [], 0
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _distinct(found: np.ndarray) -> np.ndarray:
    """Rows (document, start, end, period), one for each stretch, with its smallest period."""
    found = found[np.lexsort(found.T[::-1])]
    return found[np.append(True, (found[1:, :3] != found[:-1, :3]).any(axis=1))] if len(found) else found


def find_runs(codes: np.ndarray, counts: np.ndarray, least: int) -> np.ndarray:
    """Rows (document, start, end, period) of the runs of at least ``least`` words.

    ``codes`` are the documents' words as numbers from 0, one document behind another, ``counts`` how many each has.
    """
    n_docs, total = len(counts), len(codes)
    ends = np.cumsum(counts)
    starts = np.append(ends - counts + np.arange(n_docs), total + n_docs)
    words = np.empty(total + n_docs, np.int64)
    words[np.arange(total) + np.repeat(np.arange(n_docs), counts)] = codes
    words[starts[1:] - 1] = -1 - np.arange(n_docs)
    # the other way round, document by document: a document's last word comes first
    flip = np.repeat(starts[:-1] + starts[1:] - 2, np.diff(starts)) - np.arange(len(words))
    flip[starts[1:] - 1] = starts[1:] - 1
    mirrored = words[flip]
    slack = -(1 << 29) - np.arange(V)
    right, left = _Extender(np.append(words, slack), starts), _Extender(np.append(mirrored, slack), starts)

    def back(document: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The mirrored place of the word before; the closing word for a document's first."""
        first = starts[document]
        return np.where(place == first, starts[document + 1] - 1, first + starts[document + 1] - 1 - place)

    slices, need = [], [np.zeros(n_docs, bool), np.zeros(n_docs, bool)]
    for document, place, period in _pairs(words, starts, counts):
        slices.append((document, place, period))
        for way, extender, i, j in ((0, right, place - period, place), (1, left, back(document, place - period), back(document, place))):
            need[way][document[extender.compare(i, j)[1]]] = True
    for way, extender in ((0, right), (1, left)):
        if need[way].any():
            extender.open(np.flatnonzero(need[way]))
    kept = np.empty((0, 4), np.int64)
    for document, place, period in slices:
        ahead = right.extend(document, place - period, place)
        behind = left.extend(document, back(document, place - period), back(document, place))
        start, end = place - period - behind - starts[document], place + ahead - starts[document]
        run = end - start >= np.maximum(least, 2 * period)
        kept = _distinct(np.concatenate([kept, np.stack([document, start, end, period], axis=1)[run]]))
    return kept


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _runs(least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = pc.ascii_split_whitespace(batch.column("text").fill_null(""))
            flat, doc = lists.flatten(), pc.list_parent_indices(lists)
            real = pc.not_equal(flat, "")
            flat, doc = flat.filter(real), doc.filter(real).to_numpy()
            counts = np.bincount(doc, minlength=batch.num_rows)
            codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
            runs = find_runs(codes, counts, least)
            runs = runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]
            first = np.cumsum(counts) - counts
            # a word goes if a run holds it behind the run's first period
            edge = np.zeros(len(codes) + 1, np.int64)
            np.add.at(edge, first[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
            np.add.at(edge, first[runs[:, 0]] + runs[:, 2], -1)
            keep = np.cumsum(edge[:-1]) == 0
            left = np.append(0, np.cumsum(np.bincount(doc[keep], minlength=batch.num_rows)))
            words = pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat.filter(pa.array(keep)))
            spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (runs[:, 1], runs[:, 2] - runs[:, 1], runs[:, 3])], fields=list(_RUNS.value_type))
            at = np.append(0, np.cumsum(np.bincount(runs[:, 0], minlength=batch.num_rows)))
            columns = {
                "row": batch.column("row"), "n_words": pa.array(counts, pa.int64()),
                "runs": pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans), "collapsed": pc.binary_join(words, " "),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return work


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = 12, carry: list[str] | None = None) -> DataFrame:
    """(row, n_words, runs by start and period, collapsed) of each document.

    Words lie between the white space ``[\\x20\\x09-\\x0D]``. ``collapsed`` keeps the words, joined by one space, that no run
    holds behind its first period.
    """
    bounded_batches(docs.sparkSession)
    rows = carried(docs, carry, text=docs[text_col])
    fields = T.StructType.fromDDL("n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string").fields
    return rows.mapInArrow(_runs(least), T.StructType([rows.schema["row"], *fields]))
