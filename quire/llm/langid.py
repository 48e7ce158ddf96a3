"""Language identification by cross-parsing entropy.

Learning: a bounded sample of distinct labelled texts per language (``sample_chars`` code points, chosen by
hash) is folded to letters and single separators, and a suffix automaton of it is built, one Spark
task per language. Predicting: each whole text is folded and cut into blocks of ``BLOCK`` code points; a
block is parsed greedily into the longest phrases that occur in the sample, by walking the automaton
until it has no transition. The language with the fewest phrases per code point wins (each language's
count is over the same code points); ties go to the language name that sorts first.

score = 1 - fewest / second fewest phrases (0 to 1; 1 when one language is known).

* null text or a text without a letter: ``und``, score 0. No labelled text at all: ``und`` for all.
* Predictions read the text alone. Repeated rows return alike. Empty table: no rows.
* Very long texts are many blocks, parsed side by side in bounded groups. Extra columns travel in ``row``.

Scale: what is gathered is bounded by ``MODEL_CHARS`` code points of all languages together (of many languages each
sample is shorter, ``LEAST_CHARS`` at least); scoring is a scan without a shuffle. Which hashes to read is set from a histogram per language over its distinct texts,
64 bins an octave of the hash, so what is read exceeds the aim by a few hundredths or by the least bin. Of more than
``MAX_LANGS`` labels it refuses to learn, and so it does if a labelled language has no sample.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.llm.text import carried
from quire.session import bounded_batches

#: Code points of a block; columns of the table of steps (0 separates, the last is for letters unknown to all samples). Further letters are looked up.
BLOCK, CLASSES = 1024, 64
#: Labels that can be languages; code points of all samples together, and of each at least. A worker's table takes about
#: 400 bytes a code point.
MAX_LANGS, MODEL_CHARS, LEAST_CHARS = 1000, 600_000, 500
#: Code points read for each one of the bound; bin of the hash ``order`` (63 bits): itself under 128, then its upper 7 bits.
FILL = 4
HASH_BIN = "cast(greatest(0, length(bin(order)) - 7) * 64 + shiftrightunsigned(order, greatest(0, length(bin(order)) - 7)) as int)"
#: Blocks parsed side by side.
LANES = 4096


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True at code points that are letters."""
    return np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])


def _points(text: str) -> np.ndarray:
    """Lower-case code points, each run of non-letters as one 0."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    raw = np.where(_letters()[raw], raw, 0)
    keep = np.ones(len(raw), dtype=bool)
    keep[1:] = (raw[1:] != 0) | (raw[:-1] != 0)
    return raw[keep]


def suffix_automaton(sample: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the start."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in sample:
        state = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = state
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return go


def _automaton(key, rows: pd.DataFrame) -> pd.DataFrame:
    """One language's automaton as arrays of (state, code point, next state)."""
    points = [x for t in rows.sort_values("order")["text"] for x in [0, *_points(t).tolist()]][: int(rows["bound"].iloc[0])]
    go = suffix_automaton(points)
    edges = np.array([(s, c, t) for s, to in enumerate(go) for c, t in sorted(to.items())], dtype="<i4").reshape(-1, 3)
    return pd.DataFrame({"lang": [key[0]], "states": [len(go)], "edges": [edges.tobytes()]})


class CrossParser:
    """The automata of all languages as one table of steps, and a sorted list of edges.

    A cell holds the next state and, in its lowest bit, whether this code point starts a phrase. The
    letters with most edges have a column; classes from ``CLASSES`` on are the other letters of
    the samples, whose edges are found by (state, letter). Every edge is in one or the other.
    """

    def __init__(self, automata: list[tuple[str, int, bytes]]):
        automata = sorted(automata)
        self.langs = [a[0] for a in automata]
        edges = [np.frombuffer(a[2], dtype="<i4").reshape(-1, 3) for a in automata]
        seen, counts = np.unique(np.concatenate([e[:, 1] for e in edges]), return_counts=True)
        letters = seen[np.lexsort((seen, -counts))]
        letters = letters[letters != 0]
        common, rare = letters[: CLASSES - 2], letters[CLASSES - 2 :]
        self.rare = len(rare)
        self.classes = np.full(sys.maxunicode + 1, CLASSES - 1, dtype=np.min_scalar_type(CLASSES - 1 + len(rare)))
        self.classes[0] = 0
        self.classes[common] = np.arange(1, len(common) + 1)
        self.classes[rare] = np.arange(CLASSES, CLASSES + len(rare))
        bases = np.cumsum([0, *(a[1] + 1 for a in automata)])  # the last state of each has no transition
        self.first, self.start = bases[:-1], (bases[1:] - 1).tolist()
        self.step = np.empty(int(bases[-1]) * CLASSES, dtype=np.int32)
        keys, to = [], []
        for base, (_, states, _), e in zip(bases.tolist(), automata, edges, strict=False):
            kind = self.classes[e[:, 1]].astype(np.int64)
            near = kind < CLASSES
            first = np.full(CLASSES, (base + states) * 2 + 1, dtype=np.int32)  # an unknown code point is a phrase by itself
            mine = (e[:, 0] == 0) & near
            first[kind[mine]] = (base + e[mine, 2]) * 2 + 1
            step = self.step[base * CLASSES : (base + states + 1) * CLASSES].reshape(states + 1, CLASSES)
            step[:] = first
            step[e[near, 0], kind[near]] = (base + e[near, 2]) * 2
            keys.append((base + e[~near, 0].astype(np.int64)) * self.rare + kind[~near] - CLASSES)
            to.append((base + e[~near, 2]) * 2)
        self.keys, self.to = np.concatenate(keys), np.concatenate(to)
        order = np.argsort(self.keys)
        self.keys, self.to = self.keys[order], self.to[order]

    def _look(self, key: np.ndarray) -> np.ndarray:
        """Cells of the edges of these keys, -1 where there is none."""
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def _rare_steps(self, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Cells for letters without a column: from the state, else from the start, else as unknown."""
        letter = kind.astype(np.int64) - CLASSES
        on = self._look(state.astype(np.int64) * self.rare + letter)
        anew = self._look(self.first[:, None] * self.rare + letter)
        alone = np.array(self.start)[:, None] * 2
        return np.where(on >= 0, on, np.where(anew >= 0, anew, alone) + 1)

    def phrases(self, blocks: list[np.ndarray]) -> np.ndarray:
        """Phrases of each block in each language."""
        k = len(self.langs)
        out = np.zeros((len(blocks), k), dtype=np.int64)
        order = np.argsort([-len(b) for b in blocks], kind="stable")
        for lo in range(0, len(order), LANES):
            part = order[lo : lo + LANES]
            width = len(blocks[part[0]])
            lengths = np.array([len(blocks[i]) for i in part])
            grid = np.zeros((width, len(part)), dtype=self.classes.dtype)
            for lane, i in enumerate(part):
                grid[: lengths[lane], lane] = blocks[i]
            upto = np.searchsorted(-lengths, -np.arange(1, width + 1), side="right")  # lanes that reach each column
            state = np.repeat(np.array(self.start, dtype=np.int32)[:, None], len(part), axis=1) * CLASSES
            count = np.zeros((k, len(part)), dtype=np.int32)
            for column in range(width):
                n = upto[column]
                kind = grid[column, :n]
                far = np.flatnonzero(kind >= CLASSES) if self.rare else ()
                cell = self.step[state[:, :n] + (np.minimum(kind, CLASSES - 1) if len(far) else kind)]
                if len(far):
                    cell[:, far] = self._rare_steps(state[:, far] // CLASSES, kind[far])
                count[:, :n] += cell & 1
                state[:, :n] = (cell >> 1) * CLASSES
            out[part] = count.T
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        blocks: list[np.ndarray] = []
        owner: list[int] = []
        for i, text in enumerate(texts):
            points = _points(text) if text else np.empty(0, dtype=np.uint32)
            if not points.any():
                continue
            kinds = self.classes[points]
            for at in range(0, len(kinds), BLOCK):
                blocks.append(kinds[at : at + BLOCK])
                owner.append(i)
        found: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        if blocks:
            total = np.zeros((len(texts), len(self.langs)), dtype=np.int64)
            np.add.at(total, owner, self.phrases(blocks))
            best = total.argmin(axis=1)
            two = np.sort(total, axis=1)[:, :2]
            for i in set(owner):
                found[i] = (self.langs[best[i]], 1.0 if len(self.langs) == 1 else float(1 - two[i, 0] / two[i, 1]))
        return found


_parsers: dict[bytes, CrossParser] = {}


def learn_languages(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_chars: int = 50_000) -> list[tuple[str, int, bytes]]:
    """The automata (language, states, edges), each of at most ``sample_chars`` code points (fewer where ``MODEL_CHARS`` asks for it).

    The distinct texts of least hash enter that hold ``FILL`` times the bound (a sample is folded, so it
    shrinks), or all there are; never by id. A text counts once however often it is copied.
    """
    rows = labelled.select(labelled[text_col].alias("text"), labelled[lang_col].alias("lang")).where(F.col("lang").isNotNull() & (F.length(F.coalesce(F.col("text"), F.lit(""))) > 0))
    rows = rows.select("lang", F.substring("text", 1, sample_chars).alias("text"), F.shiftrightunsigned(F.xxhash64(F.lit(7), F.col("text")), 1).alias("order"))
    rows = rows.withColumn("b", F.expr(HASH_BIN))
    texts = rows.groupBy("lang", "b", "order").agg(F.max(F.length("text")).alias("chars"))
    bins = texts.groupBy("lang", "b").agg(F.sum("chars").alias("chars"))
    w = Window.partitionBy("lang").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("chars").over(w), F.lit(0))
    cuts = bins.select("lang", "b", before.alias("before")).where(F.col("before") < FILL * sample_chars).groupBy("lang").agg(F.max("b").alias("cut"))
    known = cuts.limit(MAX_LANGS + 1).collect()
    if len(known) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} labels: these are no languages")
    cut = F.broadcast(labelled.sparkSession.createDataFrame(known, "lang string, cut int"))  # MAX_LANGS rows at most
    part = rows.join(cut, "lang").where(F.col("b") <= F.col("cut")).groupBy("lang", "order").agg(F.max("text").alias("text"))
    bound = min(sample_chars, max(LEAST_CHARS, MODEL_CHARS // max(1, len(known))))
    built = part.withColumn("bound", F.lit(bound)).groupBy("lang").applyInPandas(_automaton, "lang string, states int, edges binary").collect()
    if lost := {r.lang for r in known} - {r.lang for r in built}:
        raise ValueError(f"no sample of {sorted(lost)}")
    return [(r.lang, r.states, bytes(r.edges)) for r in built]


def identify(docs: DataFrame, automata: list[tuple[str, int, bytes]], text_col: str = "text") -> DataFrame:
    """Columns: row, lang_pred, score."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(automata)

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = sent.value
        if not known:
            for s in parts:
                yield pd.DataFrame({"lang_pred": ["und"] * len(s), "score": [0.0] * len(s)})
            return
        model = hashlib.blake2b()
        for lang, _, edges in known:
            model.update(lang.encode() + b"\0" + len(edges).to_bytes(8) + edges)
        key = model.digest()
        if key not in _parsers:
            _parsers.clear()
            _parsers[key] = CrossParser(known)
        parser = _parsers[key]
        for s in parts:
            texts = s.tolist()
            found: list[tuple[str, float]] = []
            held: list[str | None] = []
            chars = 0
            for t in texts:
                held.append(t)
                chars += len(t or "")
                if chars > LANES * BLOCK:
                    found += parser.predict(held)
                    held, chars = [], 0
            found += parser.predict(held) if held else []
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    m: Column = predict(docs[text_col])
    return carried(docs, m=m).select("row", "m.lang_pred", "m.score")
