"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The vocabulary file (tokenizers JSON, BPE with word ends) is read on each executor from a path
parameter. A word's symbols are the leaves; each inner node holds the least (rank, position) of
its half, so the root names the leftmost of the lowest-ranked pairs. A merge changes at most three
leaves (the pair, its left and its right neighbour), each a walk to the root. It ends when the
root holds no mergeable pair.

* null text encodes as empty text: no ids, decoded text empty.
* Very long words cost n log n, not n squared. Texts are taken whole, one at a time.
* Of pairs with one rank the leftmost merges first. Repeated rows return alike; an empty table returns no rows; the
  functions are columns, so other columns of a table, whatever their names, have no say.
* Special tokens written in a text become their ids, as the library does by default.
* Words are remembered between texts in two tables of bounded bytes (``MEMO`` each and the words of one stretch): when the newer is full it
  becomes the older, from which words that come again are taken over; words of over ``KEEP`` code points go with their stretch.
  New short words are encoded together, their trees stepping side by side in numpy.
* Of a batch a stretch of texts (``TOGETHER`` code points and what the last text goes beyond them) is held as words at a
  time, and its results are returned before the next. ``bpe_round_trip`` encodes and decodes a stretch in one worker:
  ``bpe_decode`` of ``bpe_encode`` takes two for each task, with a copy of the libraries in each.
"""

from __future__ import annotations

import ctypes
import json
import re
import struct
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import bounded_batches

#: Bytes of a table of words, of which a Python worker has two, and bytes of an entry besides its word and ids; code points of a word to remember.
MEMO, ENTRY, KEEP = 12 << 20, 100, 64
#: Bytes of a word that shares its steps with others, words that do at a time, code points of text between two such runs.
SHORT, LANES, TOGETHER = 64, 8192, 500_000
#: str.split() also splits at these, \s of the pattern doesn't.
_ODD = re.compile("[\x1c-\x1f]")
#: glibc's own; other C libraries have none.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def _byte_chars() -> list[str]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class PairTree:
    """A segment tree of the least (rank, position) over the pairs of one word's symbols."""

    NONE = 1 << 60

    def __init__(self, ranks: list[int]):
        self.size = 1
        while self.size < len(ranks):
            self.size *= 2
        none = self.NONE
        self.node = [none] * self.size + [none if r < 0 else (r << 32) | i for i, r in enumerate(ranks)] + [none] * (self.size - len(ranks))
        for i in range(self.size - 1, 0, -1):
            left, right = self.node[2 * i], self.node[2 * i + 1]
            self.node[i] = left if left < right else right

    def put(self, at: int, rank: int) -> None:
        node, i = self.node, at + self.size
        node[i] = self.NONE if rank < 0 else (rank << 32) | at
        i >>= 1
        while i:
            left, right = node[2 * i], node[2 * i + 1]
            least = left if left < right else right
            if node[i] == least:
                return  # nothing changes above
            node[i] = least
            i >>= 1


class WordBpe:
    """Encoder of one vocabulary file; lives in a Python worker."""

    _open: dict[str, WordBpe] = {}

    @classmethod
    def of(cls, path: str) -> WordBpe:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        v: dict[str, int] = model["vocab"]
        end: str = model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        #: (left id, right id) as one integer -> rank
        self.rank = {(v[a] << 24) | v[b]: rank for rank, (a, b) in enumerate(pairs)}
        order = sorted(self.rank)
        self.pair_key = np.array([*order, 1 << 62], dtype=np.int64)
        self.pair_rank = np.array([*(self.rank[k] for k in order), 0], dtype=np.int64)
        self.merged = np.array([v[a + b] for a, b in pairs], dtype=np.int32)
        chars = _byte_chars()
        self.inner = [v[c] for c in chars]
        self.last = [v[c + end] for c in chars]
        self._inner, self._last = np.array(self.inner, dtype=np.int32), np.array(self.last, dtype=np.int32)
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(pattern)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def encode_word(self, word: bytes) -> bytes:
        """Ids of one pre-token, by its tree."""
        ids, rank = [*(self.inner[b] for b in word[:-1]), self.last[word[-1]]], self.rank
        n = len(ids)
        if n > 1:
            tree = PairTree([rank.get((ids[i] << 24) | ids[i + 1], -1) for i in range(n - 1)])
            before, after = list(range(-1, n - 1)), list(range(1, n + 1))
            while (best := tree.node[1]) < tree.NONE:
                i = best & 0xFFFFFFFF
                j = after[i]
                ids[i] = int(self.merged[best >> 32])
                ids[j] = -1
                k = after[i] = after[j]
                if j < n - 1:
                    tree.put(j, -1)
                if k < n:
                    before[k] = i
                    tree.put(i, rank.get((ids[i] << 24) | ids[k], -1))
                else:
                    tree.put(i, -1)
                p = before[i]
                if p >= 0:
                    tree.put(p, rank.get((ids[p] << 24) | ids[i], -1))
            ids = [x for x in ids if x >= 0]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, -1 for none; a negative id makes no pair."""
        key = (left.astype(np.int64) << 24) | right
        at = np.searchsorted(self.pair_key, np.where((left < 0) | (right < 0), 0, key))
        return np.where(self.pair_key[at] == key, self.pair_rank[at], -1)

    def encode_short(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of at most SHORT bytes: one tree each, all trees a step at a time."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.array([len(w) for w in words])
        size, top = 1, 2
        while top <= SHORT:
            rows = np.flatnonzero((lengths <= top) & (lengths > (top // 2 if top > 2 else 0)))
            for lo in range(0, len(rows), LANES):
                part = rows[lo : lo + LANES]
                for at, ids in zip(part.tolist(), self._lockstep([words[i] for i in part], size, top), strict=True):
                    out[at] = ids
            size, top = top, top * 2
        return out

    def _lockstep(self, words: list[bytes], size: int, width: int) -> list[bytes]:
        """size: leaves of a tree, width: most symbols of a word, at most size + 1 or 2 * size."""
        size = max(size, width)  # a leaf for each pair
        n = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(-1, width)
        column = np.arange(width)
        ids = np.where(column < (n - 1)[:, None], self._inner[raw], np.where(column == (n - 1)[:, None], self._last[raw], -1)).astype(np.int32)
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        none = np.int64(PairTree.NONE)
        node = np.full((len(words), 2 * size), none)
        node[:, size : size + width - 1] = np.where(ranks < 0, none, (ranks << 16) | column[:-1])
        level = size
        while level > 1:
            node[:, level // 2 : level] = np.minimum(node[:, level : 2 * level : 2], node[:, level + 1 : 2 * level : 2])
            level //= 2
        before = np.tile(column - 1, (len(words), 1))
        after = np.tile(column + 1, (len(words), 1))
        live = np.flatnonzero(node[:, 1] < none)
        flat = node.reshape(-1)
        while len(live):
            best = node[live, 1]
            i = best & 0xFFFF
            j = after[live, i]
            k = after[live, j]
            ids[live, i] = new = self.merged[best >> 16]
            ids[live, j] = -1
            after[live, i] = k
            more = k < n[live]
            before[live[more], k[more]] = i[more]
            p = before[live, i]
            prior = p >= 0
            base = live * (2 * size)
            right = np.where(more, self._ranks(new, ids[live, np.minimum(k, width - 1)]), -1)
            left = np.where(prior, self._ranks(ids[live, np.maximum(p, 0)], new), -1)
            leaves = np.concatenate([base + size + j, base + size + i, (base + size + p)[prior]])
            flat[leaves] = np.concatenate([np.full(len(live), none), np.where(right < 0, none, (right << 16) | i), np.where(left < 0, none, (left << 16) | p)[prior]])
            lane = np.concatenate([base, base, base[prior]])
            at = np.concatenate([j, i, p[prior]]) + size
            while at[0] > 1:  # all leaves are on one level
                at >>= 1
                low = lane + 2 * at
                flat[lane + at] = np.minimum(flat[low], flat[low + 1])
            live = live[node[live, 1] < none]
        alive = ids >= 0
        blob = ids[alive].astype("<u4").tobytes()
        ends = (np.cumsum(alive.sum(axis=1)) * 4).tolist()
        return [blob[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _split(self, chunk: str) -> list[str]:
        if chunk.isalpha():
            return [chunk]
        if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.words.findall(chunk)

    def _learn(self, chunks: set[str]) -> Iterator[tuple[str, bytes]]:
        """Chunks with their ids."""
        parts = {c: self._split(c) for c in chunks}
        new = list({w for ws in parts.values() for w in ws})
        raw = [w.encode("utf-8") for w in new]
        short = [i for i, r in enumerate(raw) if len(r) <= SHORT]
        words = {w: b"" if len(r) <= SHORT else self.encode_word(r) for w, r in zip(new, raw, strict=True)}
        words.update(zip([new[i] for i in short], self.encode_short([raw[i] for i in short]), strict=True))
        return ((c, words[ws[0]] if len(ws) == 1 else b"".join([words[w] for w in ws])) for c, ws in parts.items())

    def _known(self, chunks: set[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Tables that hold the ids of all these chunks: the remembered ones, and those that are forgotten behind the stretch."""
        if self.held > MEMO:
            self.older, self.memo, self.held = self.memo, {}, 0
        chunks.difference_update(self.memo)
        again = chunks.intersection(self.older)
        chunks -= again
        once: dict[str, bytes] = {}
        for found in (((c, self.older.pop(c)) for c in again), self._learn(chunks)):
            for c, ids in found:
                if len(c) <= KEEP:
                    self.memo[c] = ids
                    self.held += sys.getsizeof(c) + sys.getsizeof(ids) + ENTRY
                else:
                    once[c] = ids
        return self.memo, once

    def _chunks(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a capital sigma has one lower case here
        text = text.lower()
        return [c for c in regex.split(r"\s+", text) if c] if _ODD.search(text) else text.split()

    def encode_stretches(self, texts: list[str | None]) -> Iterator[list[bytes]]:
        """Ids of each text as little-endian unsigned 32-bit integers, in order, a stretch of texts at a time."""
        held: list[list[list[str] | bytes]] = []
        chars = 0
        for at, text in enumerate(texts, 1):
            parts: list[list[str] | bytes] = []
            if text:
                if self.specials is not None and any(s in text for s in self.special):
                    parts = [struct.pack("<I", self.special[x]) if x in self.special else self._chunks(x) for x in self.specials.split(text)]
                else:
                    parts = [self._chunks(text)]
            held.append(parts)
            chars += len(text or "")
            if chars > TOGETHER or at == len(texts):
                seen: set[str] = set()
                for ps in held:
                    for x in ps:
                        if isinstance(x, list):
                            seen.update(x)
                memo, once = self._known(seen)
                ids_of = (lambda c: memo[c] if len(c) <= KEEP else once[c]) if once else memo.__getitem__
                out = [b"".join([x if isinstance(x, bytes) else b"".join(map(ids_of, x)) for x in ps]) for ps in held]
                held, chars, memo, once = [], 0, {}, {}
                yield out


@lru_cache(maxsize=2)
def tokens_of(path: str) -> dict[int, str]:
    """Tokens by id; a worker that decodes alone holds nothing else of the file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    return {i: t for t, i in {**spec["model"]["vocab"], **{x["content"]: x["id"] for x in spec["added_tokens"]}}.items()}


def decode_ids(ids: bytes, tokens: dict[int, str]) -> str:
    """Tokens with one space between, as a vocabulary without a decoder is decoded."""
    return " ".join([tokens[i] for i in memoryview(ids).cast("I")])


def give_back() -> None:
    """Room that a batch took and that its allocators keep goes back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def bpe_encode(text: Column, path: str) -> Column:
    """Binary column: the ids of each text, little-endian unsigned 32-bit."""

    @F.pandas_udf(T.BinaryType())
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = WordBpe.of(path)
        for s in parts:
            for ids in bpe.encode_stretches(s.tolist()):
                yield pd.Series(ids, dtype=object)
            give_back()

    bounded_batches()
    return encode(text)


def bpe_decode(ids: Column, path: str) -> Column:
    """String column: the decoded text of each binary of ids (null: null)."""

    @F.pandas_udf(T.StringType())
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = tokens_of(path)
        for s in parts:
            yield pd.Series([None if b is None else decode_ids(b, tokens) for b in s], dtype=object)

    bounded_batches()
    return decode(ids)


_ROUND_TRIP = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])


def bpe_round_trip(text: Column, path: str) -> Column:
    """Struct column: ``ids`` as of ``bpe_encode``, and ``decoded``, what ``bpe_decode`` makes of these ids."""

    @F.pandas_udf(_ROUND_TRIP)
    def round_trip(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe, tokens = WordBpe.of(path), tokens_of(path)
        for s in parts:
            for ids in bpe.encode_stretches(s.tolist()):
                yield pd.DataFrame({"ids": ids, "decoded": [decode_ids(b, tokens) for b in ids]}, dtype=object)
            give_back()

    bounded_batches()
    return round_trip(text)
