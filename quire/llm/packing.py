"""Best-fit packing of documents into token sequences by a grouping genetic algorithm.

``token_pieces`` encodes texts and cuts those longer than a sequence into pieces. ``pack_pieces`` places pieces:

1. Pieces are dealt at random into blocks of about ``BLOCK``; a block's problem is the list of its lengths.
2. Every block has ``ISLANDS`` islands, rows of a table. An island holds a population of packings, starting with best fit in
   descending and in disturbed orders. A child takes whole well-filled bins of one parent, drops the other parent's bins
   that hold one of those pieces again, and best-fits the displaced pieces. Between epochs each island's elite moves to the next.
3. The best packing over a block's islands places its pieces. Bins filled to within the level's tolerance are settled; the
   pieces of the others are dealt anew, to far fewer blocks, until one block is left or the last level settles all.

A task holds one block, whatever the table's size; only lengths and packings travel between islands.

* null text: as empty, so the end id alone. Repeated rows and pieces of equal length each keep a place of their own, as
  the deal is by random numbers that are written before use.
* Very long texts are cut into full pieces; the last one may be shorter. Empty table: no rows.
* Other columns, whatever their names, come back inside ``row``.
"""

from __future__ import annotations

import json
import os
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from quire.llm.text import carried, utf8_bytes
from quire.session import Scratch, bounded_batches

#: Pieces of a block, islands of a block, packings of an island.
BLOCK, ISLANDS, POPULATION = 4096, 3, 4
#: Rounds of migration, children of an island in each.
EPOCHS, CHILDREN = 2, 6
#: Of a bin's capacity, what may be empty in a settled bin, by level; the last level settles all.
TOLERANCE = (0.0, 1 / 256, 1 / 16, 1.0)
#: Islands of a task.
TOGETHER = 16
#: Entries of a Python worker's word table; longer words aren't kept.
MEMO, KEEP = 500_000, 40
#: Pieces that the library gets as one text.
JOINED = 100

_SPACE, _LETTER, _DIGIT, _SIGN, _UNSURE = range(5)
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[list(b" \t\n\x0b\x0c\r")] = _SPACE
_KIND[[b for b in range(128) if chr(b).isalpha()]] = _LETTER
_KIND[list(b"0123456789")] = _DIGIT
_KIND[128:] = _UNSURE
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


class WordTable:
    """The library's ids behind a table of pre-tokens, for a vocabulary of lower-case words with word ends.

    Texts are cut on bytes where a pre-token surely ends: at white space, around each digit, and between letters and
    other signs. Pieces with characters beyond the Latin letters, apostrophes (short forms) or the signs of special tokens stay
    whole and as they are; all others are one pre-token each, in lower case. A text's ids are those of its pieces, one after another.
    """

    _open: dict[str, WordTable] = {}

    @classmethod
    def of(cls, path: str) -> WordTable:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.memo: dict[bytes, bytes] = {}
        with open(path, encoding="utf-8") as file:
            end = json.load(file)["model"]["end_of_word_suffix"]
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith(end)]] = True
        signs = b"'\x1c\x1d\x1e\x1f" + "".join(t.content for t in self.library.get_added_tokens_decoder().values()).encode("utf-8")
        self.kind = _KIND.copy()
        self.kind[[c for c in signs if self.kind[c] == _SIGN]] = _UNSURE

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes without white space, where pieces start among them, which pieces are unsure, and pieces up to each text's end."""
        data, ends = utf8_bytes(texts)
        kind, low = self.kind[data], _LOWER[data]
        lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC9))  # U+00C0 to U+024F and some more, all letters but three
        first, second = data[lead], data[lead + 1]
        letter = lead[~((first == 0xC3) & ((second == 0x97) | (second == 0xB7))) & ~((first == 0xC4) & (second == 0xB0))]
        kind[letter] = kind[letter + 1] = _LETTER
        capital = lead[(first == 0xC3) & (second < 0x9F) & (second != 0x97)]
        low[capital + 1] += 0x20
        solid = kind != _SPACE
        start = np.zeros(len(data), bool)
        before, now = kind[:-1], kind[1:]
        start[1:] = (before == _SPACE) | ((before != now) & (before != _UNSURE) & (now != _UNSURE)) | ((before == _DIGIT) & (now == _DIGIT))
        start[np.append(0, ends[:-1])[ends > np.append(0, ends[:-1])]] = True
        start &= solid
        data, low, unsure = data[solid], low[solid], (kind == _UNSURE)[solid]
        at = np.flatnonzero(start[solid])
        odd = np.zeros(len(at), bool)
        if len(at):
            odd = np.logical_or.reduceat(unsure, at)
        if odd.any():
            whole = np.repeat(odd, np.diff(np.append(at, len(data))))
            low[whole] = data[whole]
        return low, at, odd, np.append(0, np.cumsum(start))[ends]

    def _learn(self, pieces: list[bytes], odd: list[bool]) -> dict[bytes, bytes]:
        """Ids of each piece. Sure ones go to the library many at a time: a piece's ids end with the first that closes a word."""
        run = lambda texts: [np.array(e.ids, dtype="<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        alone = [p for p, o in zip(pieces, odd, strict=True) if o]
        found = {p: ids.tobytes() for p, ids in zip(alone, run([p.decode("utf-8") for p in alone]), strict=True)}
        sure = [p for p, o in zip(pieces, odd, strict=True) if not o]
        parts = [sure[lo : lo + JOINED] for lo in range(0, len(sure), JOINED)]
        for part, ids in zip(parts, run([b" ".join(p).decode("utf-8") for p in parts]), strict=True):
            ends = (np.flatnonzero(self.closes[ids]) * 4 + 4).tolist()
            blob = ids.tobytes()
            found.update(zip(part, [blob[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind another, and where each text's ids end."""
        data, at, odd, stops = self._pieces(texts)
        offsets = np.append(at, len(data)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        distinct, index = words.dictionary.to_pylist(), words.indices.to_numpy()
        if len(self.memo) > MEMO:
            self.memo.clear()
        found = [self.memo.get(w) for w in distinct]
        new = [k for k, ids in enumerate(found) if ids is None]
        if new:
            marked = np.zeros(len(distinct), bool)
            marked[index[odd]] = True
            learned = self._learn([distinct[k] for k in new], marked[new].tolist())
            for k in new:
                found[k] = learned[distinct[k]]
            self.memo.update((w, ids) for w, ids in learned.items() if len(w) <= KEEP)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(size) - size
        n = size[index]
        ends = np.cumsum(n)
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(first[index] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.append(0, ends)[stops]


def _cut(path: str, end_id: int, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, stops = WordTable.of(path).encode(batch.column("text").fill_null(""))
            ids = np.insert(ids, stops, end_id)
            total = np.diff(stops, prepend=0) + 1
            pieces = (total + capacity - 1) // capacity
            doc = np.repeat(np.arange(len(total)), pieces)
            piece = np.arange(len(doc)) - (np.cumsum(pieces) - pieces)[doc]
            length = np.minimum(total[doc] - piece * capacity, capacity)
            offsets = pa.py_buffer((np.append(0, np.cumsum(length)) * 4).astype(np.int32))
            made = pa.Array.from_buffers(pa.binary(), len(doc), [None, offsets, pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])
            columns = {"row": batch.column("row").take(pa.array(doc)), "piece": pa.array(piece, pa.int32()), "start": pa.array(piece * capacity, pa.int64()), "length": pa.array(length, pa.int64()), "ids": made}
            yield pa.RecordBatch.from_pydict(columns)

    return cut


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(row, piece, start, length, ids as little-endian unsigned 32-bit) of each document's pieces."""
    bounded_batches(docs.sparkSession)
    rows = carried(docs, carry, text=docs[text_col])
    fields = [rows.schema["row"], *T.StructType.fromDDL("piece int, start long, length long, ids binary").fields]
    return rows.mapInArrow(_cut(path, end_id, capacity), T.StructType(fields))


class Block:
    """One block's problem: pieces in descending length; a packing is a list of bins, a bin a list of pieces."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.least = -(-sum(lengths) // capacity)

    def fills(self, bins: list[list[int]]) -> list[int]:
        lengths = self.lengths
        return [sum([lengths[i] for i in b]) for b in bins]

    def worth(self, bins: list[list[int]]) -> tuple[int, int]:
        """Fewer bins first, then fuller ones: the sum of squared fills."""
        return -len(bins), sum(f * f for f in self.fills(bins))

    def best_fit(self, bins: list[list[int]], pieces: list[int]) -> list[list[int]]:
        """Each piece in turn goes to the bin with the least room that takes it, or to a new one.

        Bins are kept by their room; a bit for each room that occurs finds the least one of enough room.
        """
        lengths, capacity = self.lengths, self.capacity
        by_room: dict[int, list[int]] = {}
        mask = 0
        for k, fill in enumerate(self.fills(bins)):
            by_room.setdefault(capacity - fill, []).append(k)
            mask |= 1 << (capacity - fill)
        for i in pieces:
            size = lengths[i]
            above = mask >> size
            if above:
                room = size + (above & -above).bit_length() - 1
                stack = by_room[room]
                k = stack.pop()
                if not stack:
                    mask ^= 1 << room
                bins[k].append(i)
                room -= size
            else:
                k, room = len(bins), capacity - size
                bins.append([i])
            stack = by_room.setdefault(room, [])
            if not stack:
                mask |= 1 << room
            stack.append(k)
        return bins

    def first(self, disturb: float, rng: random.Random) -> list[list[int]]:
        """Best fit in descending order of the lengths, or of lengths disturbed by up to that share."""
        order = range(len(self.lengths))
        return self.best_fit([], sorted(order, key=lambda i: -self.lengths[i] * (1 + disturb * rng.random())) if disturb else list(order))

    def cross(self, giver: list[list[int]], taker: list[list[int]], rng: random.Random) -> list[list[int]]:
        """Whole well-filled bins of the giver, the taker's bins without their pieces, the displaced ones by best fit."""
        fills = self.fills(giver)
        level = sorted(fills)[len(fills) // 2]
        share = rng.uniform(0.05, 0.4)
        child = [list(b) for b, f in zip(giver, fills, strict=True) if f >= level and rng.random() < share]
        given = {i for b in child for i in b}
        displaced = []
        for b in taker:
            if given.isdisjoint(b):
                child.append(list(b))
            else:
                displaced += [i for i in b if i not in given]
        return self.best_fit(child, sorted(displaced))

    def shake(self, bins: list[list[int]], rng: random.Random) -> list[list[int]]:
        """The least filled bins and a few others are emptied; their pieces are fitted again in a disturbed order."""
        fills = self.fills(bins)
        order = sorted(range(len(bins)), key=fills.__getitem__)
        gone = {*order[: 1 + len(bins) // 50], *(rng.randrange(len(bins)) for _ in range(2 + len(bins) // 50))}
        loose = [i for k in gone for i in bins[k]]
        return self.best_fit([b for k, b in enumerate(bins) if k not in gone], sorted(loose, key=lambda i: -self.lengths[i] * (1 + 0.3 * rng.random())))

    def done(self, bins: list[list[int]]) -> bool:
        """No packing has fewer bins, nor its empty places in fewer of them."""
        return len(bins) == self.least and sum(f < self.capacity for f in self.fills(bins)) <= 1

    def evolve(self, population: list[list[list[int]]], children: int, rng: random.Random) -> list[list[list[int]]]:
        """Children replace the worst of the population where they are better."""
        ranked = sorted(((self.worth(p), p) for p in population), key=lambda x: x[0], reverse=True)
        for _ in range(children):
            if self.done(ranked[0][1]):
                break
            giver, taker = rng.sample(ranked, 2)
            child = self.shake(self.cross(giver[1], taker[1], rng), rng)
            made = (self.worth(child), child)
            if made[0] > ranked[-1][0] and all(made[0] != r[0] for r in ranked):
                ranked = sorted([*ranked[:-1], made], key=lambda x: x[0], reverse=True)
        return [p for _, p in ranked]


def _pack(population: list[list[list[int]]], n: int) -> bytes:
    """Packings as the bin number of each piece."""
    out = np.zeros((len(population), n), np.int32)
    for row, bins in zip(out, population, strict=True):
        for k, b in enumerate(bins):
            row[b] = k
    return out.tobytes()


def _unpack(data: bytes, n: int) -> list[list[list[int]]]:
    out = []
    for row in np.frombuffer(data, np.int32).reshape(-1, n).tolist():
        bins: list[list[int]] = [[] for _ in range(max(row) + 1)]
        for i, k in enumerate(row):
            bins[k].append(i)
        out.append(bins)
    return out


_STATE = "block long, island int, lengths array<int>, population binary, best binary, bins int, worth double"


def _island(capacity: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for block, island, lengths, population, elite in zip(*(batch[c] for c in ("block", "island", "lengths", "population", "elite")), strict=True):
                problem, n = Block([int(x) for x in lengths], capacity), len(lengths)
                rng = random.Random(f"{seed}.{block}.{island}")
                if population is None:
                    started = [problem.first(0.0, rng)]
                    if not problem.done(started[0]):
                        started += [problem.first(0.1 * (k + island), rng) for k in range(1, POPULATION)]
                else:
                    started = _unpack(population, n)
                    if elite is not None and len(started) > 1:
                        started = [*started[:-1], *_unpack(elite, n)]
                found = problem.evolve(started, CHILDREN, rng) if len(started) > 1 else started
                bins, worth = problem.worth(found[0])
                rows.append((block, island, lengths, _pack(found, n), _pack(found[:1], n), -bins, float(worth)))
            yield pd.DataFrame(rows, columns=["block", "island", "lengths", "population", "best", "bins", "worth"])

    return run


def _places(capacity: int, slack: int, level: int):
    """Places of a block's pieces under its best packing; full pieces stand alone."""

    def place(items: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("length", ascending=False, kind="stable").reset_index(drop=True)
        full = int((items["length"] == capacity).sum())
        bins = np.frombuffer(best["best"].iloc[0], np.int32) if len(best) else np.empty(0, np.int32)
        bins = np.append(np.arange(full), bins + full)
        order = np.argsort(bins, kind="stable")
        length = items["length"].to_numpy()[order]
        ends = np.cumsum(length)
        begins = ends - length
        first = np.flatnonzero(np.diff(bins[order], prepend=-1))
        runs = np.diff(np.append(first, len(order)))
        offset = np.empty(len(items), np.int64)
        offset[order] = begins - np.repeat(begins[first], runs)
        fill = np.bincount(bins, weights=items["length"])
        sequence = (int(items["block"].iloc[0]) << 24) | (level << 60) | bins.astype(np.int64)
        return items.assign(sequence_id=sequence, offset=offset, settled=fill[bins] >= capacity - slack)[["item", "length", "deal", "sequence_id", "offset", "settled"]]

    return place


def pack_pieces(pieces: DataFrame, capacity: int, length_col: str = "length", seed: int = 7, block_items: int = BLOCK) -> DataFrame:
    """Each row of ``pieces`` (as ``row``) with the sequence it goes to and its offset there.

    Lengths lie between 1 and the capacity; others are an error.
    """
    if not 1 < block_items < 1 << 24:
        raise ValueError("a block holds between 2 and 2**24 pieces")
    spark = pieces.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "packing")
    length = pieces[length_col].cast("int")
    checked = F.when(length.between(1, capacity), length).otherwise(F.raise_error(F.lit("a piece's length lies outside 1 to the capacity")).cast("int"))
    rest = scratch.keep(pieces.select(F.struct(*[pieces[c] for c in pieces.columns]).alias("item"), checked.alias("length"), F.rand(seed).alias("deal")), "dealt")
    placed = []
    for level, tolerance in enumerate(TOLERANCE):
        blocks = max(1, -(-rest.count() // block_items))
        last = blocks == 1 or level == len(TOLERANCE) - 1
        here = F.pmod(F.xxhash64("deal", F.lit(level)), F.lit(blocks))
        items = rest.select("item", "length", "deal", here.alias("block"))
        lengths = items.where(F.col("length") < capacity).groupBy("block").agg(F.sort_array(F.collect_list("length"), asc=False).alias("lengths"))
        state = lengths.select("block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "lengths", F.lit(None).cast("binary").alias("population"), F.lit(None).cast("binary").alias("elite"))
        tasks = -(-blocks * ISLANDS // TOGETHER)  # islands are few rows with much work
        for epoch in range(EPOCHS):
            lived = scratch.keep(state.repartition(tasks, "block", "island").mapInPandas(_island(capacity, seed + 1000 * level + epoch), _STATE), f"islands-{level}-{epoch}")
            moved = lived.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("best").alias("elite"))
            state = lived.select("block", "island", "lengths", "population").join(moved, ["block", "island"])
        best = lived.groupBy("block").agg(F.max_by("best", F.struct(-F.col("bins"), "worth", -F.col("island"))).alias("best"))
        schema = T.StructType([rest.schema["item"], *T.StructType.fromDDL("length int, deal double, sequence_id long, offset long, settled boolean").fields])
        done = scratch.keep(items.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(_places(capacity, capacity if last else int(capacity * tolerance), level), schema), f"places-{level}")
        placed.append(done.where("settled"))
        rest = done.where(~F.col("settled"))
        if last:
            break
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out.select(F.col("item").alias("row"), "sequence_id", "offset")


def join_sequences(packed: DataFrame, ids_col: str = "row.ids") -> DataFrame:
    """(sequence_id, ids) of whole sequences, where the packed rows carry their ids; a sequence is bounded by the capacity."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", F.col(ids_col).alias("ids")))).alias("parts"))
    return parts.select("sequence_id", F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
