"""Token ids in binary files of Simple-8b blocks, written in ascending document order.

Documents are range-partitioned and sorted by id (ties by text hash); each task encodes its range
with the tokenizers library, appends the end id, packs the ids block by block and commits files by
renaming them; a file is closed once it holds ``ROLL_IDS`` ids or ``ROLL_DOCS`` documents. The manifest
(a row for each file) is a written table: files it doesn't list don't exist.
Readers take files by manifest, unpack block by block with the file's block offsets, and slice
documents by the file's document index. A file's first global position is the running sum over the
manifest, taken within a range and over the ranges.

File: ``S8BTOK02``, blocks (words, then escapes), block table (offset, ids, words, escapes; unsigned
64-bit), document table (id, first id in the file, ids, 1 for a null id; signed 64-bit), then offsets and counts of both.

* null text: an empty document, just the end id. null doc_id: first, read back as null.
* Repeated rows each keep a place; equal rows are ties, whose order makes no difference. Empty table: no files, no rows.
* Texts are taken whole. Extra columns aren't carried.
* A task holds one block of ids (``BLOCK``), one Arrow batch of texts, a file's document table and a word table of bounded size.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from tokenizers import Tokenizer

from quire.llm.simple8b import decode_block, encode_block
from quire.llm.text import utf8_bytes
from quire.session import Scratch, bounded_batches
from quire.sources.store import commit_file, open_input

MAGIC = b"S8BTOK02"
BLOCK = 1 << 14
#: Ids and documents of a file.
ROLL_IDS, ROLL_DOCS = 1 << 24, 1 << 20
#: Entries of a Python worker's word table; longer words aren't kept.
MEMO, KEEP = 500_000, 40
#: Bytes of text that are cut into words at a time.
TOGETHER = 1 << 21
#: Words that the library gets as one text; ids that a reader returns at a time.
JOINED, READ_IDS = 100, 1 << 22

_SPACE, _LETTER, _DIGIT, _OTHER, _HIGH = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[list(b" \t\n\x0b\x0c\r")] = _SPACE
_CLASS[[b for b in range(128) if chr(b).isalpha()]] = _LETTER
_CLASS[list(b"0123456789")] = _DIGIT
_CLASS[list(b"\x1c\x1d\x1e\x1f")] = _HIGH  # white space to some, so never a border
_CLASS[128:] = _HIGH
#: White space beyond ASCII, as it ends in UTF-8.
_WIDE_SPACES = np.array([list(chr(c).encode()[-3:].rjust(3, b"\0")) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)], np.uint8)


def _after_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends right before each position (3 or more) is white space beyond ASCII."""
    last = np.stack([data[at - 3], data[at - 2], data[at - 1]], axis=1)
    out = np.zeros(len(at), bool)
    for space in _WIDE_SPACES:
        out |= (last[:, 2] == space[2]) & (last[:, 1] == space[1]) & ((space[0] == 0) | (last[:, 0] == space[0]))
    return out


def word_borders(data: np.ndarray) -> np.ndarray:
    """Flags of the UTF-8 bytes where a pre-token of a byte-level tokenizer surely starts.

    These are white space behind anything else, and whatever isn't a letter (digit) behind a letter
    (digit), as no pre-token goes on there: words are runs of letters or of digits with a space before
    them at most. Next to characters that bytes alone don't tell, only what is certain counts.
    """
    kind = _CLASS[data]
    before, now = kind[:-1], kind[1:]
    out = np.zeros(len(data), bool)
    out[:1] = True
    border = out[1:]
    border |= (now == _SPACE) & (before != _SPACE) & (before != _HIGH)
    border |= ((before == _LETTER) & (now != _LETTER) & (now != _HIGH)) | ((before == _DIGIT) & (now != _DIGIT) & (now != _HIGH))
    unsure = np.flatnonzero((before == _HIGH) & ((now == _SPACE) | (now == _OTHER))) + 1
    unsure = unsure[(unsure >= 3) & (data[unsure - 1] >= 128)]
    lead, last = data[unsure - 2], data[unsure - 1]
    letter = ((lead == 0xC3) & (last != 0x97) & (last != 0xB7)) | ((lead > 0xC3) & (lead < 0xCA))  # U+00C0 to U+024F but two signs
    out[unsure] = np.where(kind[unsure] == _SPACE, ~_after_wide_space(data, unsure), letter)
    return out


class ByteBpe:
    """The library's encoder behind a table of words: a text's ids are those of its words, one after another."""

    _open: dict[str, ByteBpe] = {}

    @classmethod
    def of(cls, path: str) -> ByteBpe:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.memo: dict[bytes, bytes] = {}
        added = self.library.get_added_tokens_decoder()
        #: texts with one of these go to the library whole
        self.special = [t.content.encode("utf-8") for t in added.values()]
        #: bytes of each token: a character of a byte-level token is a byte, a special token stands for its own text
        special = {i: len(t.content.encode("utf-8")) for i, t in added.items()}
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.sizes[i] = special.get(i, len(token))

    def _ids(self, texts: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.library.encode_batch_fast([t.decode("utf-8") for t in texts], add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each word. Words that start with a space and end otherwise go to the library many at a
        time, as one text, whose ids are dealt out by the bytes that tokens and words have."""
        blob = b"".join(words)
        marked = any(s in blob for s in self.special)
        together = [w[0] == 32 and w[-1] > 32 and not (marked and any(s in w for s in self.special)) for w in words]
        joined = [w for w, j in zip(words, together, strict=True) if j]
        alone = [w for w, j in zip(words, together, strict=True) if not j]
        found = {w: ids.tobytes() for w, ids in zip(alone, self._ids(alone), strict=True)}
        parts = [joined[lo : lo + JOINED] for lo in range(0, len(joined), JOINED)]
        for part, ids in zip(parts, self._ids([b"".join(part) for part in parts]), strict=True):
            ends = (np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(w) for w in part])) * 4 + 4).tolist()
            blob = ids.tobytes()
            found.update(zip(part, [blob[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        return found

    def _encode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that begin at ``starts`` (from 0) in ``data``, and how many each has."""
        offsets = np.append(starts, len(data)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.memo) > MEMO:
            self.memo.clear()
        found = [self.memo.get(w) for w in distinct]
        new = [w for w, ids in zip(distinct, found, strict=True) if ids is None]
        if new:
            learned = self._learn(new)
            found = [learned[w] if ids is None else ids for w, ids in zip(distinct, found, strict=True)]
            self.memo.update((w, ids) for w, ids in learned.items() if len(w) <= KEEP)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(size) - size
        at = words.indices.to_numpy()
        n = size[at]
        ends = np.cumsum(n)
        return np.frombuffer(b"".join(found), "<u4")[np.repeat(first[at] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)], n

    def encode_all(self, data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of texts that lie one behind another in ``data`` and end at ``ends``, a part at a time.

        Each part: the ids, and the positions among them where texts end.
        """
        begins = np.append(0, ends[:-1])
        blob, whole = data.tobytes(), set()
        for s in self.special:
            p = blob.find(s)
            while p >= 0:
                whole.add(doc := int(np.searchsorted(ends, p, side="right")))
                p = blob.find(s, int(ends[doc]))
        del blob
        lo, done = 0, 0
        while done < len(ends):
            size = TOGETHER
            while True:  # a part ends where a word does; a longer word gets a longer part
                hi = min(len(data), lo + size)
                border = word_borders(data[lo:hi])
                border[begins[np.searchsorted(begins, lo) : np.searchsorted(begins, hi)] - lo] = True
                for doc in whole:
                    border[max(begins[doc] + 1 - lo, 0) : max(ends[doc] - lo, 0)] = False
                starts = np.flatnonzero(border) + lo
                if hi == len(data):
                    break
                if len(starts) > 1:
                    hi, starts = int(starts[-1]), starts[:-1]
                    break
                size *= 2
            last = int(np.searchsorted(ends, hi, side="right"))
            ids, n = self._encode(data[lo:hi], starts - lo) if hi > lo else (np.empty(0, "<u4"), np.empty(0, np.int64))
            yield ids, np.append(0, np.cumsum(n))[np.searchsorted(starts, ends[done:last])]
            lo, done = hi, last


class _File:
    """Packs ids into blocks; their table and that of the documents come last."""

    def __init__(self, out):
        self.out, self.offset, self.total, self.begun, self.n_docs = out, len(MAGIC), 0, 0, 0
        self.held: list[np.ndarray] = []
        self.blocks: list[tuple[int, int, int, int]] = []
        self.docs: list[np.ndarray] = []
        out.write(MAGIC)

    def add(self, ids: np.ndarray, stops: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """Ids, and the documents that end among them."""
        if len(stops):
            ends = self.total + stops
            starts = np.append(self.begun, ends[:-1])
            self.docs.append(np.stack([doc, starts, ends - starts, null], axis=1))
            self.begun, self.n_docs = int(ends[-1]), self.n_docs + len(stops)
        self.held.append(ids)
        self.total += len(ids)
        if sum(map(len, self.held)) >= 16 * BLOCK:
            self._flush(BLOCK)

    def _flush(self, least: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        at = 0
        while len(ids) - at >= least:
            block = ids[at : at + BLOCK]
            words, escapes = encode_block(block)
            data = words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes()
            self.out.write(data)
            self.blocks.append((self.offset, len(block), len(words), len(escapes)))
            self.offset, at = self.offset + len(data), at + len(block)
        self.held = [ids[at:]]

    def close(self) -> None:
        self._flush(1)
        self.out.write(np.array(self.blocks, dtype="<u8").tobytes())
        for part in self.docs:
            self.out.write(part.astype("<i8").tobytes())
        self.out.write(struct.pack("<3Q", self.offset, len(self.blocks), self.n_docs))


def _encoded(batches: Iterator[pa.RecordBatch], bpe: ByteBpe, end_id: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Parts of the ids, with the end ids: ids, positions behind the end ids, and the documents they end."""
    for batch in batches:
        if not batch.num_rows:
            continue
        doc = batch.column("id")
        null, doc, done = np.asarray(doc.is_null()).astype(np.int64), doc.fill_null(0).to_numpy(), 0
        for ids, stops in bpe.encode_all(*utf8_bytes(batch.column("text"))):
            here = slice(done, done + len(stops))
            yield np.insert(ids, stops, end_id), stops + np.arange(1, len(stops) + 1), doc[here], null[here]
            done += len(stops)


_MANIFEST = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def _writer(folder: str, path: str, end_id: int, roll_ids: int, roll_docs: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        parts, made = _encoded(batches, ByteBpe.of(path), end_id), []
        ahead = next(parts, None)

        def fill(out) -> None:
            nonlocal ahead
            file = _File(out)
            while ahead is not None:
                ids, stops, doc, null = ahead
                k = min(int(np.searchsorted(stops, roll_ids - file.total)), roll_docs - file.n_docs - 1)
                if k < len(stops):  # full where this document ends
                    file.add(ids[: stops[k]], stops[: k + 1], doc[: k + 1], null[: k + 1])
                    ahead = (ids[stops[k] :], stops[k + 1 :] - stops[k], doc[k + 1 :], null[k + 1 :])
                    if not len(ahead[0]):
                        ahead = next(parts, None)
                    break
                file.add(*ahead)
                ahead = next(parts, None)
            file.close()
            made[-1] |= {"n_docs": file.n_docs, "n_ids": file.total}

        while ahead is not None:
            made.append({"part": part, "seq": len(made), "name": f"tokens-{part:06d}-{len(made):05d}.s8b"})
            commit_file(folder, made[-1]["name"], fill)
        yield pa.RecordBatch.from_pylist(made, schema=_MANIFEST)

    return write


def read_documents(file) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(id, first id in the file, ids) of each document of an open file, in order."""
    size = file.size()
    file.seek(size - 24)
    table, n_blocks, n_docs = struct.unpack("<3Q", file.read(24))
    file.seek(table)
    blocks = np.frombuffer(file.read(32 * n_blocks), dtype="<u8").reshape(-1, 4)
    docs = np.frombuffer(file.read(32 * n_docs), dtype="<i8").reshape(-1, 4)
    held, base, at = np.empty(0, np.uint64), 0, 0
    for doc, start, n, null in docs.tolist():
        parts = [held[start - base :]]
        have = len(parts[0])
        base = start
        while have < n:
            offset, count, n_words, n_escapes = blocks[at].tolist()
            file.seek(offset)
            data = np.frombuffer(file.read(8 * (n_words + n_escapes)), dtype="<u8")
            parts.append(decode_block(data[:n_words], data[n_words:], count))
            have, at = have + count, at + 1
        held = parts[0] if len(parts) == 1 else np.concatenate(parts)
        yield (None if null else doc), start, held[:n]


def _reader(folder: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for base, name in zip(batch["base"], batch["name"], strict=True):
                with open_input(folder, name) as file:
                    rows, held = [], 0
                    for doc, start, ids in read_documents(file):
                        rows.append((doc, base + start, len(ids), ids.astype("<u4").tobytes()))
                        held += len(ids)
                        if len(rows) >= 1000 or held >= READ_IDS:
                            yield _frame(rows)
                            rows, held = [], 0
                    if rows:
                        yield _frame(rows)

    return read


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids"])
    return out.assign(doc_id=out["doc_id"].astype("Int64"))


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", roll_ids: int = ROLL_IDS, roll_docs: int = ROLL_DOCS) -> DataFrame:
    """Write the files; the manifest, with each file's first global position (``base``)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("tie"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    made = ordered.mapInArrow(_writer(folder, path, end_id, roll_ids, roll_docs), "part int, seq int, name string, n_docs long, n_ids long")
    written = Scratch(docs.sparkSession, "tokens").keep(made, "manifest")
    earlier = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = written.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", earlier(W.orderBy("part")).alias("before"))
    inside = written.select("*", earlier(W.partitionBy("part").orderBy("seq")).alias("within"))
    return inside.join(ranges, "part").select("part", "seq", "name", "n_docs", "n_ids", (F.col("before") + F.col("within")).alias("base"))


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian unsigned 32-bit) of every document."""
    parts = manifest.select("base", "name").repartition(max(1, manifest.count()))
    return parts.mapInPandas(_reader(folder), "doc_id long, start long, n_tokens long, ids binary")
