"""Media columns: signature sniffing, correction of declared types, and carving.

An Aho-Corasick automaton finds every known signature, and the end records of formats that have
them, in one pass over a value. A validator of the signature's format then walks the structure from
there (chunks, blocks, segments, sizes, checksums) and gives the length of the medium, or nothing if
it breaks off or contradicts itself. A medium at offset 0 decides the value's type; carving gives
the bytes of every medium. Whoever stores a payload behind a preview (``text_to_media``) gets it back
by sniffing and carving alone.

* null: type null, nothing carved. Empty or unknown bytes: ``application/octet-stream``.
* Declared type: kept if it is the found one, else replaced and ``corrected`` is true; a null declared
  type is corrected whenever a type is found.
* Media inside a carved medium aren't carved again: the search goes on behind it. Of signatures at
  one offset the longest that validates wins.
* A PDF ends at the last end mark before the next PDF's start, so later revisions are part of it; an archive
  at the last end record that points back to its start; gzip members that follow one another are one medium.
* Repeated rows return alike. Extra columns travel in ``row``. Empty table: no rows.

Values are scanned whole, row by row: no shuffle, memory of one Arrow batch. End records are looked up among
the automaton's hits, so repeated signatures cost no second scan; only formats that must be walked or inflated
(JPEG scans, gzip, PNG checksums) read a broken medium's bytes once for each signature that starts one.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable
from functools import lru_cache
from typing import Any

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.text import carried
from quire.session import bounded_batches

UNKNOWN = "application/octet-stream"
#: Positions of each signature and end record of a value, ascending, and what validators have found out so far.
Marks = dict[bytes, Any]
Validator = Callable[[bytes, int, Marks], int | None]


def _png(b: bytes, at: int, _: Marks) -> int | None:
    p, first = at + 8, True
    while p + 12 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, p)
        end = p + 12 + n
        if end > len(b) or (first and kind != b"IHDR"):
            return None
        if zlib.crc32(b[p + 4 : end - 4]) != struct.unpack_from(">I", b, end - 4)[0]:
            return None
        p, first = end, False
        if kind == b"IEND":
            return p - at
    return None


def _gif(b: bytes, at: int, _: Marks) -> int | None:
    if at + 13 > len(b):
        return None
    flags = b[at + 10]
    p = at + 13 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0)
    images = 0

    def blocks(p: int) -> int | None:
        while p < len(b):
            if not b[p]:
                return p + 1
            p += 1 + b[p]
        return None

    while p < len(b):
        if b[p] == 0x3B:
            return p + 1 - at if images else None
        if b[p] == 0x21:
            nxt = blocks(p + 2)
        elif b[p] == 0x2C and p + 10 < len(b):
            local = b[p + 9]
            images += 1
            nxt = blocks(p + 11 + (3 << ((local & 7) + 1) if local & 0x80 else 0))
        else:
            return None
        if nxt is None:
            return None
        p = nxt
    return None


def _jpeg(b: bytes, at: int, _: Marks) -> int | None:
    p, scans = at + 2, 0
    while p + 4 <= len(b) and b[p] == 0xFF:
        mark = b[p + 1]
        if mark == 0xD9:
            return p + 2 - at if scans else None
        size = struct.unpack_from(">H", b, p + 2)[0]
        if size < 2:
            return None
        p += 2 + size
        if mark == 0xDA:  # entropy-coded data up to the next segment code that isn't stuffing or a restart
            scans += 1
            while True:
                p = b.find(b"\xff", p)
                if p < 0 or p + 1 >= len(b):
                    return None
                if b[p + 1] == 0 or 0xD0 <= b[p + 1] <= 0xD7:
                    p += 2
                else:
                    break
    return p + 2 - at if p + 2 <= len(b) and b[p : p + 2] == b"\xff\xd9" and scans else None


def _riff(form: bytes) -> Validator:
    def walk(b: bytes, at: int, _: Marks) -> int | None:
        if at + 12 > len(b) or b[at + 8 : at + 12] != form:
            return None
        end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
        p, chunks = at + 12, 0
        if end > len(b):
            return None
        while p + 8 <= end:
            p += 8 + (n := struct.unpack_from("<I", b, p + 4)[0]) + (n & 1)
            chunks += 1
        return end - at if p == end and chunks else None

    return walk


def _bmp(b: bytes, at: int, _: Marks) -> int | None:
    if at + 30 > len(b):
        return None
    size, _, data, header, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", b, at + 2)
    if header < 40 or planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or not 14 + header <= data <= size or at + size > len(b):
        return None
    rows = (width * bits + 31) // 32 * 4 * abs(height)
    return size if width > 0 and data + rows <= size else None


def _pdf(b: bytes, at: int, marks: Marks) -> int | None:
    if at + 8 > len(b) or not b[at + 5 : at + 6].isdigit():
        return None
    starts, ends, tables = (marks.get(k, []) for k in (b"%PDF-", b"%%EOF", b"startxref"))
    after = bisect_left(starts, at + 1)
    last = bisect_left(ends, starts[after] if after < len(starts) else len(b)) - 1
    table = bisect_left(tables, at)
    return ends[last] + 5 - at if last >= 0 and table < len(tables) and at < tables[table] < ends[last] else None


def _gzip_data(b: bytes, at: int, marks: Marks) -> int | None:
    """Where the compressed data of a gzip member starts."""
    if at + 18 > len(b) or b[at + 3] & 0xE0:
        return None
    flags, p = b[at + 3], at + 10
    if flags & 4:
        p += 2 + struct.unpack_from("<H", b, p)[0]
    zeros = marks.get(b"zeros")
    for flag in (8, 16):  # name and comment end with a zero
        if flags & flag:
            if zeros is None:
                zeros = marks[b"zeros"] = np.flatnonzero(np.frombuffer(b, np.uint8) == 0).tolist()
            k = bisect_left(zeros, p)
            if k == len(zeros):
                return None
            p = zeros[k] + 1
    return p + (2 if flags & 2 else 0)


def _inflated(b: bytes, p: int, known: dict[int, int | None]) -> int | None:
    """Where a gzip member ends whose data start at p, if its checksum and length hold."""
    if p not in known:
        known[p] = None
        d, check, size, at = zlib.decompressobj(-15), 0, 0, p
        try:
            while at < len(b) and not d.eof:
                out = d.decompress(b[at : at + (1 << 16)])
                at = min(len(b), at + (1 << 16))
                check, size = zlib.crc32(out, check), size + len(out)
        except zlib.error:
            return None
        end = at - len(d.unused_data)
        if d.eof and end + 8 <= len(b) and struct.unpack_from("<II", b, end) == (check, size & 0xFFFFFFFF):
            known[p] = end + 8
    return known[p]


def _gzip(b: bytes, at: int, marks: Marks) -> int | None:
    known = marks.setdefault(b"inflated", {})
    end = None
    while b.startswith(b"\x1f\x8b\x08", p := at if end is None else end):
        data = _gzip_data(b, p, marks)
        after = _inflated(b, data, known) if data is not None else None
        if after is None:
            break
        end = after
    return None if end is None else end - at


def _zip(b: bytes, at: int, marks: Marks) -> int | None:
    ends = marks.get(b"archives")
    if ends is None:  # where each end record says that its archive starts
        ends = marks[b"archives"] = {}
        for p in marks.get(b"PK\x05\x06", []):
            if p + 22 <= len(b):
                size, start, comment = struct.unpack_from("<IIH", b, p + 12)
                if p + 22 + comment <= len(b):
                    ends[p - start - size] = p + 22 + comment
    return ends[at] - at if at in ends else None


#: Fixed values of the public formats: signature, type, validator.
FORMATS: list[tuple[bytes, str, Validator]] = [
    (b"\x89PNG\r\n\x1a\n", "image/png", _png),
    (b"GIF87a", "image/gif", _gif),
    (b"GIF89a", "image/gif", _gif),
    (b"\xff\xd8\xff", "image/jpeg", _jpeg),
    (b"RIFF", "audio/wav", _riff(b"WAVE")),
    (b"RIFF", "image/webp", _riff(b"WEBP")),
    (b"RIFF", "video/avi", _riff(b"AVI ")),
    (b"BM", "image/bmp", _bmp),
    (b"%PDF-", "application/pdf", _pdf),
    (b"\x1f\x8b\x08", "application/gzip", _gzip),
    (b"PK\x03\x04", "application/zip", _zip),
]


#: End records that validators look up.
ENDS = (b"%%EOF", b"startxref", b"PK\x05\x06")


@lru_cache(maxsize=1)
def _signatures():
    found = ahocorasick.Automaton()
    for sign in {*(s for s, _, _ in FORMATS), *ENDS}:
        found.add_word(sign.decode("latin-1"), (len(sign), sign))
    found.make_automaton()
    return found, {sign: [(kind, check) for s, kind, check in FORMATS if s == sign] for sign, _, _ in FORMATS}


def find_media(b: bytes) -> list[tuple[int, int, str]]:
    """(offset, length, type) of the valid media of a value, none inside another."""
    automaton, formats = _signatures()
    marks: Marks = {}
    hits = []
    for end, (n, sign) in automaton.iter(b.decode("latin-1")):
        marks.setdefault(sign, []).append(end + 1 - n)
        if sign in formats:
            hits.append((end + 1 - n, -n, sign))
    out: list[tuple[int, int, str]] = []
    free = 0
    for at, _, sign in sorted(hits):
        if at < free:
            continue
        for kind, check in formats[sign]:
            if (n := check(b, at, marks)) is not None:
                out.append((at, n, kind))
                free = at + n
                break
    return out


_FOUND = T.ArrayType(T.StructType([T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()), T.StructField("type", T.StringType())]))


@F.pandas_udf(_FOUND)
def _find(s: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else [{"offset": o, "length": n, "type": k} for o, n, k in find_media(b)] for b in s], dtype=object)


def sniff_media(df: DataFrame, media_col: str = "media", declared_col: str = "declared") -> DataFrame:
    """Columns: row, media_type, corrected, found (offset, length and type of every medium)."""
    bounded_batches(df.sparkSession)
    out = carried(df, media=df[media_col], declared=df[declared_col], found=_find(df[media_col]))
    at_start = F.filter("found", lambda x: x["offset"] == 0)
    kind = F.when(F.col("media").isNull(), F.lit(None)).otherwise(F.coalesce(F.get(at_start, F.lit(0))["type"], F.lit(UNKNOWN)))
    return out.select("row", "media", kind.alias("media_type"), (kind.isNotNull() & ~kind.eqNullSafe(F.col("declared"))).alias("corrected"), "found")


def carve_media(sniffed: DataFrame) -> DataFrame:
    """A row for each medium: row, offset, length, type, carved bytes."""
    each = sniffed.select("row", "media", F.explode("found").alias("m"))
    return each.select("row", "m.offset", "m.length", "m.type", F.substring(F.col("media"), (F.col("m.offset") + 1).cast("int"), F.col("m.length").cast("int")).alias("carved"))


def pad_payload(text: str | None, unit: int = 192) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b" " * (max(1, -(-len(raw) // unit)) * unit - len(raw))


def wav_of(samples: bytes, rate: int = 8000) -> bytes:
    """A mono wave file of unsigned 8-bit samples."""
    data = samples + b"\0" * (len(samples) & 1)
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(data), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(samples)) + data


def wav_samples(b: bytes) -> bytes:
    """The samples of a wave file's data chunk."""
    p = 12
    while p + 8 <= len(b):
        kind, n = struct.unpack_from("<4sI", b, p)
        if kind == b"data":
            return b[p + 8 : p + 8 + n]
        p += 8 + n + (n & 1)
    return b""


def png_of(samples: bytes, width: int) -> bytes:
    """A grey image of 8 bits a pixel."""
    rows = b"".join(b"\0" + samples[i : i + width] for i in range(0, len(samples), width))
    chunks = [(b"IHDR", struct.pack(">IIBBBBB", width, len(samples) // width, 8, 0, 0, 0, 0)), (b"IDAT", zlib.compress(rows, 1)), (b"IEND", b"")]
    return b"\x89PNG\r\n\x1a\n" + b"".join(struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d)) for k, d in chunks)


@F.pandas_udf(T.BinaryType())
def _store(s: pd.Series) -> pd.Series:
    payloads = [pad_payload(t) for t in s]
    return pd.Series([png_of(p[:192], 16) + wav_of(p) for p in payloads], dtype=object)


@F.pandas_udf(T.BinaryType())
def _samples(s: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else wav_samples(b) for b in s], dtype=object)


def text_to_media(text: Column) -> Column:
    """Media column: the text's UTF-8 bytes, padded with spaces to a multiple of 192, as 8-bit samples of a
    wave file, behind a preview image of the first 192."""
    bounded_batches()
    return _store(text)


def samples_of(media: Column) -> Column:
    """The samples of a wave file."""
    bounded_batches()
    return _samples(media)
