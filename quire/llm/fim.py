"""Fill-in-the-middle documents from seekable compressed frames.

``frame_texts`` stores each text as independent zstandard frames of ``FRAME`` bytes, every one with the
newlines and code points up to its end. ``fill_in_middle`` finds the frames that hold the two cuts by
those running counts and opens no others: an output is made of sentinel frames, untouched frames and the
two ends of each opened one, so that it is again a valid row of frames, one behind another. Digests and
restored texts read the output's frames as a stream, a chunk at a time.

A text's units are its lines (each with its newline). With n units, a hash of the seed and the id
gives cuts a and b among 0..n: the prefix ends after the smaller, the middle after the larger. Forms: ``psm``
``<P>prefix<S>suffix<M>middle``, ``spm`` ``<S>suffix<P>prefix<M>middle``, ``plain`` the text itself.

* null text: as empty. Empty texts and those that hold a sentinel themselves are plain.
* null id: hashed as the empty string. Repeated rows give equal outputs; ties don't occur. Empty table: no rows.
* A text of any length is cut at code points, whether it has newlines or not; a task holds one batch of texts.
* Other columns, whatever their names, come back inside ``row``.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.text import carried
from quire.session import bounded_batches

#: Bytes of text in a frame, and of a chunk that is read at a time.
FRAME, CHUNK = 1 << 16, 1 << 16
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Sentinels of each form in their order, and which of the three parts behind them are prefix, middle and suffix.
MARKS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PARTS = {"psm": (0, 2, 1), "spm": (1, 2, 0)}
FRAMES = "array<struct<data: binary, newlines: bigint, chars: bigint>>"

_press, _open = zstandard.ZstdCompressor(level=3, write_content_size=True), zstandard.ZstdDecompressor()


def _chars(data: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(data) - int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))


def _frames(data: bytes, size: int) -> list[tuple[bytes, int, int]]:
    """Frames of at most ``size`` bytes that end at code points, with newlines and code points up to each end."""
    out, at, newlines, chars = [], 0, 0, 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        part = data[at:end]
        newlines, chars, at = newlines + part.count(b"\n"), chars + _chars(part), end
        out.append((_press.compress(part), newlines, chars))
    return out


def frame_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, size: int = FRAME) -> DataFrame:
    """(row, id as text, n units, frames, whether a sentinel occurs) of each document."""
    if size < 4:
        raise ValueError("a frame holds at least one code point")
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(FRAMES)
    def framed(texts: pd.Series) -> pd.Series:
        return pd.Series([_frames(t.encode("utf-8"), size) for t in texts])

    text = F.coalesce(docs[text_col], F.lit(""))
    n = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + ((text != "") & ~F.endswith(text, F.lit("\n"))).cast("int")
    marked = F.contains(text, F.lit("<P>")) | F.contains(text, F.lit("<S>")) | F.contains(text, F.lit("<M>"))
    return carried(docs, carry, id=F.coalesce(docs[id_col].cast("string"), F.lit("")), n=n.cast("long"), frames=framed(text), marked=marked)


class _Text:
    """A text's frames; a cut opens the one frame that it lies in."""

    def __init__(self, frames: list):
        self.frames = [(f["data"], f["newlines"], f["chars"]) for f in frames]
        self._newlines = [f[1] for f in self.frames]

    def cut(self, units: int, n: int) -> tuple[int, int, int]:
        """(frame, byte inside it, code points before it) where the unit count is reached."""
        if units == 0:
            return 0, 0, 0
        if units == n:
            return len(self.frames), 0, self.frames[-1][2]
        at = bisect_left(self._newlines, units)
        before, chars = self.frames[at - 1][1:] if at else (0, 0)
        data, end = _open.decompress(self.frames[at][0]), 0
        for _ in range(units - before):
            end = data.index(b"\n", end) + 1
        return at, end, chars + _chars(data[:end])

    def between(self, a: tuple[int, int, int], b: tuple[int, int, int]) -> list[bytes]:
        """Frames of the text from one cut to the next; whole ones are taken over as they are."""
        (i, lo, _), (j, hi, _) = a, b
        if i == j:
            part = _open.decompress(self.frames[i][0])[lo:hi] if lo < hi else b""
            return [_press.compress(part)] if part else []
        out = [_press.compress(_open.decompress(self.frames[i][0])[lo:]) if lo else self.frames[i][0]]
        out += [f[0] for f in self.frames[i + 1 : j]]
        return out + ([_press.compress(_open.decompress(self.frames[j][0])[:hi])] if hi else [])


def _transform(frames: pd.Series, form: pd.Series, n: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
    rows = []
    for parts, kind, units, a, b in zip(frames, form, n, first, second, strict=True):
        text = _Text(parts)
        if kind == "plain":
            rows.append((b"".join(f[0] for f in text.frames), None, None))
            continue
        start, end = (0, 0, 0), (len(text.frames), 0, text.frames[-1][2])
        one, two = text.cut(a, units), text.cut(b, units)
        prefix, middle, suffix = text.between(start, one), text.between(one, two), text.between(two, end)
        given = [prefix, suffix, middle] if kind == "psm" else [suffix, prefix, middle]
        rows.append((b"".join(x for mark, part in zip(MARKS[kind], given, strict=True) for x in (_press.compress(mark), *part)), one[2], two[2] - one[2]))
    out = pd.DataFrame(rows, columns=["output", "prefix_chars", "middle_chars"])
    return out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})


def fill_in_middle(framed: DataFrame, seed: str = "7", rate: int = 100, spm: int = 50) -> DataFrame:
    """(row, n, form, prefix_chars, middle_chars, output) of ``frame_texts``; ``output`` is a zstandard stream of frames.

    ``rate`` percent of the documents are transformed, ``spm`` percent of those with the suffix first.
    """
    hashed = framed.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), "id"), 256))
    h = [F.conv(F.substring("h", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    plain = (F.col("n") == 0) | F.col("marked") | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    a, b = h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)
    planned = hashed.select("row", "n", "frames", form.alias("form"), F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    return planned.select("row", "n", "form", F.pandas_udf(_transform, "output binary, prefix_chars long, middle_chars long")("frames", "form", "n", "a", "b").alias("made")).select("row", "n", "form", "made.prefix_chars", "made.middle_chars", "made.output")


def _stream(output: bytes) -> Iterator[bytes]:
    """The output's bytes a chunk at a time, over all its frames in order."""
    if output:
        with _open.stream_reader(output, read_across_frames=True) as reader:
            while chunk := reader.read(CHUNK):
                yield chunk


def _part(output: bytes, marks: tuple[bytes, ...], wanted: int) -> Iterator[bytes]:
    """The bytes behind sentinel number ``wanted`` and before the next one."""
    at, held = -1, b""
    for chunk in _stream(output):
        held += chunk
        while at < wanted:
            found = held.find(marks[at + 1])
            if found < 0:
                held = held[-2:]  # the start of a sentinel at most
                break
            at, held = at + 1, held[found + 3 :]
        if at < wanted:
            continue
        found = held.find(marks[at + 1]) if at + 1 < len(marks) else -1
        if found >= 0:
            yield held[:found]
            return
        keep = 2 if at + 1 < len(marks) else 0
        yield held[: len(held) - keep]
        held = held[len(held) - keep :]
    yield held if at == wanted else b""


def _restored(output: bytes, form: str) -> Iterator[bytes]:
    """The text, from output and form alone: the sentinels are found in the stream."""
    if form == "plain":
        yield from _stream(output)
    else:
        for wanted in PARTS[form]:
            yield from _part(output, MARKS[form], wanted)


def _sha256(chunks: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for chunk in chunks:
        digest.update(chunk)
    return digest.hexdigest()


def _digests(output: pd.Series, form: pd.Series) -> pd.DataFrame:
    rows = [(_sha256(_stream(o)), _sha256(_restored(o, f))) for o, f in zip(output, form, strict=True)]
    return pd.DataFrame(rows, columns=["output_sha256", "restored_sha256"])


def _text(output: pd.Series) -> pd.Series:
    return pd.Series([b"".join(_stream(o)).decode("utf-8") for o in output], dtype=object)


def _original(output: pd.Series, form: pd.Series) -> pd.Series:
    return pd.Series([b"".join(_restored(o, f)).decode("utf-8") for o, f in zip(output, form, strict=True)], dtype=object)


def output_digests(output: Column, form: Column) -> Column:
    """Struct of the SHA-256 of the output and of the text restored from it, each streamed frame by frame."""
    return F.pandas_udf(_digests, "output_sha256 string, restored_sha256 string")(output, form)


def output_text(output: Column) -> Column:
    """The output as a string."""
    return F.pandas_udf(_text, "string")(output)


def restore_text(output: Column, form: Column) -> Column:
    """The original text, from output and form."""
    return F.pandas_udf(_original, "string")(output, form)
