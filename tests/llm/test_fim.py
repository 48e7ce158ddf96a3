import hashlib
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from quire.llm.fim import fill_in_middle, frame_texts, output_digests, output_text, restore_text

SPECIAL = ["<P>", "a<S>b", "x\n<M>\n"]


def _plan(doc, text, rate, spm):
    """Form, output, prefix and middle by cutting lists of lines."""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("size,rate,spm", [(1 << 16, 100, 50), (5, 60, 0), (64, 100, 100)])
def test_against_lists_of_lines(documents, size, rate, spm):
    """Frames of a few bytes cut everywhere: inside lines, between newlines, at characters of several bytes."""
    texts = [None, "", "\n", "\n\n\n", "no newline", "ends\n", "a\nb\nc", "日本\n語é😀\n" * 9, "<" * 30 + "\n" + ">S><P" * 5, *SPECIAL, "x" * 300_000 + "\n" + "y" * 100_000, "line\n" * 40_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null\nid\n"), (5, "ends\n"), (100 + len(texts), "many\nlines\nhere\n")] + [(i, f"row {i}\nsecond\n\nthird") for i in range(1000, 1030)]
    framed = frame_texts(documents(rows, extra=True), size=size)
    out = fill_in_middle(framed, rate=rate, spm=spm)
    out = out.select("*", output_digests(F.col("output"), F.col("form")).alias("d"), output_text(F.col("output")).alias("text"), restore_text(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(out) == len(rows)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in out:
        text = r.row.text or ""
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.text) == _plan(r.row.doc_id, text, rate, spm)
        assert r.back == text and r.d.output_sha256 == digest(r.text) and r.d.restored_sha256 == digest(text)
        if r.text:
            with zstandard.ZstdDecompressor().stream_reader(bytes(r.output), read_across_frames=True) as reader:
                assert reader.read() == r.text.encode()


def test_frames_are_bounded_and_counted(documents):
    text = "é\n" * 1000
    row = frame_texts(documents([(1, text)]), size=101).first()
    parts = [zstandard.ZstdDecompressor().decompress(bytes(f.data)).decode() for f in row.frames]
    assert "".join(parts) == text and max(len(p.encode()) for p in parts) <= 101 and row.n == 1000
    assert [(f.newlines, f.chars) for f in row.frames] == [("".join(parts[: k + 1]).count("\n"), len("".join(parts[: k + 1]))) for k in range(len(parts))]
    assert fill_in_middle(frame_texts(documents([]))).count() == 0
    with pytest.raises(ValueError):
        frame_texts(documents([]), size=3)
