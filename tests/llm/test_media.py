import gzip
import hashlib
import io
import struct
import time
import wave
import zipfile
import zlib

from oracle import SF
from quire.llm.media import carve_media, find_media, pad_payload, sniff_media, wav_of, wav_samples
from quire.llm.queries import op7_media


def png():
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b"")


GIF = b"GIF89a\x01\x00\x01\x00\x80\x00\x00\x00\x00\x00\xff\xff\xff,\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02D\x01\x00;"
BMP = struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 58, 0, 0, 54, 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + b"\0\0\0\0"
PDF = b"%PDF-1.4\nbody\nstartxref\n0\n%%EOF"
JPEG = b"\xff\xd8\xff\xe0\x00\x04ab" + b"\xff\xda\x00\x02" + b"data\xff\x00more" + b"\xff\xd9"


def zipped():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.txt", "hello")
    return out.getvalue()


def test_formats_alone_embedded_and_broken():
    for kind, data in [("image/png", png()), ("image/gif", GIF), ("image/bmp", BMP), ("application/pdf", PDF), ("image/jpeg", JPEG), ("audio/wav", wav_of(b"abc")), ("application/gzip", gzip.compress(b"x" * 99)), ("application/zip", zipped())]:
        assert find_media(data) == [(0, len(data), kind)], kind
        assert find_media(b"junk" + data + b"tail") == [(4, len(data), kind)], kind
        assert find_media(data[: len(data) * 2 // 3]) == [], kind
    bad = bytearray(png())
    bad[20] ^= 1  # a checksum no longer holds
    assert find_media(bytes(bad)) == []
    assert find_media(b"BM RIFF GIF89a PK\x03\x04 %PDF-") == [] and find_media(b"") == []


def test_sniff_and_carve(spark):
    two = b"--" + png() + b"++" + GIF
    rows = [(1, bytearray(png()), "image/gif"), (2, bytearray(GIF), "image/gif"), (3, bytearray(b"plain"), None), (4, None, "image/png"), (5, bytearray(two), "text/plain"), (5, bytearray(two), "text/plain"), (6, bytearray(b""), None)]
    df = spark.createDataFrame(rows, "id long, media binary, declared string").selectExpr("*", "1 AS found", "2 AS row")
    sniffed = sniff_media(df)
    got = {r.row.id: (r.media_type, r.corrected) for r in sniffed.collect()}
    assert got[1] == ("image/png", True) and got[2] == ("image/gif", False) and got[3] == ("application/octet-stream", True)
    assert got[4] == (None, False) and got[5] == ("application/octet-stream", True)
    carved = sorted((r.row.id, r.offset, bytes(r.carved)) for r in carve_media(sniffed).collect())
    assert carved == [(1, 0, png()), (2, 0, GIF)] + [(5, 2, png())] * 2 + [(5, 4 + len(png()), GIF)] * 2
    assert sniff_media(df.limit(0)).count() == 0


def test_payload_round_trip():
    for t in [None, "", "é", "x" * 192, "y" * 100_001]:
        p = pad_payload(t)
        assert len(p) % 192 == 0 and len(p) > 0 and p.rstrip(b" ") == (t or "").encode().rstrip(b" ")
        assert wav_samples(wav_of(p)) == p
    assert wav_samples(wav_of(b"odd")) == b"odd"


def test_revisions_members_and_nested_archives():
    revised = PDF + b"\nmore\nstartxref\n9\n%%EOF"
    assert find_media(revised + b"\n" + PDF) == [(0, len(revised), "application/pdf"), (len(revised) + 1, len(PDF), "application/pdf")]
    assert find_media(b"%PDF-1.4 no table %%EOF" + PDF) == [(23, len(PDF), "application/pdf")]
    members = gzip.compress(b"one") + gzip.compress(b"two" * 500)
    assert find_media(b"a" + members + b"\x1f\x8b\x08zz") == [(1, len(members), "application/gzip")]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("inner.zip", zipped())
        z.writestr("b.txt", "x")
    assert find_media(b"!" + out.getvalue() + b"?") == [(1, len(out.getvalue()), "application/zip")]


def test_repeated_signatures_are_linear():
    for sign in (b"%PDF-1", b"PK\x03\x04", b"PK\x05\x06", b"RIFF", b"BM", b"GIF89a", b"\xff\xd8\xff", b"\x1f\x8b\x08", b"%%EOF", b"\x89PNG\r\n\x1a\n"):
        began = time.process_time()
        assert find_media(sign * (2_000_000 // len(sign))) == []
        assert time.process_time() - began < 20, sign


def _stored(payload):
    """The stored form by the standard library's writers."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setparams((1, 1, 8000, 0, "NONE", ""))
        w.writeframes(payload)
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    rows = b"".join(b"\0" + payload[i : i + 16] for i in range(0, 192, 16))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 16, 12, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 1)) + chunk(b"IEND", b""), out.getvalue()


def _check(row, text):
    raw = (text or "").encode()
    payload = raw + b" " * (max(1, -(-len(raw) // 192)) * 192 - len(raw))
    image, sound = _stored(payload)
    media = image + sound
    assert (row.n_bytes, row.payload_bytes) == (len(raw), len(payload))
    assert row.payload_sha256 == hashlib.sha256(payload).hexdigest() and row.tail_crc32 == zlib.crc32(payload[-16:])
    assert (row.media_bytes, row.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
    corrected = str(zlib.crc32(media) % 3 != 0).lower()
    return row.feature.startswith(f"image/png;corrected={corrected};image/png:0:{len(image)},audio/wav:{len(image)}:{len(sound)};inside="), row.feature.split("inside=")[1]


def test_query_over_the_whole_table(spark):
    rows = {r.doc_id: r for r in op7_media(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for r in docs:
        assert _check(rows[r.doc_id], r.text) == (True, "")


def test_media_inside_a_text(spark, documents, tmp_path):
    """Texts that hold a medium: it is found among the samples read back, and empty, null and repeated rows return."""
    texts = [None, "", "see " + PDF.decode() + " there", "no media", "no media", "é" * 500]
    documents(list(enumerate(texts))).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op7_media(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [_check(r, t) for r, t in zip(rows, texts, strict=True)] == [(True, f"application/pdf:4:{len(PDF)}" if t and "PDF" in t else "") for t in texts]
