"""A deterministic sharded WARC writer and its reader.

Writing: payload digests are computed by Spark; of pages with equal payloads of at least
``min_revisit`` bytes the one with the smallest id is the response, others revisit it. Pages are
dealt to ranges of (id, hash of id and digest) whose bounds are quantiles of a sample chosen by a hash of the
row, so the same table gives the same ranges, files and bytes whatever the cluster, and rows of one id, or
without any, spread by their digests. Each range is sorted by id, that hash, digest and URL and written in order; a file is closed once its compressed size reaches ``roll_bytes``.
Headers (lengths, digests, record ids, types, dates) are generated anew; a file opens with a ``warcinfo`` record, and a revisit names the record and URL it refers to. Each record is one gzip
member. Files are committed by renaming, then listed in a manifest, itself a written table.

Reading: files are taken from the manifest, streamed record by record, and digests are recomputed.

* null html: empty payload. null url: no target URI header. null page_id: records come first, id absent;
  they never respond to or revisit others.
* Repeated rows: rows with the smallest id of a group are all responses; the rest revisit that id.
* Payloads under ``min_revisit`` bytes are all responses. Empty table: no files, an empty manifest.
* A very long payload is one record; a task holds one Arrow batch and one compressed record.

Scale: pages are shuffled once, to their key range. What a revisit refers to is found on (id, digest)
rows alone, by an aggregation combined before its shuffle, written, and an equi-join of written tables that adaptive
execution splits at hot digests; these rows then travel to the same key range and sort right before their page. The driver
sees only the sample of keys (``SAMPLE``, or ``KEYS`` for each range: 16 bytes for some 2,000 pages; in expectation half of it); rows that are alike in id, URL and text stay together.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import Scratch, bounded_batches
from quire.sources.store import commit_file, open_input

#: Keys that the sample has at least, and for each range.
SAMPLE, KEYS = 20_000, 4
#: All records carry one date, so that the bytes depend on the pages alone.
DATE = "1970-01-01T00:00:00Z"
_EOL = b"\r\n"


def _name(page_id: str | None, url: str | None, digest: str) -> bytes:
    """A record's id, from what it holds."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}|{digest}')}>".encode()


def _uri(url: str) -> bytes:
    return url.replace("\r", "%0D").replace("\n", "%0A").encode("utf-8", "surrogatepass")


def _info(name: str) -> bytes:
    """The record that opens a file."""
    block = b"software: quire\r\nformat: WARC File Format 1.1\r\n"
    head = [b"WARC/1.1", b"WARC-Type: warcinfo", b"WARC-Record-ID: " + _name(None, name, ""), f"WARC-Date: {DATE}".encode(), f"WARC-Filename: {name}".encode()]
    head += [b"WARC-Block-Digest: sha256:" + hashlib.sha256(block).hexdigest().encode(), b"Content-Type: application/warc-fields", b"Content-Length: %d" % len(block)]
    return _EOL.join(head) + _EOL + _EOL + block + _EOL + _EOL


def _record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: tuple[str, str | None] | None) -> bytes:
    """One uncompressed record; a revisit carries the payload's digest and length but not the payload. ``refers_to``: page id and URL of the response."""
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"), b"WARC-Record-ID: " + _name(page_id, url, digest), f"WARC-Date: {DATE}".encode()]
    if url is not None:
        head.append(b"WARC-Target-URI: " + _uri(url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}".encode())
    head += [f"WARC-Payload-Digest: sha256:{digest}".encode(), f"X-Payload-Length: {len(payload)}".encode()]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is not None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: " + _name(*refers_to, digest), f"WARC-Refers-To-Date: {DATE}".encode()]
        head += [b"WARC-Refers-To-Target-URI: " + _uri(refers_to[1])] if refers_to[1] is not None else []
        head.append(f"X-Refers-To-Page-ID: {refers_to[0]}".encode())
        block = http
    else:
        block = http + payload
    head += [b"WARC-Block-Digest: sha256:" + hashlib.sha256(block).hexdigest().encode(), b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return _EOL.join(head) + _EOL + _EOL + block + _EOL + _EOL


def _member(record: bytes) -> bytes:
    """One gzip member without name or time."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def _writer(folder: str, roll_bytes: int):
    def records(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, int, bytes]]:
        refers: tuple | None = None
        for batch in batches:
            for at, page, url, html, digest, first in batch[["range", "id", "url", "html", "digest", "first"]].itertuples(index=False):
                if html is None:  # a revisit's mark stands before the pages it speaks of
                    refers = (page, digest, (first, url))
                    continue
                to = refers[2] if refers is not None and refers[:2] == (page, digest) else None
                yield at, _member(_record(page, url, html.encode("utf-8", "surrogatepass"), digest, to))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = []
        current, seq, size, n, sha = None, 0, 0, 0, None
        pending: list[bytes] = []
        name = lambda: f"pages-{current:06d}-{seq:05d}.warc.gz"

        def close():
            commit_file(folder, name(), lambda f: [f.write(x) for x in pending])
            made.append((name(), n, size, sha.hexdigest()))

        for at, data in records(batches):
            if current is not None and (at != current or size >= roll_bytes):
                close()
                seq = seq + 1 if at == current else 0
                pending, size, n, sha = [], 0, 0, None
            current = at
            if sha is None:  # a file begins
                sha, info = hashlib.sha256(), _member(_info(name()))
                sha.update(info)
                pending, size = [info], len(info)
            sha.update(data)
            pending.append(data)
            size, n = size + len(data), n + 1
        if n:
            close()
        yield pd.DataFrame(made, columns=["name", "n_records", "n_bytes", "sha256"])

    return write


def _range_of(bounds: list[tuple[int | None, int]]):
    """Number of sorted bounds at or under (id, tie); a null id is under all others."""
    n = len(bounds)
    some = np.array([i is not None for i, _ in bounds], dtype=np.int8)
    ids = np.array([i or 0 for i, _ in bounds], dtype=np.int64)
    ties = np.array([t for _, t in bounds], dtype=np.int64)

    @F.pandas_udf("int")
    def find(there: pd.Series, page: pd.Series, tie: pd.Series) -> pd.Series:
        """Bounds and rows in one order; among equals bounds come first."""
        kind = np.concatenate([np.zeros(n, np.int8), np.ones(len(page), np.int8)])
        order = np.lexsort((kind, np.concatenate([ties, tie.to_numpy(np.int64)]), np.concatenate([ids, page.to_numpy(np.int64)]), np.concatenate([some, there.to_numpy(np.int8)])))
        out = np.empty(len(order), dtype=np.int32)
        out[order] = np.cumsum(order < n)
        return pd.Series(out[n:])

    return find


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = 100, roll_bytes: int = 16 << 20, range_rows: int = 8_000) -> DataFrame:
    """Write the archives; the manifest (name, n_records, n_bytes, sha256) as a written table."""
    spark = pages.sparkSession
    bounded_batches(spark)
    html = F.coalesce(pages[html_col], F.lit(""))
    base = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].alias("url"), html.alias("html"), F.sha2(F.encode(html, "UTF-8"), 256).alias("digest"))
    count = base.count()
    most = max(SAMPLE, KEYS * (count // range_rows))
    rate = max(1, 2 * count // most)
    tie = F.xxhash64("id", "digest")
    sample = base.where(F.pmod(F.xxhash64("id", "digest", "url"), F.lit(rate)) == 0).select("id", tie.alias("tie")).orderBy("id", "tie").limit(most)
    keys = [(r.id, r.tie) for r in sample.collect()]
    wanted = max(1, min(len(keys), -(-count // range_rows)))
    bounds = list(dict.fromkeys(keys[len(keys) * k // wanted] for k in range(1, wanted)))
    ranges = len(bounds) + 1
    key_range = _range_of(bounds)(F.col("id").isNotNull(), F.coalesce("id", F.lit(0)), tie).alias("range")

    light = base.where((F.octet_length("html") >= min_revisit) & F.col("id").isNotNull()).select("id", "digest", "url")
    scratch = Scratch(spark, "warc")
    first = light.groupBy("digest").agg(F.min(F.struct("id", "url")).alias("first"), F.max("id").alias("last")).where(F.col("first.id") < F.col("last"))
    first = first.select("digest", F.col("first.id").alias("first"), F.col("first.url").alias("first_url"))
    first = scratch.keep(first, "first")
    revisits = light.join(first, "digest").where(F.col("id") > F.col("first"))
    marks = revisits.select(key_range, "id", F.col("first_url").alias("url"), F.lit(None).cast("string").alias("html"), "digest", "first")
    rows = base.select(key_range, "id", "url", "html", "digest", F.lit(None).cast("long").alias("first")).unionByName(marks)
    # a mark has no html, so it sorts right before the pages it speaks of
    order = ["range", "id", tie, "digest", F.col("html").isNotNull(), "url"]
    placed = rows.repartitionById(ranges, F.col("range")).sortWithinPartitions(*order)
    placed = placed.select("range", F.col("id").cast("string").alias("id"), "url", "html", "digest", F.col("first").cast("string").alias("first"))
    return scratch.keep(placed.mapInPandas(_writer(folder, roll_bytes), "name string, n_records long, n_bytes long, sha256 string"), "manifest")


class _Members:
    """Reads the decompressed bytes of a file of gzip members."""

    def __init__(self, file):
        self.file, self.z, self.held, self.raw = file, None, bytearray(), b""

    def _more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.file.read(1 << 18)
                if not self.raw:
                    return False
            self.z = self.z or zlib.decompressobj(31)
            got = self.z.decompress(self.raw)
            self.raw = self.z.unused_data if self.z.eof else b""
            if self.z.eof:
                self.z = None
            if got:
                self.held += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.held.find(mark)) < 0:
            if not self._more():
                return None
        out = bytes(self.held[:at])
        del self.held[: at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def parse_warc(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an open file."""
    members = _Members(file)
    while (head := members.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        block = members.take(int(fields["Content-Length"]))
        members.take(4)
        yield fields, block


def _reader(folder: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["name"]:
                rows: list[tuple] = []
                with open_input(folder, name) as file:
                    for h, block in parse_warc(file):
                        if hashlib.sha256(block).hexdigest() != h["WARC-Block-Digest"].removeprefix("sha256:"):
                            raise ValueError(f"{name}: a block's digest differs")
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{name}: a payload's digest differs")
                        rows.append((h.get("X-Page-ID"), h.get("WARC-Target-URI"), kind, int(h["X-Payload-Length"]), digest, h.get("X-Refers-To-Page-ID"), payload if kind == "response" else None))
                        if len(rows) >= 500:
                            yield pd.DataFrame(rows, columns=_READ)
                            rows = []
                yield pd.DataFrame(rows, columns=_READ)

    return read


_READ = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """Records of the files in the manifest; a revisit's payload is null."""
    names = manifest.select("name").repartition(max(1, manifest.count()))
    out = names.mapInPandas(_reader(folder), "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary")
    return out.withColumns({"page_id": F.col("page_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})
