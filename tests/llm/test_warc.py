import gzip

from quire.llm.warc import parse_warc, read_warc, write_warc
from quire.session import Scratch
from quire.sources.store import open_input, open_store

BIG = "<p>" + "x" * 120 + "</p>"
ROWS = [(5, "http://a", BIG), (3, "http://b", BIG), (9, None, BIG), (1, "u", "tiny"), (2, "u", "tiny"), (7, "é\r\nX: y", None), (None, "n", BIG), (4, "http://c", "z" * 300_000), (3, "http://b", BIG)]
DDL = "page_id long, url string, html string"


def _run(spark, rows, **options):
    folder = Scratch(spark, "t").path("files")
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS id", "2 AS digest", "'q' AS first", "3 AS range")
    manifest = write_warc(df, folder, **options)
    return manifest, folder


def test_awkward_rows(spark):
    manifest, folder = _run(spark, ROWS, roll_bytes=200, range_rows=2)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload is None) for r in read_warc(manifest, folder).collect()), key=str)
    n = len(BIG)
    want = [(1, "response", None, 4, False), (2, "response", None, 4, False), (3, "response", None, n, False), (3, "response", None, n, False), (4, "response", None, 300_000, False), (5, "revisit", 3, n, True), (7, "response", None, 0, False), (9, "revisit", 3, n, True), (None, "response", None, n, False)]
    assert got == sorted(want, key=str)


def test_files_are_the_same_whatever_the_partitions(spark):
    runs = []
    for parts in (1, 7):
        folder = Scratch(spark, "t").path("files")
        df = spark.createDataFrame([r for r in ROWS if r[0] is not None], DDL).repartition(parts)
        manifest = write_warc(df, folder, roll_bytes=200, range_rows=2)
        runs.append(sorted(tuple(r) for r in manifest.collect()))
        store, root = open_store(folder)
        assert sorted(f.base_name for f in store.get_file_info(__import__("pyarrow").fs.FileSelector(root))) == [r[0] for r in runs[-1]]
    assert runs[0] == runs[1] and len(runs[0]) > 2


def test_records_are_gzip_members_of_plain_warc(spark):
    manifest, folder = _run(spark, ROWS[3:4])
    row = manifest.first()
    with open_input(folder, row.name) as f:
        info, text = gzip.decompress(f.read()).split(b"\r\n\r\n\r\n", 1)
    assert info.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and f"WARC-Filename: {row.name}".encode() in info
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"tiny\r\n\r\n")


def test_revisits_name_their_response(spark):
    """WARC-Refers-To is the id of the response with that payload and URL; of several with the least page id that of the least URL."""
    rows = [(3, "http://b", BIG), (3, "http://a", BIG), (5, "http://c", BIG), (6, None, BIG), (8, "u", "w" * 100), (9, "v", "w" * 100), (7, None, "q" * 100), (10, "x", "q" * 100)]
    manifest, folder = _run(spark, rows, range_rows=2)
    heads = []
    for row in manifest.collect():
        with open_input(folder, row.name) as file:
            heads += [h for h, _ in parse_warc(file) if h["WARC-Type"] != "warcinfo"]
    assert len({h["WARC-Record-ID"] for h in heads}) == len(rows)
    ids = {(h["X-Page-ID"], h.get("WARC-Target-URI")): h["WARC-Record-ID"] for h in heads}
    told = {h["X-Page-ID"]: (h["WARC-Refers-To"], h.get("WARC-Refers-To-Target-URI")) for h in heads if h["WARC-Type"] == "revisit"}
    assert told == {"5": (ids[("3", "http://a")], "http://a"), "6": (ids[("3", "http://a")], "http://a"), "9": (ids[("8", "u")], "u"), "10": (ids[("7", None)], None)}


def test_empty(spark):
    manifest, folder = _run(spark, [])
    assert manifest.count() == 0 and read_warc(manifest, folder).count() == 0
