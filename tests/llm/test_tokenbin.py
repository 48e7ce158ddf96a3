import os
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from oracle import SF
from quire.llm.queries import TOKENIZERS, op9_token_file
from quire.llm.simple8b import decode_block, encode_block
from quire.llm.tokenbin import ByteBpe, read_tokens, word_borders, write_tokens
from quire.session import Scratch

PATH = os.path.join(TOKENIZERS, "byte_bpe_50k.json")


@pytest.mark.parametrize("seed", range(25))
def test_block_round_trip(seed):
    r = np.random.default_rng(seed)
    n = int(r.integers(0, 800))
    ids = (r.integers(0, 1 << 62, n, dtype=np.uint64) >> r.integers(0, 62, n).astype(np.uint64)) * (r.random(n) < 0.7).astype(np.uint64)
    if n and seed % 4 == 0:
        ids[:: max(1, n // 5)] = np.uint64(2**64 - 1)  # escapes
    if seed % 5 == 0:
        ids[:] = 0
    words, escapes = encode_block(ids)
    assert (decode_block(words, escapes, n) == ids).all()


def _brute(rows):
    library = Tokenizer.from_file(PATH)
    start, out = 0, []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def test_query_over_the_whole_table(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert sorted(tuple(r) for r in op9_token_file(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == _brute(rows)


@pytest.mark.parametrize("rows", [[], [(2, None), (None, "no id"), (1, ""), (5, " a  b\n\n c<|endoftext|> \x1c x"), (5, " a  b\n\n c<|endoftext|> \x1c x"), (9, "y" * 50_000), (-3, "日本  語 ")]])
def test_awkward_rows(spark, documents, rows):
    folder = Scratch(spark, "t").path("files")
    out = read_tokens(write_tokens(documents(rows, extra=True), folder, PATH, 2), folder)
    got = sorted((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in out.collect())
    want = _brute(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert [(d, s, n, zlib.crc32(b)) for s, d, n, b in got] == want


def test_rolled_files(spark, documents):
    """Files are closed at documents' ends; a document longer than a file and empty ones keep their places."""
    rows = [(i, f"document {i} " * (i % 7) + "tail") for i in range(60)] + [(60, "long words here, " * 9000), (61, None), (62, ""), (63, "end")]
    for roll in ({"roll_ids": 100}, {"roll_docs": 5}, {"roll_ids": 1}):
        folder = Scratch(spark, "t").path("files")
        manifest = write_tokens(documents(rows), folder, PATH, 2, **roll)
        files = manifest.collect()
        assert len(files) > 5 and max(f.seq for f in files) >= 1 and len({f.name for f in files}) == len(files)
        assert sum(f.n_docs for f in files) == len(rows)
        got = sorted((r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in read_tokens(manifest, folder).collect())
        assert got == _brute(rows)


LETTERS = ["a", "B", "é", "ß", "×", "÷", "7", "٣", "日", "ж", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\u3000", "\u0085", "\x1c", "'", "'s", "'LL", ",", "—", "…", "<|endoftext|>", "<|endof", "text|>", "🙂", "e\u0301", "_", "."]


@pytest.mark.parametrize("seed", range(40))
def test_words_against_the_library(seed):
    r = np.random.default_rng(seed)
    texts = ["".join(r.choice(LETTERS, int(r.integers(0, 60)))) for _ in range(80)]
    bpe = ByteBpe(PATH)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t.encode()) for t in texts])
    parts, stops, n = [], [], 0
    for ids, s in bpe.encode_all(data, ends):
        parts.append(ids)
        stops += (s + n).tolist()
        n += len(ids)
    ids = np.concatenate(parts).tolist()
    assert [ids[a:b] for a, b in zip([0, *stops], stops, strict=False)] == [bpe.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_borders():
    text = "ab cd, 12x\u00a0 é. é ×. don't"
    at = np.flatnonzero(word_borders(np.frombuffer(text.encode(), np.uint8)))
    raw = text.encode()
    assert [raw[a:b].decode() for a, b in zip(at, [*at[1:], len(raw)], strict=True)] == ["ab", " cd", ",", " 12", "x\u00a0 é", ".", " é", " ×.", " don", "'t"]
