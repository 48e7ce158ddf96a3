import hashlib
import os
import random
import sys

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oracle import SF
from quire.llm.bpe import PairTree, WordBpe, bpe_decode, bpe_encode, bpe_round_trip
from quire.llm.queries import TOKENIZERS, op8_bpe

PATH = os.path.join(TOKENIZERS, "word_bpe_49k.json")
CASES = [None, "", " ", "a", "Σας ΟΔΟΣ", "İstanbul ½ ² Ⅷ", "it's we'll I'D 123", "x" * 5000, "日本語 テキスト", "é <|endoftext|> a<|startoftext|>b", "a\x1cb\x85c", "ab" * 40 + "!!", "the the the"]


def test_against_the_library(spark):
    library = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "id int, text string")
    df = df.select("id", "text", bpe_encode(F.col("text"), PATH).alias("ids")).select("*", bpe_decode(F.col("ids"), PATH).alias("back"))
    for r in df.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(memoryview(bytes(r.ids)).cast("I")) == want, r.text
        assert r.back == library.decode(want, skip_special_tokens=False)


def test_words_alone_and_together():
    bpe = WordBpe(PATH)
    words = [w.encode() for w in ["a", "ab", "abc", "thontiontion", "zzzzzzzz", "aaaaaaaaaaaaaaaaa", "ü", "xyzxyzxyzxyz"]]
    assert bpe.encode_short(words) == [bpe.encode_word(w) for w in words]


@pytest.mark.parametrize("seed", range(20))
def test_random_words_alone_and_together(seed):
    """Both ways of merging give the library's ids, at the border between short and long words as well."""
    r = random.Random(seed)
    words = ["".join(r.choice("aeinorst" + "bcdlmu" * (seed % 2) + "é" * (seed % 3)) for _ in range(r.choice([1, 2, 5, 20, 60, 62, 63, 64, 65, 66, 90]))) for _ in range(60)]
    words = [w for w in words if len(w.encode()) <= 64] or ["a"]
    bpe, library = WordBpe(PATH), Tokenizer.from_file(PATH)
    alone = [bpe.encode_word(w.encode()) for w in words]
    assert bpe.encode_short([w.encode() for w in words]) == alone
    assert [list(memoryview(x).cast("I")) for x in alone] == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_tree_finds_the_leftmost_of_the_lowest():
    tree = PairTree([5, 2, 7, 2, -1])
    assert tree.node[1] == (2 << 32) | 1
    tree.put(1, -1)
    assert tree.node[1] == (2 << 32) | 3


def test_query_over_the_whole_table(spark):
    library = Tokenizer.from_file(PATH)
    rows = {r.doc_id: r for r in op8_bpe(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert rows[r.doc_id].n_tokens == len(ids)
        assert rows[r.doc_id].ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("rows", [[], [(1, "a"), (1, "a")]])
def test_empty_and_repeated(documents, rows):
    out = documents(rows, extra=True).select("doc_id", bpe_encode(F.col("text"), PATH).alias("out")).collect()
    assert len(out) == len(rows) and len({bytes(r.out) for r in out}) <= 1


def test_decoding_loads_tokens_alone(spark):
    """A worker that decodes holds no encoder (its merges and words)."""
    ids = spark.range(1, numPartitions=1).select(F.expr("unhex('0500000006000000')").alias("ids"))
    library = Tokenizer.from_file(PATH)
    made = ids.select(bpe_decode(F.col("ids"), PATH).alias("back")).collect()[0].back
    assert made == library.decode([5, 6], skip_special_tokens=False)
    from quire.llm import bpe

    bpe.tokens_of.cache_clear()
    assert bpe.decode_ids(bytes.fromhex("0500000006000000"), bpe.tokens_of(PATH)) == made and PATH not in WordBpe._open


def test_round_trip_is_encoding_then_decoding(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "id int, text string")
    apart = df.select("id", bpe_encode(F.col("text"), PATH).alias("ids")).select("*", bpe_decode(F.col("ids"), PATH).alias("decoded"))
    assert df.select("id", bpe_round_trip(F.col("text"), PATH).alias("m")).select("id", "m.*").collect() == apart.collect()


def test_round_trip_of_long_and_empty_texts(spark, documents):
    """More than one stretch of a batch comes back in order, a text longer than a stretch is whole."""
    rows = [(0, None), (1, "abc def " * 100_000), (2, ""), *((i, f"text {i} " * 20_000) for i in range(3, 9)), (9, "end")]
    library = Tokenizer.from_file(PATH)
    got = documents(rows).coalesce(1).select("doc_id", bpe_round_trip(F.col("text"), PATH).alias("m")).select("doc_id", "m.*").collect()
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    for (_, text), r in zip(rows, got, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(memoryview(bytes(r.ids)).cast("I")) == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_stretches_are_bounded():
    """Of a large batch, words and results of some half a million code points are held at a time."""
    texts = ["some words of a text " * 5_000] * 20  # 105,000 code points each
    assert [len(x) for x in WordBpe(PATH).encode_stretches(texts)] == [5, 5, 5, 5]
    assert list(WordBpe(PATH).encode_stretches([])) == [] and list(WordBpe(PATH).encode_stretches([None])) == [[b""]]


def test_a_task_takes_one_worker(spark):
    """Encoding and decoding in two Python steps kept two workers a task, which took the executor's memory."""
    assert op8_bpe(spark, SF)._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_remembered_words_are_bounded_in_bytes(monkeypatch):
    """However long its words, a worker remembers some bytes of them; a word that comes again and again is learned once, and ids stay the library's."""
    from quire.llm import bpe as B

    monkeypatch.setattr(B, "MEMO", 1 << 16)
    monkeypatch.setattr(B, "TOGETHER", 10_000)
    bpe, library, learned = WordBpe(PATH), Tokenizer.from_file(PATH), []
    r = random.Random(7)
    letters = lambda n: "".join(r.choices("aeinorstlu", k=n))
    texts = ["again " + " ".join([letters(12) for _ in range(200)] + [letters(300) for _ in range(25)]) for _ in range(60)]
    learn = bpe._learn
    monkeypatch.setattr(bpe, "_learn", lambda chunks: learned.extend(chunks) or learn(chunks))
    most, at = 0, 0
    for ids in bpe.encode_stretches(texts):
        for x in ids:
            assert list(memoryview(x).cast("I")) == library.encode(texts[at], add_special_tokens=False).ids
            at += 1
        most = max(most, sum(sys.getsizeof(k) + sys.getsizeof(v) for t in (bpe.memo, getattr(bpe, "older", {})) for k, v in t.items()))
    assert at == len(texts) and learned.count("again") == 1
    assert most < 3 * (1 << 16)
