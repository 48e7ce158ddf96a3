import os
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oracle import SF
from quire.llm.packing import Block, WordTable, join_sequences, pack_pieces, token_pieces
from quire.llm.queries import TOKENIZERS, op12_packing

PATH = os.path.join(TOKENIZERS, "word_bpe_49k.json")
ODD = ["", "  a  b\x1cc <|endoftext|> d", "É́cole ÎΣ ΑΣ Σ x y z 'S it's", "a<|startoftext|>b c", "́ x", " \n", "ǅ İstanbul ﬁ", "<|ENDOFTEXT|>", "A9B!!c 12'34 a'S'T", "\x1cX\x1d", "x\x00Y\x7fz"]


def _library():
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    return library


def test_ids_are_the_librarys():
    rng, library = random.Random(2), _library()
    letters = [*"abÉéÀÿßÖ×÷ĄąİıŁǅɐzAZ09 \n\t'!?<|>.-_\x1c\x85\xa0é́A̧Σς٣字​　", "<|endoftext|>", "<|startoftext|>", "'s", "'LL"]
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    ids, stops = WordTable.of(PATH).encode(pa.array(texts))
    for a, b, text in zip([0, *stops], stops, texts, strict=False):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def _check(rows, capacity):
    """Each sequence is filled from 0 without a gap, within the capacity."""
    bins: dict = {}
    for sequence, offset, length in rows:
        bins.setdefault(sequence, []).append((offset, length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_query_against_the_library(spark):
    """Whole small table: every piece by the library's ids, and no more sequences than one more than the tokens need."""
    library, want = _library(), {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want[(r.doc_id, k)] = (start, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))
    rows = op12_packing(spark, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    used = _check([(r.sequence_id, r.offset, r.length) for r in rows], 4096)
    assert used <= -(-sum(r.length for r in rows) // 4096) + 1


def _best_fit_decreasing(lengths, capacity):
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [(room, k) for k, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("kind,most", [("small", 1), ("thirds", 0), ("halves", 0), ("equal", 0), ("ones", 1)])
def test_as_few_sequences_as_best_fit(spark, kind, most):
    """Many blocks at once need no more sequences than best fit over all pieces, but for ``most`` percent."""
    rng = random.Random(7)
    make = {"small": lambda: rng.randint(1, 120), "thirds": lambda: rng.randint(250, 420), "halves": lambda: rng.randint(501, 999), "equal": lambda: 334, "ones": lambda: rng.choice([1, 1, 1000, 700])}[kind]
    lengths = [make() for _ in range(3000)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id int, length int").repartition(5)
    rows = pack_pieces(df, 1000, block_items=300).collect()
    assert sorted(r.row.id for r in rows) == list(range(3000))
    used = _check([(r.sequence_id, r.offset, r.row.length) for r in rows], 1000)
    best = max(_best_fit_decreasing(lengths, 1000), -(-sum(lengths) // 1000))
    assert used <= best * (1 + max(most, 1) / 100), (used, best)


def test_generations_improve():
    """Crossing and shaking save bins that best fit wastes; a child is a whole packing."""
    rng = random.Random(5)
    lengths = sorted((rng.randint(900, 2500) for _ in range(800)), reverse=True)
    block = Block(lengths, 4096)
    population = [block.first(0.0, rng), *[block.first(0.1 * k, rng) for k in (1, 2, 3)]]
    before = block.worth(population[0])
    population = block.evolve(population, 40, rng)
    assert block.worth(population[0]) > before
    for bins in population:
        assert sorted(i for b in bins for i in b) == list(range(800)) and max(block.fills(bins)) <= 4096
    child = block.cross(population[0], population[1], rng)
    assert sorted(i for b in child for i in b) == list(range(800))


def test_awkward_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "x"), (4, "word " * 30_000), (5, "tie"), (6, "tie")] + [(7, "copy of a text")] * 500
    pieces = token_pieces(documents(rows, extra=True), PATH, end_id=1, capacity=64)
    out = pack_pieces(pieces.select("row.doc_id", "row.id", "row.p", "piece", "start", "length", "ids"), 64, block_items=200)
    got = out.collect()
    assert len(got) == pieces.count()
    _check([(r.sequence_id, r.offset, r.row.length) for r in got], 64)
    whole = {r.sequence_id: bytes(r.ids) for r in join_sequences(out).collect()}
    for r in got:
        assert whole[r.sequence_id][4 * r.offset :][: 4 * r.row.length] == bytes(r.row.ids)
    assert {r.row.length for r in got if r.row.doc_id in (1, 2)} == {1}
    long = sorted((r.row.piece, r.row.start, r.row.length) for r in got if r.row.doc_id == 4)
    assert [x[:2] for x in long] == [(k, 64 * k) for k in range(len(long))] and sum(x[2] for x in long) == 30_001
    assert pack_pieces(pieces.limit(0).select("length"), 64).count() == 0 and token_pieces(documents([]), PATH, 1, 64).count() == 0


@pytest.mark.parametrize("length", [0, 65, None])
def test_lengths_out_of_range_are_an_error(spark, length):
    df = spark.createDataFrame([(length,), (3,)], "length int")
    with pytest.raises(Exception, match="outside 1 to the capacity"):
        pack_pieces(df, 64).collect()


def test_row_is_kept(spark):
    df = spark.createDataFrame([(5, "x", 1.5)], "length int, item string, deal double")
    assert pack_pieces(df, 10).select(F.col("row.*"), "offset").first().asDict() == {"length": 5, "item": "x", "deal": 1.5, "offset": 0}
