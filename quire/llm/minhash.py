"""Near-duplicate groups: banded MinHash, sequential Bayesian verification, exact confirmation.

1. Sketch. Words are ``[^\x20\x09-\x0D]+`` of the text with A-Z lower-cased; a document's set is its
   distinct ``k``-word shingles (fewer words: all of them as one; none: empty), as 64-bit hashes. One
   helper returns the set's size, a 128-bit hash of the whole set and a MinHash signature.
2. Equal sets are one node, named by its smallest id, so copies cost one row each from here on.
3. Candidates. Nodes meet in band buckets. A bucket's hub is its member with the most company over all
   its bands (the least altered of a group of copies); every other member is compared with the hub.
   This makes a row for each member, not for each pair.
4. Verification. Signatures are compared a batch at a time; a pair goes as soon as the posterior
   probability (uniform prior) that its similarity reaches the threshold is under ``miss``. Survivors
   are confirmed on the full sets.
5. The rest. Where a bucket still holds several components, every node's shingles that no other such
   node has are counted. They bound its overlap with any partner, exactly: nodes that cannot reach the
   threshold with anyone leave. The others are marked against their hub: which of its shingles they
   have (bits), and how many shared ones besides. Of two nodes with one hub, the common bits and the lesser
   number besides bound the overlap, exactly and closely, as copies of one text differ in small edits.
   Members outside a hub's largest component meet those of other components by an equi-join on (hub, size): a node with n shingles,
   c of which others have, can only be linked with sizes from p n to (1 + p) / p c - n. Of a family of texts just under the
   threshold that leaves few or none, and the bound is worked out for those alone.
   These pairs are verified like the others, so no pair that shares a bucket goes unexamined.
6. Components of all links.

* null or empty text, or white space only: n_shingles 0, linked with nothing, its own component.
* null id: linked with nothing, component null, kept. Rows that share an id are one document.
* Repeated rows: each returns a row, of one component. Ties: the smallest id stands for a group.
* Very long texts are sketched whole, in slices of bounded memory. Empty table: no rows.
* Extra columns aren't carried; join the result by id.

Scale: what is shuffled is light (ids and 64-bit keys), but for the texts of nodes that share a bucket, which
leave the input by one join and are written, and for signatures and texts of candidate pairs.
Keys that can be hot (a popular bucket, hub or set) are in plain equi-joins between written tables, whose
aggregated side is written first, so that adaptive execution splits them, or in aggregations combined before
their shuffle. Step 5 pairs nodes of different components under one hub: its rows grow with the product of their
numbers only where sizes and what each node shares with others don't part them. Intermediate
tables are written to the shared folder, so a lost executor costs a stage.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.components import connected_components
from quire.session import Scratch, bounded_batches

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Signature positions compared between two looks at the posterior.
BATCH = 16
#: Ratio of neighbouring classes of set sizes.
SIZE_STEP = 1.03
#: Words whose hashes a Python worker remembers; shingles hashed against all functions at a time.
MEMO, SLICE = 150_000, 4096

_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_words: dict[bytes, int] = {}


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240601)
    a = draw.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)[:, None]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _C[3]
    h = (h ^ (h >> np.uint64(33))) * _C[4]
    return h ^ (h >> np.uint64(33))


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_words) > MEMO:
        _words.clear()
    hashed = []
    for w in words:
        h = _words.get(w)
        if h is None:
            h = _words[w] = xxhash.xxh3_64_intdigest(w)
        hashed.append(h)
    ids = np.array(hashed, dtype=np.uint64)
    k = min(k, len(ids))
    n = len(ids) - k + 1
    h = np.full(n, np.uint64(k))
    for i in range(k):
        h = _mix(h * _C[0] + ids[i : i + n] * _C[1] + _C[2])
    return np.unique(h)


def signature(shingles: np.ndarray) -> bytes:
    """Least value of each hash function, upper 32 bits."""
    a, b = _functions()
    least = np.full((HASHES, 1), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), SLICE):
        least = np.minimum(least, (shingles[None, at : at + SLICE] * a + b).min(axis=1, keepdims=True))
    return (least >> np.uint64(32)).astype("<u4").tobytes()


_SKETCH = T.StructType([T.StructField("n", T.LongType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("sig", T.BinaryType())])


def sketches(parts: Iterator[pd.Series], k: int) -> Iterator[pd.DataFrame]:
    for s in parts:
        rows = []
        for t in s:
            h = shingle_hashes(t, k)
            d = hashlib.blake2b(h.tobytes(), digest_size=16).digest()
            rows.append((len(h), int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), signature(h) if len(h) else None))
        yield pd.DataFrame(rows, columns=["n", "k1", "k2", "sig"])
    forget()


def forget() -> None:
    """Words are remembered within a task, or a batch of pairs: later stages of the worker need the room."""
    _words.clear()
    pa.default_memory_pool().release_unused()


def _sketch(text: Column, k: int) -> Column:
    @F.pandas_udf(_SKETCH)
    def sketch(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from sketches(parts, k)

    return sketch(text)


@lru_cache(maxsize=64)
def least_matches(threshold: float, miss: float) -> list[int]:
    """Fewest matches, after each batch, that leave a posterior of at least ``miss`` at or over the threshold.

    With a uniform prior, m matches of n give P(S >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append(m)
    return out


def _plausible(threshold: float, miss: float):
    need = least_matches(threshold, miss)

    @F.pandas_udf(T.BooleanType())
    def plausible(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x = np.frombuffer(b"".join(a), dtype="<u4").reshape(-1, HASHES)
        y = np.frombuffer(b"".join(b), dtype="<u4").reshape(-1, HASHES)
        live, matches = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
        for step, least in enumerate(need):
            part = slice(step * BATCH, (step + 1) * BATCH)
            matches[live] += (x[live, part] == y[live, part]).sum(axis=1)
            live = live[matches[live] >= least]
        out = np.zeros(len(x), dtype=bool)
        out[live] = True
        return pd.Series(out)

    return plausible


def _linked(k: int, percent: int):
    @F.pandas_udf(T.BooleanType())
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        last, kept = None, np.empty(0, np.uint64)
        out = []
        for x, y in zip(a, b, strict=True):
            if y != last:  # pairs come sorted by their second text
                last, kept = y, shingle_hashes(y, k)
            h = shingle_hashes(x, k)
            both = len(np.intersect1d(h, kept, assume_unique=True))
            out.append(both > 0 and 100 * both >= percent * (len(h) + len(kept) - both))
        forget()
        return pd.Series(out, dtype=bool)

    return linked


def _in_pivot(k: int):
    """Which of the pivot's shingles (second text) the first text has, as bits, and how many."""

    @F.pandas_udf(T.StructType([T.StructField("inside", T.LongType()), T.StructField("bits", T.ArrayType(T.LongType()))]))
    def marked(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        last, kept = None, np.empty(0, np.uint64)
        out = []
        for x, y in zip(a, b, strict=True):
            if y != last:  # rows come sorted by pivot
                last, kept = y, shingle_hashes(y, k)
            has = np.isin(kept, shingle_hashes(x, k), assume_unique=True)
            raw = np.packbits(has).tobytes()
            out.append((int(has.sum()), np.frombuffer(raw.ljust(-(-len(raw) // 8) * 8, b"\0"), dtype=np.int64)))
        forget()
        return pd.DataFrame(out, columns=["inside", "bits"])

    return marked


def _all_shingles(text: Column, k: int) -> Column:
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def shingles(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([shingle_hashes(t, k).astype(np.int64) for t in s], dtype=object)
        forget()

    return shingles(text)


def minhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 85, miss: float = 1e-6) -> DataFrame:
    """Columns: the id column, n_shingles, component_id, kept."""
    scratch = Scratch(docs.sparkSession, "minhash")
    bounded_batches(docs.sparkSession)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    sketched = scratch.keep(texts.select("id", _sketch(F.col("text"), k).alias("m")).select("id", "m.*"), "sketches")
    sets = sketched.where("n > 0 and id is not null")
    named = scratch.keep(sets.groupBy("k1", "k2").agg(F.min("id").alias("node")), "nodes")
    nodes = sets.join(named, ["k1", "k2"]).where("id = node").select("node", "n", "sig").dropDuplicates(["node", "sig"])
    nodes = scratch.keep(nodes, "signatures")

    # candidates: members of shared band buckets
    width = 4 * ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.xxhash64(j, F.substr(F.col("sig"), j * width + 1, F.lit(width))))
    banded = nodes.select("node", F.explode(keys).alias("bucket"))
    shared = scratch.keep(banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    members = scratch.keep(banded.join(shared, "bucket"), "members")
    company = scratch.keep(members.groupBy("node").agg(F.sum("size").alias("company")), "company")
    hubs = members.join(company, "node").groupBy("bucket").agg(F.min(F.struct(-F.col("company"), F.col("node"))).alias("h")).select("bucket", F.col("h.node").alias("hub"))
    hubs = scratch.keep(hubs, "hubs")
    texts = scratch.keep(texts.join(company.select(F.col("node").alias("id")), "id", "left_semi"), "texts")  # of candidates, read by all that follows
    pairs = members.join(hubs, "bucket").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    links = _verified(scratch, pairs, nodes, texts, k, percent, miss)

    # the rest: buckets that still hold several components
    first = connected_components(links, scratch)
    placed = members.join(first, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    placed = scratch.keep(placed, "placed")
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("bucket")
    mixed = scratch.keep(mixed, "mixed-buckets")
    rest = scratch.keep(placed.join(mixed, "bucket", "left_semi"), "rest")
    in_rest = scratch.keep(rest.select("node").distinct(), "rest-nodes")
    own = (
        texts.join(in_rest, texts["id"] == in_rest["node"], "left_semi").select("id", F.explode(_all_shingles(F.col("text"), k)).alias("h"))
        .groupBy("h").agg(F.count("*").alias("c"), F.min("id").alias("node")).where("c = 1")
        .groupBy("node").agg(F.count("*").alias("alone"))
    )
    sized = nodes.groupBy("node").agg(F.max("n").alias("n"))
    bound = in_rest.join(sized, "node").join(own, "node", "left").select("node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common"))
    bound = scratch.keep(bound.where(100 * F.col("common") >= percent * F.col("n")), "bounds")
    marks = rest.join(bound, "node", "left_semi").join(hubs, "bucket").select("node", "component", "hub").distinct()
    marks = scratch.keep(marks, "marks")
    pivots = texts.join(marks.select("hub").distinct(), texts["id"] == F.col("hub"), "left_semi").groupBy("id").agg(F.min("text").alias("tb")).withColumnRenamed("id", "hub")
    pivots = scratch.keep(pivots, "pivots")
    seen = marks.join(texts.select(F.col("id").alias("node"), F.col("text").alias("ta")), "node").join(pivots, "hub").sortWithinPartitions("hub")
    seen = seen.select("node", "component", "hub", _in_pivot(k)("ta", "tb").alias("m")).join(bound, "node")
    seen = scratch.keep(seen.select("node", "component", "hub", "n", "common", "m.bits", (F.col("common") - F.col("m.inside")).alias("extra")), "seen")
    counts = seen.groupBy("hub", "component").agg(F.count("*").alias("c"))
    most = counts.groupBy("hub").agg(F.max(F.struct("c", "component")).alias("m"), F.count("*").alias("kinds")).where("kinds > 1").select("hub", F.col("m.component").alias("largest"))
    most = scratch.keep(most, "largest")
    mixed = scratch.keep(seen.join(most, "hub"), "mixed")
    # sizes that a partner may have, in steps of SIZE_STEP
    size = lambda n: F.floor(F.log(n) / math.log(SIZE_STEP)).cast("int")
    least = F.ceil(F.col("n") * percent / 100)
    most_n = F.floor(F.col("common") * (100 + percent) / percent) - F.col("n")
    outside = mixed.where("component <> largest").withColumns({"lo": least, "hi": most_n}).where("lo <= hi")
    outside = scratch.keep(outside.withColumn("size", F.explode(F.sequence(size(F.col("lo")), size(F.col("hi"))))), "outside")
    x, y = outside.alias("x"), scratch.keep(mixed.withColumn("size", size(F.col("n"))), "sized").alias("y")
    shared = F.aggregate(F.zip_with("x.bits", "y.bits", lambda u, v: F.bit_count(u.bitwiseAND(v))), F.lit(0), lambda t, c: t + c)
    may = (100 + percent) * (shared + F.least("x.extra", "y.extra")) >= percent * (F.col("x.n") + F.col("y.n"))
    once = (F.col("y.component") == F.col("y.largest")) | (F.col("x.node") < F.col("y.node"))
    fits = F.col("y.n").between(F.col("x.lo"), F.col("x.hi"))
    more = x.join(y, (F.col("x.hub") == F.col("y.hub")) & (F.col("x.size") == F.col("y.size"))).where(fits & (F.col("x.component") != F.col("y.component")) & once & may)
    more = more.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()
    links = links.unionByName(_verified(scratch, more, nodes, texts, k, percent, miss))

    found = connected_components(links, scratch)
    final = scratch.keep(named.join(found, named["node"] == found["node"], "left").select("k1", "k2", F.coalesce("component", named["node"]).alias("component")), "final")
    light = sketched.select("id", "n", "k1", "k2")
    out = light.join(final, ["k1", "k2"], "left").select("id", "n", F.when(F.col("n") > 0, F.col("component")).alias("component"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _verified(scratch: Scratch, pairs: DataFrame, nodes: DataFrame, texts: DataFrame, k: int, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) that are links, as a written table."""
    pairs = scratch.keep(pairs, "pairs")
    sig_a, sig_b = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sa")), nodes.select(F.col("node").alias("b"), F.col("sig").alias("sb"))
    likely = pairs.join(sig_a, "a").join(sig_b, "b").where(_plausible(percent / 100, miss)("sa", "sb")).select("a", "b").distinct()
    likely = scratch.keep(likely, "likely")
    text_a, text_b = texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    full = likely.join(text_a, "a").join(text_b, "b").sortWithinPartitions("b")
    return scratch.keep(full.where(_linked(k, percent)("ta", "tb")).select("a", "b").distinct(), "links")
