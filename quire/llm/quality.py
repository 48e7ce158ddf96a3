"""Quality rules with adaptive thresholds from mergeable quantile sketches.

1. Each text is measured (one vectorised helper, whole texts): words, word characters, symbols,
   lines that repeat an earlier one, words inside repeated 3-word windows.
2. Rates of these (integers, per 1,000) go into sketches, one for each language, source and rate;
   documents that fail the fixed base rule are out anyway and have no say.
   A sketch is a table of (bin, count) with 64 bins an octave, so it errs by 1/64 at most; two
   sketches merge by adding counts, in any order, with the same result. Counts of (language,
   source) merge into those of the language and of all documents.
3. The threshold of a rate is drawn from its group's distribution: MARGIN times its TAIL quantile, at
   least 1/TIGHTEST of the rate's fixed value, at most that value. Only the bulk can lift it above:
   to q50 + SPREAD * (q50 - q25), if that is more. A language's threshold never exceeds that of all
   documents, a source's never that of its language. A group of fewer than ``min_group`` documents
   takes its language's threshold, and a language of fewer that of all documents.
4. Thresholds are joined back to the documents: over a threshold, or failing the fixed base rule, is out.

The lower quartiles stay put while under half of a group is junk, and junk in the tail only brings the
fixed value back, so a source full of junk can't raise its own threshold above that of its language.

* null or empty text: no words, so the base rule fails. null language or source: groups of their own.
* Ties: a value equal to the threshold stays. Repeated rows each count and return. Empty table: no rows.
* Texts of any length are measured whole, once: the measures are written beside the carried columns. Extra columns travel in ``row``.

Scale: sketches are combined before their shuffle, so a hot source costs one row for each bin and
task; a window over a group sees its bins alone, some hundreds at most whatever the documents. The threshold table has a row for each (language, source); it is counted, and broadcast only
up to ``MAX_BROADCAST`` rows; beyond, the join is by (language, source, salt) with the thresholds repeated for
each salt, so that no hot source meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from quire.llm.text import carried
from quire.session import Scratch, bounded_batches

MAX_BROADCAST = 20_000
SALTS = 64
#: Rates and the fixed values of their thresholds (per 1,000 words, or lines): no tail lifts one above it, only a bulk beyond it.
FLOORS = {"symbol_rate": 100, "dup_line_rate": 500, "repeat_rate": 300}
SPREAD = 3
#: Percent of a group below its tail, how far above the tail a threshold lies, and the part of the fixed value it may shrink to.
TAIL, MARGIN, TIGHTEST = 99, 2, 4
_SYMBOLS = "#*$%&|<>"
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_text_lines")


def _repeated(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    v = len(known)
    pair = ids[:-1] * v + ids[1:]
    if v > 2_000_000:  # three ids would not fit 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * v + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n + 2, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = twice[:n].copy()
    cover[1:] |= twice[: n - 1]
    cover[2:] |= twice[: n - 2]
    return int(cover.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * len(_MEASURES)
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    return len(words), len(text) - blanks, sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), _repeated(words), len(lines)


@F.pandas_udf(T.StructType([T.StructField(k, T.LongType()) for k in _MEASURES]))
def _measure(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in parts:
        yield pd.DataFrame([measure_text(t) for t in s], columns=list(_MEASURES), dtype="int64")


#: Bin of the non-negative integer ``value``: itself under 128, then 64 bins an octave (its upper 7 bits).
SKETCH_BIN = "cast(greatest(0, length(bin(value)) - 7) * 64 + shiftright(value, greatest(0, length(bin(value)) - 7)) as int)"
#: Least value of the bin ``b``.
BIN_FLOOR = "if(b < 128, cast(b as bigint), shiftleft(cast(b % 64 + 64 as bigint), b div 64 - 1))"


def rate_sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, rate, b, n): the sketches of all groups, as tables of bins; ``n`` counts what passes the base rule."""
    rates = F.create_map(*[x for k in FLOORS for x in (F.lit(k), F.col(k))])
    exploded = measured.select("lang", "source", "base_failed", F.explode(rates).alias("rate", "value"))
    return exploded.groupBy("lang", "source", "rate", F.expr(SKETCH_BIN).alias("b")).agg(F.count_if(~F.col("base_failed")).alias("n"))


def _limits(sketch: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Documents and limit of each rate of the groups that ``keys`` make; sketches merge by adding counts."""
    merged = sketch.groupBy(*keys, "rate", "b").agg(F.sum("n").alias("n"))
    w = W.partitionBy(*keys, "rate")
    run = merged.select("*", F.sum("n").over(w.orderBy("b")).alias("upto"), F.sum("n").over(w).alias("docs"))
    value = F.expr(BIN_FLOOR)
    q = run.groupBy(*keys, "rate").agg(
        F.max("docs").alias(f"{name}_docs"),
        *[F.min(F.when(F.col("upto") * 100 >= F.col("docs") * percent, value)).alias(f"q{percent}") for percent in (25, 50, TAIL)],
    )
    fixed = F.create_map(*[F.lit(x) for kv in FLOORS.items() for x in kv])[F.col("rate")].cast("long")
    tail = F.least(fixed, F.col(f"q{TAIL}") * MARGIN)
    limit = F.greatest(F.floor(fixed / TIGHTEST), tail, F.col("q50") + SPREAD * (F.col("q50") - F.col("q25")))
    return q.select(*keys, "rate", f"{name}_docs", limit.alias(f"{name}_limit"))


def rate_thresholds(sketch: DataFrame, min_group: int) -> DataFrame:
    """(lang, source, a limit for each rate): no group's is above that of the group it is part of."""
    own, of_lang, of_all = _limits(sketch, ["lang", "source"], "own"), _limits(sketch, ["lang"], "lang"), _limits(sketch, [], "all")
    within = lambda name, parent: F.when(F.col(f"{name}_docs") >= min_group, F.least(f"{name}_limit", parent)).otherwise(parent)
    joined = (
        own.alias("o").join(of_lang.alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.rate") == F.col("l.rate")))
        .join(of_all.alias("a"), F.col("o.rate") == F.col("a.rate"))
        .select("o.lang", "o.source", "o.rate", within("own", within("lang", F.col("all_limit"))).alias("limit"))
    )
    return joined.groupBy("lang", "source").agg(*[F.max(F.when(F.col("rate") == k, F.col("limit"))).alias(f"max_{k}") for k in FLOORS])


def quality_rules(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_words: int = 50, max_repeat_percent: int = 50, min_group: int = 100,
    carry: list[str] | None = None,
) -> DataFrame:
    """Columns: row, the measures, the rates, their limits, base_failed, kept. ``carry`` names the columns of ``row``; all if it is None."""
    scratch = Scratch(docs.sparkSession, "quality")
    bounded_batches(docs.sparkSession)
    m = carried(docs, carry, lang=docs[lang_col], source=docs[source_col], m=_measure(docs[text_col])).select("row", "lang", "source", "m.*")
    rate = lambda k, of: F.when(F.col(of) > 0, F.expr(f"1000 * {k} div {of}")).otherwise(F.lit(0)).cast("long")
    m = m.withColumns({"symbol_rate": rate("n_symbols", "n_words"), "dup_line_rate": rate("n_dup_lines", "n_text_lines"), "repeat_rate": rate("n_repeat_words", "n_words")})
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    m = scratch.keep(m.withColumn("base_failed", base), "measures")
    limits = scratch.keep(rate_thresholds(rate_sketches(m), min_group), "limits")
    m = m.withColumn("salt", F.pmod(F.xxhash64("n_words", "word_chars", "n_symbols"), F.lit(SALTS)).cast("int"))
    at = m["lang"].eqNullSafe(limits["lang"]) & m["source"].eqNullSafe(limits["source"])
    if limits.count() <= MAX_BROADCAST:
        joined = m.join(F.broadcast(limits), at, "left")
    else:
        salted = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = m.join(salted, m["lang"].eqNullSafe(salted["lang"]) & m["source"].eqNullSafe(salted["source"]) & (m["salt"] == salted["salt"]), "left")
    over = F.lit(False)
    for k in FLOORS:
        over = over | (F.col(k) > F.col(f"max_{k}"))
    return joined.select("row", *_MEASURES, *FLOORS, *[f"max_{k}" for k in FLOORS], "base_failed", (~F.col("base_failed") & ~over).alias("kept"))
