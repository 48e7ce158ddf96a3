"""Mixing to target weights with soft membership.

1. Classifier. A bounded sample of labelled rows (``max_labelled``, chosen by hash) teaches a softmax
   regression: the ``max_words`` words whose presence tells domains apart best (chi-square of document
   counts), and flags of form (capitals, bars, exclamation, repetition). It gives every document
   posteriors over the domains.
2. Targets. Domain k shall have w_k / w_anchor times the expected tokens of the anchor domain, which
   keeps its own; so no anchor document has to go to meet a share.
3. Rates. Nonnegative rates r minimise sum_k (sum_d r_d n_d p_dk - t_k)^2 / T_k by projected gradient steps
   from r = 1, in the metric of document lengths (a rate moves by its document's posteriors alone): r becomes
   max(0, r - p.g / e), where g is the gradient at the step's end, not at its start. So a step may be as long as one likes; its K numbers
   are found by Newton's method, each evaluation one aggregation. Steps grow until the duality gap is as good as none: within
   ``tolerance`` of the best totals there are, the targets themselves or, where posteriors overlap too much for them, the least squares.
   No number of steps ends it; numbers that get no better before that are an error. A rate is a fold over the steps, so no
   state is kept. Posteriors are rounded to 1/1000 and documents of equal ones added up; an aggregation reads that table.
4. Copies. ``rounding="hash"``: the whole part of the rate, and one more with the probability of its fraction,
   drawn from a hash of the id, so totals hold in expectation. ``"nearest"``: the nearest integer. ``"anchor"``: the
   nearest integer for documents whose likeliest domain is the anchor, by hash for the others.

* null or empty text: 0 tokens, the domain prior as posteriors. Ids may repeat: each row gets its own rate, the same draw.
* Ties: of equally telling words the first in order counts; of equally likely domains the first by name.
* A labelled id with two domains teaches nothing; of the texts of a repeated id that of least hash does.
* No labelled rows: no domains, every rate is 1. A domain without weight has target 0.
* A domain without expected tokens is left out of the fit. Empty table: no rows. Extra columns travel in ``row``.

Scale: one scan for the posteriors, written beside the carried columns; an iteration reads the distinct posteriors alone. The sample is
broadcast, at most ``max_labelled`` rows; the driver sees its flags, K squared sums an evaluation, and nothing of other documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.text import carried
from quire.session import Scratch, bounded_batches

_EDGE = ".,;:!?\"'()[]|"
_FORMS = 14


def _words(text: str) -> set[str]:
    return {w.strip(_EDGE) for w in set(text.lower().split())} - {""}


def _forms(text: str, words: list[str]) -> list[int]:
    """Flags of form, by position."""
    n = len(words)
    if not n:
        return []
    upper = sum(map(str.isupper, words)) / n
    bars, bangs = text.count("|") / n, text.count("!") / n
    distinct = len(set(words)) / min(n, 400)
    lines = text.split("\n")
    same = 1 - len(set(lines)) / len(lines)
    values = [upper > 0.1, upper > 0.2, upper > 0.5, bars > 0.02, bars > 0.1, bangs > 0.02, bangs > 0.1, bangs > 0.5, distinct < 0.15, distinct < 0.3, distinct < 0.5, same > 0.1, same > 0.3, n < 50]
    return [i for i, v in enumerate(values) if v]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _word_set(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield pd.Series([sorted(_words(t or "")) for t in s], dtype=object)


def _flags(known: dict[str, int]):
    names = known.keys()

    def of(text: str | None) -> list[int]:
        if not text:
            return []
        return [*_forms(text, text.split()), *(known[w] + _FORMS for w in _words(text) & names)]

    return of


def _fit(rows: list[tuple[list[int], int]], width: int, k: int, steps: int = 300, penalty: float = 1e-4) -> np.ndarray:
    """Softmax regression on binary flags; the last row holds the intercepts."""
    x = np.zeros((len(rows), width + 1), dtype=np.float32)
    x[:, -1] = 1
    y = np.zeros((len(rows), k), dtype=np.float32)
    for i, (flags, domain) in enumerate(rows):
        x[i, flags] = 1
        y[i, domain] = 1
    w, v = np.zeros((width + 1, k), dtype=np.float32), np.zeros((width + 1, k), dtype=np.float32)
    scale = np.sqrt(x.mean(axis=0) + 1e-3)[:, None]  # rare flags learn as fast as frequent ones
    for step in range(steps):
        z = x @ w
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        g = x.T @ (p - y) / len(rows) + penalty * w * (np.arange(width + 1) < width)[:, None]
        v = 0.9 * v - 0.3 * g / scale / (1 + 0.01 * step)
        w = w + v
    return w


def learn_domains(docs: DataFrame, labelled: DataFrame, id_col: str, text_col: str, max_labelled: int, max_words: int) -> tuple[list[str], dict[str, int], np.ndarray] | None:
    """Domains, words and weights. ``labelled``: (id, domain)."""
    spark = docs.sparkSession
    labels = labelled.select(F.col(labelled.columns[0]).alias("id"), F.col(labelled.columns[1]).alias("domain")).where("id is not null and domain is not null")
    labels = labels.groupBy("id").agg(F.min("domain").alias("domain"), F.max("domain").alias("other")).where("domain = other").drop("other")
    labels = labels.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    scratch = Scratch(spark, "mixing-sample")
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    found = texts.join(F.broadcast(labels), "id")  # max_labelled rows of two short columns
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))
    sample = scratch.keep(found.groupBy("id", "domain").agg(least["text"].alias("text")), "sample")
    domains = sorted(r.domain for r in sample.select("domain").distinct().collect())
    if not domains:
        return None
    sizes = {r.domain: r["count"] for r in sample.groupBy("domain").count().collect()}
    total = sum(sizes.values())
    seen = sample.select("domain", F.explode(_word_set(F.col("text"))).alias("word")).groupBy("word").agg(*[F.count_if(F.col("domain") == d).alias(f"d{i}") for i, d in enumerate(domains)])
    seen = seen.withColumn("df", sum((F.col(f"d{i}") for i in range(len(domains))), F.lit(0))).where("df >= 5")
    chi = sum((F.pow(F.col(f"d{i}") - F.col("df") * (sizes[d] / total), F.lit(2)) / (F.col("df") * (sizes[d] / total)) for i, d in enumerate(domains)), F.lit(0.0))
    words = [r.word for r in seen.select("word", chi.alias("chi")).orderBy(F.desc("chi"), "word").limit(max_words).collect()]
    known = {w: i for i, w in enumerate(words)}
    of = _flags(known)
    flags = F.pandas_udf(lambda s: pd.Series([of(t) for t in s], dtype=object), T.ArrayType(T.IntegerType()))
    rows = sample.select("id", "domain", flags("text").alias("flags")).orderBy("id").collect()
    scratch.drop(sample)
    return domains, known, _fit([(list(r.flags), domains.index(r.domain)) for r in rows], len(known) + _FORMS, len(domains))


def _posteriors(text: Column, model: tuple[list[str], dict[str, int], np.ndarray]) -> Column:
    domains, known, weights = model
    of = _flags(known)

    @F.pandas_udf(T.StructType([T.StructField("tokens", T.LongType()), T.StructField("p", T.ArrayType(T.DoubleType()))]))
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in parts:
            out = []
            for t in s:
                z = weights[of(t)].sum(axis=0, dtype=np.float64) + weights[-1]
                p = np.exp(z - z.max())
                out.append((len((t or "").split()), (p / p.sum()).round(3)))
            yield pd.DataFrame(out, columns=["tokens", "p"])

    return score(text)


def _rate(steps: list[list[float]]) -> Column:
    """The rate after the steps: a fold that subtracts posterior-weighted residuals and stays at or over 0."""
    if not steps:
        return F.lit(1.0)
    k = len(steps[0])
    taken = F.array(*[F.array(*[F.lit(x) for x in e]) for e in steps])
    return F.aggregate(taken, F.lit(1.0), lambda r, e: F.greatest(F.lit(0.0), r - sum((F.get(F.col("p"), F.lit(i)) * F.get(e, F.lit(i)) for i in range(k)), F.lit(0.0))))


def fit_rates(scored: DataFrame, domains: list[str], weights: dict[str, float], anchor: str, tolerance: float) -> tuple[list[list[float]], list[float], list[float]]:
    """Steps of the projected gradient, targets, and the totals they reach. ``scored``: (tokens, p)."""
    k = len(domains)
    p = [F.get(F.col("p"), F.lit(i)) for i in range(k)]
    number = lambda x: float(x or 0)
    have = np.array([number(x) for x in scored.agg(*[F.sum(F.col("tokens") * x) for x in p]).first()])
    at = domains.index(anchor) if anchor in domains else int(np.argmax(have))
    share = np.array([weights.get(d, 0.0) for d in domains])
    targets = share * (have[at] / share[at] if share[at] > 0 else have.sum())
    fit = np.flatnonzero(have > 0)  # the others have no tokens at any rate
    steps: list[list[float]] = []
    if not len(fit):
        return steps, targets.tolist(), have.tolist()
    scale, goal = have[fit], targets[fit]

    def at_end(g: np.ndarray, e: float) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, float]:
        """Of the step with gradient ``g``: the function whose least value it has, slope and curvature of that, totals, least p.g."""
        along = sum((p[i] * F.lit(float(x)) for i, x in zip(fit, g, strict=True)), F.lit(0.0))
        rows = scored.where("tokens > 0").select("tokens", *[p[i].alias(f"p{i}") for i in fit], along.alias("along"), F.greatest(F.lit(0.0), _rate(steps) - along / F.lit(e)).alias("r"))
        n = F.col("tokens")
        bent = [F.sum(F.when(F.col("r") > 0, n * F.col(f"p{i}") * F.col(f"p{j}"))) for i in fit for j in fit if i <= j]
        sums = [number(x) for x in rows.agg(F.sum(n * F.col("r") * F.col("r")), F.min("along"), *[F.sum(n * F.col("r") * F.col(f"p{i}")) for i in fit], *bent).first()]
        totals, curve = np.array(sums[2 : 2 + len(fit)]), np.zeros((len(fit), len(fit)))
        curve[np.triu_indices(len(fit))] = sums[2 + len(fit) :]
        curve = (curve + np.triu(curve, 1).T) / e + np.diag(scale)
        return float((scale * g * g).sum() / 2 + goal @ g + e * sums[0] / 2), scale * g + goal - totals, curve, totals, sums[1]

    e = 1.0
    while True:
        g = np.zeros(len(fit)) if not steps else (totals - goal) / scale
        value, slope, curve, totals, _ = at_end(g, e)
        while np.abs(slope).max() > 1e-9 * scale.max():
            way, part = -np.linalg.solve(curve, slope), 1.0
            while (tried := at_end(g + part * way, e))[0] > value + 1e-4 * part * (slope @ way) and part > 1e-6:
                part /= 2
            if part <= 1e-6:
                break  # as exact as sums of that size are
            g = g + part * way
            value, slope, curve, totals, _ = tried
        step = np.zeros(k)
        step[fit] = g / e
        steps.append(step.tolist())
        # the least p.g of the reached totals bounds how far they are from the best ones
        residual = (totals - goal) / scale
        below = at_end(residual, e)[4]
        feasible = residual + max(0.0, -below)
        gap = (scale * residual * residual).sum() / 2 + (scale * feasible * feasible).sum() / 2 + goal @ feasible
        if gap <= tolerance * tolerance * scale.sum() / 2:
            out = have.copy()
            out[fit] = totals
            return steps, targets.tolist(), out.tolist()
        if e < 1e-12:
            raise ArithmeticError(f"rates don't converge: totals {totals.tolist()}, targets {goal.tolist()}, duality gap {gap}")
        e *= 0.03


def mix_to_weights(
    docs: DataFrame, labelled: DataFrame, weights: dict[str, float], anchor: str, id_col: str = "doc_id", text_col: str = "text",
    carry: list[str] | None = None, rounding: str = "hash", max_labelled: int = 20_000, max_words: int = 400, tolerance: float = 1e-3,
) -> DataFrame:
    """Columns: row, tokens, posteriors (map of domain to probability), rate, copies (whole number).

    ``carry`` names the columns of ``row``; all if it is None.
    """
    docs = docs if carry is None else docs.select(*{*carry, id_col, text_col})
    kept = docs.columns if carry is None else carry
    bounded_batches(docs.sparkSession)
    model = learn_domains(docs, labelled, id_col, text_col, max_labelled, max_words)
    if model is None:
        out = carried(docs, kept, tokens=F.size(F.split(F.coalesce(docs[text_col], F.lit("")), r"\s+")).cast("long"))
        return out.select("row", "tokens", F.create_map().cast("map<string,double>").alias("posteriors"), F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"))
    domains = model[0]
    scored = carried(docs, kept, id=docs[id_col], m=_posteriors(docs[text_col], model)).select("row", "id", "m.tokens", "m.p")
    scratch = Scratch(docs.sparkSession, "mixing")
    scored = scratch.keep(scored, "posteriors")
    alike = scratch.keep(scored.groupBy("p").agg(F.sum("tokens").alias("tokens")), "posteriors-tokens")
    steps, _, _ = fit_rates(alike, domains, weights, anchor, tolerance)
    draw = F.pmod(F.xxhash64(F.lit(11), F.col("id")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    likeliest = F.array_position("p", F.array_max("p")) - 1 == F.lit(domains.index(anchor) if anchor in domains else -1)
    copies = F.floor(F.col("rate") + {"nearest": F.lit(0.5), "hash": draw, "anchor": F.when(likeliest, 0.5).otherwise(draw)}[rounding])
    named = F.map_from_arrays(F.array(*[F.lit(d) for d in domains]), F.col("p"))
    return scored.select("row", "id", "tokens", "p", named.alias("posteriors"), _rate(steps).alias("rate")).select("row", "tokens", "posteriors", "rate", copies.cast("long").alias("copies"))


#: Domains of the ``labels`` table.
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'low' ELSE 'clean' END"
