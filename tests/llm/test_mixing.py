import numpy as np
import pytest

from oracle import SF
from quire.llm.mixing import DOMAIN, fit_rates, mix_to_weights
from quire.llm.queries import op3_mixing


@pytest.fixture(scope="module")
def rows(spark):
    """The query's rows over the whole small table."""
    return op3_mixing(spark, SMALL).collect()


SMALL = SF.replace("sf0.001", "sf0.01")


def test_totals_meet_targets(rows):
    """The expected tokens of each domain, by the rates the query returns."""
    total = {d: sum(r.rate * r.tokens * r[f"p_{d}"] for r in rows) for d in ("clean", "low", "toxic")}
    have = sum(r.tokens * r.p_clean for r in rows)
    assert abs(total["clean"] / have - 1) < 0.01 and abs(total["low"] / total["clean"] - 0.05 / 0.95) < 0.01
    assert total["toxic"] / have < 0.03  # what clean documents hold of it by their posteriors
    assert all(r.rate >= 0 and r.copies >= 0 for r in rows)
    draws = sum(r.copies * r.tokens for r in rows) / sum(r.rate * r.tokens for r in rows)
    assert abs(draws - 1) < 0.1


def test_classifier_on_labels(spark, rows):
    domain = {r.doc_id: r.domain for r in spark.read.parquet(f"{SMALL}/labels.parquet").selectExpr("doc_id", f"{DOMAIN} AS domain").collect()}
    labelled = [r for r in rows if r.doc_id in domain]
    right = [r for r in labelled if max(("clean", "low", "toxic"), key=lambda d: r[f"p_{d}"]) == domain[r.doc_id]]
    assert len(right) / len(labelled) > 0.95


def _least_squares(a, b):
    """Nonnegative least squares by active sets (Lawson and Hanson): the least of |ax - b|."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    while not free.all():
        w = a.T @ (b - a @ x)
        w[free] = -np.inf
        if w.max() <= 1e-9 * np.abs(b).max():
            break
        free[w.argmax()] = True
        while True:
            z = np.zeros_like(x)
            z[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if (z[free] > -1e-12).all():
                x = np.maximum(z, 0)
                break
            back = free & (z <= 0)
            part = (x[back] / (x[back] - z[back])).min()
            x = x + part * (z - x)
            free &= x > 1e-12
    return a @ x


@pytest.mark.parametrize("weights,sharpness", [({"a": 0.6, "b": 0.3, "c": 0.1}, 0.4), ({"a": 0.98, "b": 0.02}, 8.0), ({"a": 0.01, "b": 0.01, "c": 0.98}, 8.0), ({"b": 1.0}, 0.4), ({"a": 1.0, "b": 1.0, "c": 1.0, "d": 5.0}, 8.0)])
def test_fit_against_least_squares(spark, weights, sharpness):
    """Reachable and unreachable targets: as near to them as rates of no sign less can come, rates never negative."""
    r = np.random.default_rng(1)
    p, n = r.dirichlet([sharpness] * 3, 60), r.integers(1, 90, 60)
    df = spark.createDataFrame([(int(a), [float(x) for x in b] + [0.0]) for a, b in zip(n, p, strict=True)] + [(0, [0.1, 0.1, 0.8, 0.0])], "tokens long, p array<double>")
    steps, targets, now = fit_rates(df, ["a", "b", "c", "d"], weights, "a", 1e-3)
    have = p.T @ n
    rate = np.ones(60)
    for e in steps:
        rate = np.maximum(0, rate - p @ np.array(e[:3]))
    assert np.allclose(p.T @ (rate * n), now[:3], rtol=1e-6, atol=1e-6 * have.sum())
    best = _least_squares((p * n[:, None]).T / np.sqrt(have)[:, None], np.array(targets[:3]) / np.sqrt(have)) * np.sqrt(have)
    worth = lambda totals: ((totals - np.array(targets[:3])) ** 2 / have).sum() / 2
    assert worth(np.array(now[:3])) <= worth(best) + 1e-6 * have.sum()


def test_query_reaches_the_least_squares(rows):
    """Whole small table: totals of the returned rates against the active sets' over the returned posteriors."""
    p, n, rate = np.array([[r.p_clean, r.p_low, r.p_toxic] for r in rows]), np.array([r.tokens for r in rows], float), np.array([r.rate for r in rows])
    have, now = p.T @ n, p.T @ (n * rate)
    targets = np.array([0.95, 0.05, 0.0]) * have[0] / 0.95
    distinct, at = np.unique(p, axis=0, return_inverse=True)
    tokens = np.bincount(at.ravel(), n)
    best = _least_squares((distinct * tokens[:, None]).T / np.sqrt(have)[:, None], targets / np.sqrt(have)) * np.sqrt(have)
    assert ((now - targets) ** 2 / have).sum() / 2 <= ((best - targets) ** 2 / have).sum() / 2 + 1e-6 * have.sum()


def test_conflicting_and_repeated_labels(spark, documents):
    """An id with two domains teaches nothing, a repeated id once; ties between domains go by name."""
    rows = [(i, "GOOD words " * 9) for i in range(10)] + [(i, "bad! bad! bad! " * 9) for i in range(10, 20)] + [(50, "GOOD words " * 9)] * 300
    labels = [(i, "clean") for i in range(10)] + [(i, "low") for i in range(10, 20)] * 2 + [(50, "low"), (50, "clean")]
    out = mix_to_weights(documents(rows), spark.createDataFrame(labels, "doc_id long, domain string"), {"clean": 0.5, "low": 0.5}, "clean").collect()
    assert len(out) == len(rows)
    assert all(r.posteriors["clean"] > 0.9 for r in out if r.row.doc_id in (*range(10), 50)) and all(r.posteriors["low"] > 0.9 for r in out if 10 <= r.row.doc_id < 20)


@pytest.mark.parametrize("labelled", [[], [(1, "clean")], [(1, "clean"), (2, "low"), (99, "low"), (None, "low"), (3, None)]])
def test_awkward_rows(spark, documents, labelled):
    rows = [(1, "good words here"), (2, "BAD | BAD | BAD"), (2, "BAD | BAD | BAD"), (3, None), (4, ""), (None, "x"), (5, "long " * 30_000)]
    labels = spark.createDataFrame(labelled, "doc_id long, domain string")
    out = mix_to_weights(documents(rows, extra=True), labels, {"clean": 1.0}, "clean", rounding="nearest").collect()
    assert len(out) == len(rows) and all(r.rate >= 0 for r in out)
    assert mix_to_weights(documents([]), labels, {"clean": 1.0}, "clean").count() == 0
