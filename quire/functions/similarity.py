"""Similarity of texts by their longest common subsequence, vectorised over distinct pairs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _masks(a: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | (1 << i)
    return masks


def _lcs(a: str, b: str, masks: dict[str, int] | None = None) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    if not a or not b:
        return 0
    masks = _masks(a) if masks is None else masks
    s = full = (1 << len(a)) - 1
    for c in b:
        u = s & masks.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


@F.pandas_udf(T.DoubleType())
def fuzz_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity 0 to 100: 200 * LCS / (length of both); 100 for two empty texts. Distinct pairs are computed once."""
    pairs = list(zip(a.fillna(""), b.fillna(""), strict=True))
    known = {(x, y): 200.0 * _lcs(x, y) / (len(x) + len(y)) if x or y else 100.0 for x, y in set(pairs)}
    return pd.Series([known[p] for p in pairs], dtype=float)


#: Windows whose starts lie within this part of the query's length are bounded together.
STRETCH = 32


def best_window(q: str, t: str, cutoff: float = 0.0) -> tuple[float, int]:
    """Best ``fuzz_ratio`` of the shorter text with a window of its length in the longer (windows may run over
    the ends) and where the first best one starts; (0, -1) under the cutoff.

    A window's common characters, and the three-letter parts that a few edits leave whole, bound its ratio, so only
    windows that may beat the best so far are compared. One pass of vector operations over the text for each character of the query.
    """
    if not q or not t:
        return (100.0, 0) if not q and not t else (0.0, -1)
    q, t = (q, t) if len(q) <= len(t) else (t, q)
    n, size = len(q), len(t)
    if (at := t.find(q)) >= 0:
        return 100.0, at
    codes = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    start = np.arange(1 - n, size)
    lo, hi = np.maximum(start, 0), np.minimum(start + n, size)
    shared = np.zeros(len(start), dtype=np.int64)
    for c in set(q):
        upto = np.concatenate([[0], np.cumsum(codes == ord(c))])
        shared += np.minimum(q.count(c), upto[hi] - upto[lo])
    if n >= 3 and size >= 3:  # each of the d characters of q that are left out breaks three parts at most
        parts = np.array([ord(a) * 0x110000 * 0x110000 + ord(b) * 0x110000 + ord(c) for a, b, c in zip(q, q[1:], q[2:], strict=False)], dtype=np.float64)
        keys = codes[:-2].astype(np.float64) * 0x110000 * 0x110000 + codes[1:-1].astype(np.float64) * 0x110000 + codes[2:]
        upto = np.concatenate([[0], np.cumsum(np.isin(keys, parts))])
        first = np.minimum(lo, size - 2)
        hits = upto[np.maximum(hi - 2, first)] - upto[first]
        # LCS = n - d and the window has w - LCS insertions: whole parts >= (n - 2) - 2 * (d + insertions) - d
        w = hi - lo
        shared = np.minimum(shared, (hits + 2 + 2 * n + 2 * w) // 5)
    bound = 200.0 * shared / (n + hi - lo)
    masks, best, where = _masks(q), 0.0, -1
    # no window shares more with q than a stretch around it does: one comparison bounds all windows inside
    step = max(4, n // STRETCH)
    for i in range(0, len(start), step):
        if np.count_nonzero(bound[i : i + step] >= cutoff) > 2:
            most = _lcs(q, t[lo[i] : hi[min(i + step, len(start)) - 1]], masks)
            bound[i : i + step] = np.minimum(bound[i : i + step], 200.0 * most / (n + (hi - lo)[i : i + step]))
    for i in np.argsort(-bound, kind="stable"):
        if bound[i] < best or bound[i] < cutoff:
            break
        score = 200.0 * _lcs(q, t[lo[i] : hi[i]], masks) / (n + int(hi[i] - lo[i]))
        if score > best or (score == best and lo[i] < where):
            best, where = score, int(lo[i])
    return (best, where) if best >= cutoff else (0.0, -1)


def partial_ratio(query: Column, text: Column, cutoff: Column | None = None) -> Column:
    """Struct of score (0 to 100) and start of the text's window most like the query; 0 and -1 under the cutoff."""

    @F.pandas_udf("score double, start int")
    def found(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([best_window(q, t, c) for q, t, c in zip(a.fillna(""), b.fillna(""), least.fillna(0.0), strict=True)], columns=["score", "start"])

    return found(query, text, F.lit(0.0) if cutoff is None else cutoff)
