"""Tables from the text layer: tokens of the characters inside a table's box, and the grid that suits them best."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import escape
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from quire.functions.text import CELL_PATTERNS, bind
from quire.operators.blocks import PAGE
from quire.operators.streams import Columns, Groups, solve_groups

# Fixed values of the rules.
LEADERS = r"^[.·•…_\-\s]+$"
LEAST_CELLS, LEAST_ROWS, LEAST_GAP = 2, 3, 2.5
SHARES = (0.01, 0.03, 0.10)
MOST_ODD, WIDE = 0.02, 2.5
_ODD = re.compile("[\ue000-\uf8ff\ufffd]")
_NUMBERS = re.compile(r"-?[\d,]+(?:\.\d+)?%?")
_MARKUP = re.compile("[&<>\"']")
_SIGN = re.compile(r"^[^\w]{1,2}$")
#: Patterns of the kinds of cells in their order; what suits none is text.
_CELLS = [re.compile(p) for p in CELL_PATTERNS.values()]
TEXT = len(_CELLS) + 1
_NUMBER = re.compile(CELL_PATTERNS["num"])

TABLE = [*PAGE, "pos"]


def table_tokens(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """(table, line_idx, seq, text, x0, x1, y0, y1): words of the lines inside each table's box.

    ``lines``: doc_id, page_id, line_idx, box, spans (array of text, x0, y0, x1, y1, chars: array of c, x0, y0, x1, y1); ``tables``:
    doc_id, page_id, pos, box. Characters whose centre is inside count; a gap of over half a character's height starts a new
    token in a span; a line without any characters gives its spans. Tokens of leaders alone go.

    A line's tokens are made in its row, so that nothing but ``lines`` itself is shuffled, and not that where it comes dealt by page: the
    tables are hashed, and the lines, whose characters are many times their text, neither sorted nor read twice.
    """
    apart = (F.col("l.x1") < F.col("t.x0")) | (F.col("l.x0") > F.col("t.x1")) | (F.col("l.y1") < F.col("t.y0")) | (F.col("l.y0") > F.col("t.y1"))
    met = lines.alias("l").join(tables.hint("shuffle_hash").alias("t"), (F.col("l.doc_id") == F.col("t.doc_id")) & (F.col("l.page_id") == F.col("t.page_id")) & ~apart)
    twice = {c: 2 * F.col(f"t.{c}") for c in ("x0", "y0", "x1", "y1")}  # sums are compared, as there are many characters to halve
    inside = lambda c: (c["x0"] + c["x1"]).between(twice["x0"], twice["x1"]) & (c["y0"] + c["y1"]).between(twice["y0"], twice["y1"])
    gap = lambda c, before: F.coalesce(c["x0"] - before["x1"] > 0.5 * F.greatest(c["y1"] - c["y0"], F.lit(1.0)), F.lit(True))
    trimmed = lambda text: F.regexp_replace(text, r"^\s+|\s+$", "")

    def token(cs: Column, first: Column, end: Column) -> Column:
        text = F.array_join(F.transform(F.slice(cs, first + 1, end - first), lambda c: c["c"]), "")
        return F.struct(trimmed(text).alias("text"), F.get(cs, first)["x0"].alias("x0"), F.get(cs, end - 1)["x1"].alias("x1"))

    def cut(cs: Column) -> Column:
        places = F.transform(cs, lambda c, i: F.when(gap(c, F.get(cs, i - 1)), i))
        return bind(F.filter(places, lambda i: i.isNotNull()), lambda starts: F.transform(starts, lambda first, j: token(cs, first, F.coalesce(F.get(starts, j + 1), F.size(cs)))))

    def tokens(spans: Column) -> Column:
        of_chars = F.transform(spans, lambda s: bind(F.filter(F.coalesce(s["chars"], F.array()), inside), cut))
        whole = F.transform(F.filter(spans, inside), lambda s: F.array(F.struct(trimmed(s["text"]).alias("text"), s["x0"].alias("x0"), s["x1"].alias("x1"))))
        made = F.when(F.exists(spans, lambda s: F.coalesce(F.size(s["chars"]), F.lit(0)) > 0), of_chars).otherwise(whole)
        return F.filter(F.flatten(made), lambda w: (w["text"] != "") & ~w["text"].rlike(LEADERS))

    found = met.select("t.doc_id", "t.page_id", "t.pos", "l.line_idx", F.round("l.y0", 1).alias("y0"), F.round("l.y1", 1).alias("y1"), bind(F.col("l.spans"), tokens).alias("tokens"))
    # the outer form keeps the optimizer from making the tokens a second time, in a filter of its own
    out = found.select(*TABLE, "line_idx", F.posexplode_outer("tokens").alias("seq", "w"), "y0", "y1").where("seq is not null")
    return out.select(*TABLE, "line_idx", "seq", "w.text", F.round("w.x0", 1).alias("x0"), F.round("w.x1", 1).alias("x1"), "y0", "y1")


@lru_cache(1 << 16)
def _kind(text: str) -> int:
    """0 for an empty cell, else 1 and the place of the first pattern that suits it, text last."""
    text = text.strip()
    return next((n for n, p in enumerate(_CELLS, 1) if p.search(text)), TEXT) if text else 0


@lru_cache(1 << 16)
def _several_numbers(text: str) -> bool:
    """Two numbers or more that make up much of a text."""
    return len(_NUMBERS.findall(text)) > 1 and sum(map(str.isdigit, text)) > 0.4 * len(text)


#: Of a cell: its kind, and bits for a text of several numbers and for one that starts with a number.
_KIND, _SEVERAL, _STARTS = 7, 8, 16


@lru_cache(1 << 16)
def _looked_at(text: str) -> int:
    return _kind(text) | _SEVERAL * _several_numbers(text) | _STARTS * bool(_NUMBER.match(text))


def _facts(text: str) -> int:
    """No pattern suits letters alone."""
    return TEXT if text.isalpha() else _looked_at(text)


@dataclass
class Rows:
    """Lines of a table behind one another: tokens left to right as they came, with their line and what they look like."""

    top: list[float]
    size: np.ndarray
    text: list[str]
    x0: np.ndarray
    x1: np.ndarray
    facts: np.ndarray

    def where(self, keep: np.ndarray) -> Rows:
        """Some of the lines, in order."""
        tokens = np.repeat(keep, self.size)
        some = lambda values, kept: [v for v, k in zip(values, kept.tolist(), strict=True) if k]
        return Rows(some(self.top, keep), self.size[keep], some(self.text, tokens), self.x0[tokens], self.x1[tokens], self.facts[tokens])

    def each(self) -> list[tuple[float, slice]]:
        """Lines from the top: their height and the place of their tokens."""
        ends = np.cumsum(self.size).tolist()
        return sorted(((y, slice(a, b)) for y, a, b in zip(self.top, [0, *ends[:-1]], ends, strict=True)), key=lambda e: e[0])


class Grid:
    """A matrix of texts, dealt from rows of tokens to columns. Texts are put together where a cell holds several tokens, and for the grid that is chosen."""

    def __init__(self, rows: Rows, cuts: np.ndarray, column: np.ndarray):
        self.rows, self.cuts, self.shape = rows, cuts, (len(rows.size), len(cuts) + 1)
        self.place = np.repeat(np.arange(self.shape[0]), rows.size) * self.shape[1] + column
        self.held = np.bincount(self.place, minlength=self.shape[0] * self.shape[1])
        alone = self.held[self.place] == 1
        parts: dict[int, list[str]] = {}
        several = np.flatnonzero(~alone).tolist()
        for at, k in zip(self.place[several].tolist(), several, strict=True):
            parts.setdefault(at, []).append(rows.text[k])
        self.joined = {at: " ".join(texts) for at, texts in parts.items()}
        self.facts = np.zeros(len(self.held), np.int64)
        self.facts[self.place[alone]] = rows.facts[alone]
        self.facts[list(self.joined)] = [_facts(t) for t in self.joined.values()]

    def kinds(self) -> np.ndarray:
        return (self.facts & _KIND).reshape(self.shape)

    def cells(self) -> list[list[str]]:
        flat = [""] * len(self.held)
        for at, text in zip(self.place.tolist(), self.rows.text, strict=True):
            flat[at] = text
        for at, text in self.joined.items():
            flat[at] = text
        n = self.shape[1]
        return [flat[i : i + n] for i in range(0, len(flat), n)]

    def score(self, n_header: int | None) -> float:
        """0 to 1: six parts, of which the cells of a single token count twice."""
        kinds = self.kinds()
        full = kinds > 0
        if not full.any():
            return 0.0
        columns = self.shape[1]
        tally = np.bincount((np.arange(columns) * (TEXT + 1) + kinds).ravel(), minlength=columns * (TEXT + 1)).reshape(columns, -1)[full.any(axis=0), 1:]
        agreement = (tally.max(axis=1) / tally.sum(axis=1)).mean()
        alone = (self.held == 1).sum() / max(1, (self.held > 0).sum())
        texts = tally[:, TEXT - 1].sum()
        crowded = ((self.facts & (_KIND | _SEVERAL)) == (TEXT | _SEVERAL)).sum() / texts * texts / full.sum() if texts else 0.0
        named = 0.5 if n_header is None else max(0.0, 1 - abs(n_header - columns) / columns)
        return float((agreement + named + full.mean() + (1 - crowded) + 2 * alone) / 6)

    def column_at(self, x0: np.ndarray, x1: np.ndarray) -> np.ndarray:
        """Columns of tokens by their centres, -1 for those over ``WIDE`` times as wide as a column."""
        typical = np.diff(self.cuts).mean() if len(self.cuts) > 1 else 100.0
        return np.where(x1 - x0 > WIDE * typical, -1, np.searchsorted(self.cuts, (x0 + x1) / 2, side="right"))


#: Cuts between columns and the column of each token.
Dealt = tuple[np.ndarray, np.ndarray]


def _by_anchors(rows: Rows) -> Iterator[Dealt]:
    """Columns from the left edges of the rows with the commonest number of tokens: tokens by their left edges, and by their middles."""
    k = Counter(rows.size.tolist()).most_common(1)[0][0]
    typical = rows.size == k
    if k < 2 or typical.sum() < 3:
        return
    edges = np.median(rows.x0[np.repeat(typical, rows.size)].reshape(-1, k), axis=0)
    cuts = (edges[1:] + edges[:-1]) / 2
    ordered = bool((cuts[1:] >= cuts[:-1]).all())  # tokens as they came need not be left to right
    for at in (rows.x0, (rows.x0 + rows.x1) / 2):
        yield cuts, np.searchsorted(cuts, at, side="right") if ordered else (cuts <= at[:, None]).sum(axis=1)


def _by_gaps(rows: Rows) -> Iterator[Dealt]:
    """Columns from the stretches that over a share of the rows' tokens cover, for each share."""
    left, right = rows.x0, rows.x1
    low, n = left.min(), int(right.max() - left.min()) + 2
    begins, stops = (left - low).astype(int), np.minimum((right - low).astype(int) + 1, n)
    covered = np.cumsum(np.bincount(begins, minlength=n + 1) - np.bincount(stops, minlength=n + 1))[:n]
    seen: set[bytes] = set()
    for share in SHARES:
        busy = np.concatenate([[0], (covered > share * len(rows.size)).astype(int), [0]])
        starts, ends = low + np.flatnonzero(np.diff(busy) == 1), low + np.flatnonzero(np.diff(busy) == -1)
        if not len(starts):
            continue
        apart = np.concatenate([[True], starts[1:] - ends[:-1] >= LEAST_GAP])
        starts, ends = starts[apart], ends[np.concatenate([apart[1:], [True]])]
        stretches = np.concatenate([starts, ends]).tobytes()
        if len(starts) < 2 or stretches in seen:
            continue
        seen.add(stretches)
        a, b = left[:, None], right[:, None]
        common = np.maximum(0.0, np.minimum(b, ends) - np.maximum(a, starts))
        nearest = np.abs((starts + ends) / 2 - (a + b) / 2).argmin(axis=1)
        yield (ends[:-1] + starts[1:]) / 2, np.where(common.max(axis=1) > 0, common.argmax(axis=1), nearest)


def _headers(grid: Grid, band: Rows) -> list[str]:
    """The band's tokens, in order, over the columns they stand above."""
    names: list[list[str]] = [[] for _ in range(grid.shape[1])]
    columns = grid.column_at(band.x0, band.x1).tolist()
    for _, at in band.each():
        for text, j in zip(band.text[at], columns[at], strict=True):
            if j >= 0:
                names[j].append(text)
    return [" ".join(n) for n in names]


def _attach_wrapped(grid: Grid, cells: list[list[str]], lines: Rows, first: float) -> None:
    """Lines of a single word below the first data row join the row above them, in columns that are half text or more."""
    short = lines.where((lines.size < LEAST_CELLS) & (np.array(lines.top) >= first))
    if not len(short.size):
        return
    kinds = grid.kinds()
    full = (kinds > 0).sum(axis=0)
    texts = (full > 0) & (2 * (kinds == TEXT).sum(axis=0) >= full)
    above = np.array(grid.rows.top)
    columns = grid.column_at(short.x0, short.x1)
    ok = (columns >= 0) & texts[columns] & ((short.facts & _KIND) == TEXT)
    for top, at in short.each():
        rows = np.flatnonzero(above <= top)
        if len(rows):
            for k in range(at.start, at.stop):
                if ok[k]:
                    row, j = cells[rows[-1]], columns[k]
                    row[j] = f"{row[j]} {short.text[k]}".strip()


def _fold_signs(rows: list[list[str]], body: int) -> list[list[str]]:
    """Columns of nothing but signs go into the column to their right; ``body``: first row that isn't a header."""
    j = 0
    while rows and j < len(rows[0]) - 1:
        signs = 0
        for r in rows[body:]:
            if value := r[j].strip():
                if not _SIGN.match(value):
                    signs = 0
                    break
                signs += 1
        if signs >= 2:
            rows = [[*r[:j], f"{r[j]} {r[j + 1]}".strip(), *r[j + 2 :]] for r in rows]
        else:
            j += 1
    return rows


def reconstruct(tokens: pd.DataFrame | Columns) -> tuple[str, float] | None:
    """Html and score of a table from its tokens (line_idx, seq, text, x0, x1, y0), or None: garbled, or no grid of three rows."""
    at, seq, text, x0, x1, y0 = (np.asarray(tokens[c]) for c in ("line_idx", "seq", "text", "x0", "x1", "y0"))
    step = np.diff(at)
    if not ((step > 0) | ((step == 0) & (np.diff(seq) >= 0))).all():
        order = np.lexsort((seq, at))
        at, text, x0, x1, y0 = at[order], text[order], x0[order], x1[order], y0[order]
    ends = np.flatnonzero(np.append(at[1:] != at[:-1], True)) + 1
    starts = np.append(0, ends[:-1])
    words = text.tolist()
    lines = Rows(y0[starts].tolist(), ends - starts, words, x0, x1, np.fromiter(map(_facts, words), np.int64, len(words)))
    sample = " ".join(words[: ends[:40][-1]])
    if not sample or len(_ODD.findall(sample)) > MOST_ODD * len(sample):
        return None
    top = np.array(lines.top, float)
    rich = lines.size >= LEAST_CELLS
    numeric = rich & (np.add.reduceat((lines.facts & _STARTS) > 0, starts, dtype=np.int64) > 0.5 * lines.size)
    first = float(top[numeric].min()) if numeric.any() else None
    if first is None and rich.any():
        first = float(top[rich].min())
        first = first if top.min() < first else None
    start = first if first is not None else -np.inf
    data, above = rich & (top >= start), top < start
    if data.sum() < LEAST_ROWS:
        return None
    rows, band = lines.where(data), lines.where(above)
    n_header = int((band.x1 - band.x0 < 200).sum()) or None
    best: tuple[float, Grid] | None = None
    seen: set[tuple[int, bytes]] = set()
    for cuts, column in chain(_by_anchors(rows), _by_gaps(rows)):
        made = len(cuts), column.astype(np.int64).tobytes()
        if made not in seen:  # the same cells score alike, and of equals the first counts
            seen.add(made)
            grid = Grid(rows, cuts, column)
            score = grid.score(n_header)
            if best is None or score > best[0]:
                best = score, grid
    if best is None:
        return None
    score, grid = best
    cells = grid.cells()
    if first is not None:
        _attach_wrapped(grid, cells, lines, first)
    out = _fold_signs([_headers(grid, band), *cells] if len(band.size) else cells, 1)
    tags = {"th": "</th><th>", "td": "</td><td>"}
    safe = not _MARKUP.search("".join(words))
    cell = lambda tag, row: f"<{tag}>{tags[tag].join(row if safe else map(escape, row))}</{tag}>"
    body = "".join([f"<tr>{cell('td', r)}</tr>" for r in out[1:]])
    return f"<table><thead><tr>{cell('th', out[0])}</tr></thead><tbody>{body}</tbody></table>", score


def _solve(columns: Columns, groups: Groups) -> tuple[list[int], dict[str, list]]:
    found = [(a, reconstruct({k: c[a:b] for k, c in columns.items()})) for a, b in groups]
    made = [(a, *f) for a, f in found if f is not None]
    return [m[0] for m in made], {"html": [m[1] for m in made], "score": [m[2] for m in made]}


def _solve_lines(columns: Columns, groups: Groups) -> tuple[list[int], dict[str, list]]:
    """Lines come with their tokens as arrays: these are laid end to end, and of each group's places."""
    tokens = columns["tokens"].combine_chunks()
    ends = np.append(0, np.cumsum(pc.list_value_length(tokens).to_numpy()))
    flat = {k: v.to_numpy(zero_copy_only=False) for k, v in zip(("seq", "text", "x0", "x1"), tokens.flatten().flatten(), strict=True)}
    flat |= {k: np.repeat(columns[k], np.diff(ends)) for k in ("line_idx", "y0")}
    rows = [a for a, b in groups if ends[a] < ends[b]]
    at, made = _solve(flat, [(int(ends[a]), int(ends[b])) for a, b in groups if ends[a] < ends[b]])
    row_of = {int(ends[a]): a for a in rows}
    return [row_of[x] for x in at], made


_MADE = {"html": T.StringType(), "score": T.DoubleType()}


def reconstruct_tables(tokens: DataFrame) -> DataFrame:
    """(table, html, score) of the tables whose tokens make a grid. A table's tokens are one group, bounded by a page."""
    return solve_groups(tokens.select(*TABLE, "line_idx", "seq", "text", "x0", "x1", "y0"), TABLE, ["line_idx", "seq"], TABLE, _MADE, _solve)


def reconstruct_lines(lines: DataFrame) -> DataFrame:
    """As ``reconstruct_tables``, of rows of several tokens: table, line_idx, y0, tokens (array of seq, text, x0, x1). A row is shuffled, not each token."""
    return solve_groups(lines.select(*TABLE, "line_idx", "y0", "tokens"), TABLE, ["line_idx"], TABLE, _MADE, _solve_lines)
