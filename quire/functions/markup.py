"""HTML read as a stream of tags: balanced again, or turned into markdown. One pass a text, with a stack of open elements.

Tags that close nothing go; what lies open above the element that a tag closes is closed first; what is open at the end is
closed. A cell, row or list item ends the one before it in its table or list, a paragraph one that is open right around it.
Comments and declarations go. Null stays null.
"""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.session import bounded_batches

# Fixed HTML vocabulary: elements without content, and those that stand on lines of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside body details dialog div dl fieldset figcaption figure footer form header html main nav section summary".split())
HEADINGS = {f"h{n}": n for n in range(1, 7)}
UNSEEN = frozenset("head script style template title".split())
#: An open element that a new one ends, and the element inside which that holds.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}
#: Marks around inline elements.
MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "del": "~~", "s": "~~", "strike": "~~"}
#: Attributes of a reader's replies that say where a block was seen.
STRIPPED = frozenset({"data-bbox", "data-label"})
RULE = "-" * 48
#: Tags and attributes of other names go.
NAME = re.compile(r"[a-z_][a-z0-9_.-]*")
#: Ends a paragraph that goes on; begins a paragraph: a gap, but behind one that goes on. Texts lose these characters.
GOES_ON, BEGINS = "\0", "\1"


class _Open:
    """An open element. Elements that leave no trace write into the parts of the one around them."""

    __slots__ = ("attrs", "begin", "cells", "count", "parts", "raw", "rows", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parts: list[str], raw: bool):
        self.tag, self.attrs, self.parts, self.raw = tag, attrs, parts, raw
        self.begin, self.count = len(parts), 0
        self.rows: list[list[tuple[str, int, int, bool]]] = []
        self.cells: list[tuple[str, int, int, bool]] = []


def open_tag(tag: str, attrs: dict[str, str], gone: frozenset = frozenset()) -> str:
    return f"<{tag}" + "".join(f' {k}="{html.escape(v)}"' for k, v in attrs.items() if k not in gone) + ("/>" if tag in VOID else ">")


class _Stream(HTMLParser):
    """Keeps the stack; what an element gives is up to the subclass."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [_Open("", {}, [], False)]
        self.depth: dict[str, int] = {}

    def handle_starttag(self, tag, attrs):
        if not NAME.fullmatch(tag):
            return
        ends, inside = ENDS.get(tag, (set(), set()))
        if any(self.depth.get(t) for t in ends):
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in ends:
                    self.close_to(k)
                    break
                if self.stack[k].tag in inside:
                    break
        if tag == "p" and self.stack[-1].tag == "p":
            self.close_to(len(self.stack) - 1)
        values = {k: v or "" for k, v in attrs if NAME.fullmatch(k)}
        if tag in VOID:
            self.single(tag, values)
        else:
            self.stack.append(self.opened(tag, values))
            self.depth[tag] = self.depth.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and NAME.fullmatch(tag):
            self.close_to(len(self.stack) - 1)

    def handle_endtag(self, tag):
        if self.depth.get(tag):
            self.close_to(next(k for k in range(len(self.stack) - 1, 0, -1) if self.stack[k].tag == tag))

    def close_to(self, k: int) -> None:
        while len(self.stack) > k:
            last = self.stack.pop()
            self.depth[last.tag] -= 1
            self.closed(last)

    def whole(self, text: str) -> str:
        self.feed(text.replace(GOES_ON, "").replace(BEGINS, ""))
        self.close()
        self.close_to(1)
        return self.finish(self.stack[0].parts)

    def finish(self, parts: list[str]) -> str:
        return "".join(parts)


class _Balanced(_Stream):
    """The same markup with every tag closed, its attributes in double quotes."""

    def opened(self, tag, attrs):
        parts = self.stack[0].parts
        parts.append(open_tag(tag, attrs, STRIPPED))
        return _Open(tag, attrs, parts, True)

    def single(self, tag, attrs):
        self.stack[0].parts.append(open_tag(tag, attrs, STRIPPED))

    def closed(self, last):
        last.parts.append(f"</{last.tag}>")

    def handle_data(self, data):
        verbatim = self.stack[-1].tag in ("script", "style")
        self.stack[0].parts.append(data if verbatim else html.escape(data, quote=False))


def _glue(parts: list[str]) -> str:
    """Parts one behind another; where lines meet, the longer of both gaps stays, of two newlines at most."""
    out: list[str] = []
    gap = 0  # newlines held back
    for part in parts:
        goes_on = bool(out) and out[-1].endswith(GOES_ON)
        if goes_on and not part.strip("\n"):
            continue
        if goes_on:
            out[-1], gap = out[-1][:-1], 0
            part = part.lstrip(BEGINS)
        elif part.startswith(BEGINS) and out:
            part = "\n\n" + part[1:]
        if not part:
            continue
        lead = len(part) - len(part.lstrip("\n"))
        if lead == len(part):
            gap = min(2, max(gap, lead))
            continue
        if gap or lead:
            while out and not out[-1].rstrip(" "):
                out.pop()
            if out:
                out[-1] = out[-1].rstrip(" ")
            out.append("\n" * min(2, max(gap, lead)))
        core = part[lead:]
        if gap and not lead:
            core = core.lstrip(" ")
            if not core:
                continue
        trail = len(core) - len(core.rstrip("\n"))
        gap = min(2, trail)
        out.append(core[: len(core) - trail])
    return "".join(out) + "\n" * gap


def _escape(text: str) -> str:
    return re.sub(r"([*_$])", r"\\\1", text)


def _chomp(text: str) -> tuple[str, str, str]:
    core = text.strip()
    return (" " if core and text[0].isspace() else ""), core, (" " if core and text[-1].isspace() else "")


def _fence(text: str, least: int) -> str:
    """Backticks, more of them than the text has in a row."""
    return "`" * max(least, 1 + max((len(x) for x in re.findall("`+", text)), default=0))


def _span(attrs: dict[str, str], name: str) -> int:
    value = attrs.get(name, "").strip()
    return max(1, int(value)) if value.isascii() and value.isdigit() and len(value) < 5 else 1


def grid_of(rows: list[list[tuple]]) -> list[list[tuple[str, bool]]]:
    """(text, whether a cell begins) of every place: each cell (text, row span, column span) goes to its row's next free
    column; what its spans cover is blank, an overflow below is cut off.

    The grid has as many columns as its widest row, spans from above counted.
    """
    grid: list[dict[int, tuple[str, bool]]] = [{} for _ in rows]
    for r, cells in enumerate(rows):
        col = 0
        for text, rowspan, colspan, *_ in cells:
            while col in grid[r]:
                col += 1
            for down in range(min(max(rowspan, 1), len(rows) - r)):
                for over in range(max(colspan, 1)):
                    grid[r + down].setdefault(col + over, ("", False))
            grid[r][col] = (text, True)
            col += max(colspan, 1)
    wide = 1 + max((max(row, default=-1) for row in grid), default=-1)
    return [[row.get(c, ("", False)) for c in range(wide)] for row in grid]


def pipe_table(grid: list[list[str]]) -> str:
    """Padded rows, a rule below the first that isn't empty (empty ones before it go), a second rule for a table of one row."""
    width = [max((len(row[c]) for row in grid), default=0) for c in range(len(grid[0]) if grid else 0)]
    rule = "|" + "|".join("-" * (w + 2) for w in width) + "|"
    lines: list[str] = []
    for row in grid:
        if not lines and not any(row):
            continue
        lines.append("|" + "|".join(f" {text.ljust(w)} " for text, w in zip(row, width, strict=True)) + "|")
        if len(lines) == 1:
            lines.append(rule)
    if len(grid) == 1:
        lines.append(rule)
    return "\n".join(lines)


class _Markdown(_Stream):
    def __init__(self, paginate: bool, tables: str):
        super().__init__()
        self.paginate, self.tables = paginate, tables

    def opened(self, tag, attrs):
        top = self.stack[-1]
        if top.raw or tag in ("td", "th") or (tag == "table" and self.tables == "html"):
            inner = top.raw  # markup inside a cell, or a table that is kept, stays markup
            parts = top.parts if inner else []
            if inner or tag == "table":
                parts.append(open_tag(tag, attrs))
            return _Open(tag, attrs, parts, True)
        if tag in BLOCKS:  # a gap before and behind, no text of its own
            page = self.paginate and tag == "div" and "page" in attrs.get("class", "").split()[:1]
            top.parts.append(f"\n\n{{{attrs.get('data-page-id', '')}}}{RULE}\n\n" if page else "\n\n")
        mark = MARKS.get(tag)
        again = mark is not None and self.inside(*(t for t, m in MARKS.items() if m == mark))
        own = (mark is not None and not again) or tag in HEADINGS or tag in UNSEEN or hasattr(self, f"on_{tag}")
        return _Open(tag, attrs, [] if own else top.parts, False)

    def single(self, tag, attrs):
        top = self.stack[-1]
        if top.raw:
            top.parts.append("<br>" if tag == "br" else open_tag(tag, attrs))
        elif tag == "br":
            top.parts.append(" " if self.inside("a", *HEADINGS) else "  \n")
        elif tag == "hr":
            top.parts.append("\n\n---\n\n")
        elif tag == "img":
            title = f' "{attrs["title"]}"' if attrs.get("title") else ""
            top.parts.append(f"![{_escape(attrs.get('alt', ''))}]({attrs.get('src', '')}{title})")

    def inside(self, *tags: str) -> bool:
        return any(self.depth.get(t) for t in tags)

    def handle_data(self, data):
        top = self.stack[-1]
        if top.raw:
            top.parts.append(html.escape(data, quote=False))
            return
        if not self.inside("pre"):
            data = re.sub(r"\s+", " ", data)
        if not self.inside("pre", "code", "kbd", "samp", "math", "chem"):
            data = _escape(data)
        top.parts.append(data)

    def closed(self, last):
        above = self.stack[-1]
        if last.raw:
            self._raw_closed(last, above)
        elif last.parts is above.parts:
            if last.tag in BLOCKS:
                above.parts.append("\n\n")
        else:
            make = getattr(self, f"on_{last.tag}", None)
            text = "".join(last.parts) if last.tag == "pre" else _glue(last.parts)
            if text.startswith(BEGINS):
                text = "\n\n" + text[1:]
            if make:
                text = make(last, text)
            elif last.tag in HEADINGS:
                text = re.sub(r"\s+", " ", text).strip()
                text = f"\n\n{'#' * HEADINGS[last.tag]} {text}\n\n" if text else ""
            elif last.tag in MARKS:
                text = self._marked(MARKS[last.tag], text)
            else:
                text = ""  # unseen
            above.parts.append(text)

    def _raw_closed(self, last, above):
        if above.raw:  # inside a cell or a kept table
            last.parts.append(f"</{last.tag}>")
        elif last.tag == "table":
            above.parts.append("\n\n" + "".join(last.parts) + f"</{last.tag}>\n\n")
        else:
            row = next((o for o in reversed(self.stack) if o.tag in ("tr", "table")), above)
            row.cells.append((_cell_text(last.parts), _span(last.attrs, "rowspan"), _span(last.attrs, "colspan"), last.tag == "th"))

    @staticmethod
    def _marked(mark: str, text: str) -> str:
        """Marks don't reach over blank lines: around several blocks they are left out."""
        before, core, after = _chomp(text)
        if not core or "\n\n" in core:
            return text
        return f"{before}{mark}{core}{mark}{after}"

    def on_p(self, o, text):
        if "has-continuation" in o.attrs.get("class", "").split():
            text = text.strip()
            if o.attrs.get("block-type") in ("Text", "TextInlineMath"):
                cut = re.sub(r"[-—¬]$", "", text)
                hyphen = cut != text and (cut[-1:].islower() or cut[-1:].isdigit() or cut[-1:] == "|")
                text = cut if hyphen else f"{text} "
            return f"{BEGINS}{text}{GOES_ON}" if text.strip() else ""
        text = text.strip()
        return f"{BEGINS}{text}\n\n" if text else ""

    def on_span(self, o, text):
        return f'<span id="{html.escape(o.attrs["id"])}">{text}</span>' if o.attrs.get("id") else text

    def on_sub(self, o, text):
        return f"<{o.tag}>{text}</{o.tag}>" if text.strip() else text

    on_sup = on_sub

    def on_code(self, o, text):
        if self.inside("pre") or not text.strip():
            return text
        before, core, after = _chomp(text)
        fence = _fence(core, 1)
        pad = " " if core[0] == "`" or core[-1] == "`" else ""
        return f"{before}{fence}{pad}{core}{pad}{fence}{after}"

    on_kbd = on_samp = on_code

    def on_pre(self, o, text):
        fence = _fence(text, 3)
        return f"\n\n{fence}\n{text.strip(chr(10))}\n{fence}\n\n" if text.strip() else ""

    def on_math(self, o, text):
        text = text.strip()
        return f"\n$${text}$$\n" if o.attrs.get("display") == "block" else f" ${text}$ "

    def on_chem(self, o, text):
        return f"\n```chem\n{text.strip()}\n```\n" if text.strip() else ""

    def on_a(self, o, text):
        before, core, after = _chomp(text)
        href = o.attrs.get("href", "")
        if not core or not href:
            return text
        if core.replace("\\", "") == href and "title" not in o.attrs:
            return f"{before}<{href}>{after}"
        title = f' "{o.attrs["title"]}"' if o.attrs.get("title") else ""
        return before + "[" + re.sub(r"([\[\]()])", r"\\\1", core) + f"]({href}{title})" + after

    def on_blockquote(self, o, text):
        text = text.strip()
        return "\n\n" + "\n".join(("> " + line).rstrip() for line in text.split("\n")) + "\n\n" if text else ""

    def on_ul(self, o, text):
        text = text.strip("\n")
        if not text.strip():
            return ""
        return f"\n{text}\n" if self.inside("li") else f"\n\n{text}\n\n"

    on_ol = on_ul

    def on_li(self, o, text):
        holder = next((x for x in reversed(self.stack) if x.tag in ("ul", "ol")), None)
        bullet = "- "
        if holder is not None:
            holder.count += 1
            if holder.tag == "ol":
                start = holder.attrs.get("start", "1")
                bullet = f"{(int(start) if start.isascii() and start.isdigit() else 1) + holder.count - 1}. "
        text = text.strip()
        lines = text.split("\n")
        return "\n" + "\n".join([(bullet + lines[0]).rstrip(), *((" " * len(bullet) + line).rstrip() for line in lines[1:])]) + "\n"

    def on_dt(self, o, text):
        return f"\n\n{text.strip()}\n" if text.strip() else ""

    def on_dd(self, o, text):
        return "\n:   " + text.strip().replace("\n", "\n    ") + "\n" if text.strip() else ""

    def on_tr(self, o, text):
        table = next((x for x in reversed(self.stack) if x.tag == "table"), None)
        if table is not None:
            table.rows.append(o.cells)
            return ""
        return " ".join(c[0] for c in o.cells)

    def on_table(self, o, text):
        rows = [*o.rows, o.cells] if o.cells else o.rows
        table = pipe_table([[text for text, _ in line] for line in grid_of(rows)])
        text = text.strip()
        return (f"\n\n{text}" if text else "") + (f"\n\n{table}\n\n" if table else "")

    def on_caption(self, o, text):
        return f"\n\n{text.strip()}\n\n" if text.strip() else ""

    def finish(self, parts):
        return _glue(parts).replace(GOES_ON, "").replace(BEGINS, "")


def _cell_text(parts: list[str]) -> str:
    """A cell's own texts and elements apart by a space, but none at a break; maths in dollars, other markup as it is."""
    items, depth, held = [], 0, []
    for part in parts:
        single = part.startswith("<") and (part.endswith("/>") or part == "<br>")
        if depth == 0 and not part.startswith("<"):
            text = html.unescape(part).strip()
            items += [text.replace("$", r"\$")] if text else []
            continue
        held.append(part)
        depth += 0 if single or not part.startswith("<") else -1 if part.startswith("</") else 1
        if depth == 0:
            whole, held = "".join(held), []
            math = re.fullmatch(r"(?s)<math\b[^>]*>(.*)</math>", whole)
            items.append("<br>" if whole == "<br>" else "$" + html.unescape(re.sub(r"<[^>]*>", "", math[1])) + "$" if math else whole.replace("$", r"\$"))
    out = ""
    for k, item in enumerate(items):
        out += item if k == 0 or item == "<br>" or items[k - 1] == "<br>" else " " + item
    return out.replace("\n", " ").replace("|", " ").strip()


def clean_markdown(text: str) -> str:
    """No more than one blank line in a row, nothing blank at both ends."""
    text = re.sub(r"\n{3,}", "\n\n", text)
    return re.sub(r"(\n\s){3,}", "\n\n", text).strip()


def markdown_of(text: str, paginate: bool = False, tables: str = "pipe") -> str:
    out = clean_markdown(_Markdown(paginate, tables).whole(text))
    if paginate:
        out = "\n\n" + out
        if out.endswith(RULE):
            out += "\n\n"
    return out


def balanced(text: str) -> str:
    return _Balanced().whole(text).strip()


def html_to_markdown(text: Column, paginate: bool = False, tables: str = "pipe") -> Column:
    """Markdown of a page or document of any markup; ``tables`` are ``pipe`` tables or stay ``html``.

    Page sections (``<div class='page'>``) begin with their number and a rule if ``paginate`` is set.
    """
    if tables not in ("pipe", "html"):
        raise ValueError("tables are rendered as pipe or html")

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else markdown_of(t, paginate, tables) for t in texts], dtype=object)

    bounded_batches()
    return convert(text)


def balance_html(text: Column) -> Column:
    """The markup with every tag closed in its place, attributes quoted, a reader's box attributes gone."""

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else balanced(t) for t in texts], dtype=object)

    bounded_batches()
    return convert(text)


def clean_table_html(text: Column) -> Column:
    """Balanced markup; empty unless it has a table with a cell inside."""
    has = F.contains(text, F.lit("<table")) & text.rlike(r"(?is)<table\b.*<t[dh]\b")
    return F.when(has, balance_html(F.when(has, text))).otherwise("")
