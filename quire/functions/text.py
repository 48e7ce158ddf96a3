"""Scalar text functions as columns: built-in expressions only, unless said otherwise."""

from __future__ import annotations

import html
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the data model: characters, folds and patterns.
WIDE_SPACES = "\u2003\u2002\u00a0\u200b\u3000"
HYPHENS = "-—¬"
BULLETS = "•●○ഠം◦■▪▫–—-"
PERSIAN_FROM, PERSIAN_TO = "يىكةأإؤۀ", "ییکهااوه"
ARABIC_DIGITS, PERSIAN_DIGITS, ASCII_DIGITS = "٠١٢٣٤٥٦٧٨٩", "۰۱۲۳۴۵۶۷۸۹", "0123456789"
MARKS = "\u064b\u064c\u064d\u064e\u064f\u0650\u0651\u0652\u0653\u0654\u0655\u0670"
ZERO_WIDTH = "\u200b\u200e\u200f\u202f\ufeff\u2060"
ZWNJ = "\u200c"
CONTROLS = "".join(map(chr, (*range(1, 10), *range(11, 32), *range(127, 160))))  # but the newline
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(f"({pattern})")))


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


@F.pandas_udf(T.StringType())
def unescape_all(s: pd.Series) -> pd.Series:
    """Every HTML entity (vectorised over the batch)."""
    return s.map(html.unescape, na_action="ignore")


def html_to_text(text: Column, full_entities: bool = False) -> Column:
    """Tags become spaces, entities characters, white space single spaces."""
    bare = F.regexp_replace(text, r"<[^>]+>", " ")
    plain = unescape_all(bare) if full_entities else reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), bare)
    return F.btrim(F.regexp_replace(plain, r"[\s\u00a0]+", " "))


def normalize_spaces(text: Column) -> Column:
    return F.translate(text, WIDE_SPACES, " " * len(WIDE_SPACES))


def cleanup_text(md: Column) -> Column:
    """At most one blank line in a row; trimmed."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(md, r"\n{3,}", "\n\n"), r"(\n\s){3,}", "\n\n"), r"^\s+|\s+$", "")


def escape_markdown(text: Column, where: str = "text") -> Column:
    if where == "link":
        return F.regexp_replace(text, r"([\[\]()])", r"\\$1")
    if where == "cell":
        return F.translate(text, "\n|", "  ")
    return F.replace(text, F.lit("$"), F.lit("\\$"))


def merge_consecutive_tags(html_text: Column, tag: str) -> Column:
    """``</b> <b>`` goes; a gap of white space leaves one space; nested pairs as well.

    A pass takes the innermost pairs, so there are as many passes as a run of end tags before a start tag is long.
    """
    once = lambda t: F.regexp_replace(F.regexp_replace(t, f"</{tag}><{tag}>", ""), rf"</{tag}>\s+<{tag}>", " ")
    runs = F.transform(F.regexp_extract_all(html_text, F.lit(rf"((?:</{tag}>\s*)+)<{tag}>")), lambda r: F.size(F.split(r, f"</{tag}>")) - 1)
    passes = F.coalesce(F.array_max(runs), F.lit(0))
    return F.when(passes > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(passes, F.lit(1))), html_text, lambda t, _: once(t))).otherwise(html_text)


def merge_consecutive_math(html_text: Column) -> Column:
    """Inline maths that ends in a hyphen goes on in the next one, with a space in the hyphen's place."""
    return F.regexp_replace(html_text, r"""-</math>\s*<math(?: display=["']inline["'])?>""", " ")


def unwrap_math(text: Column) -> Column:
    """Drop a math wrapper that holds nothing mathematical."""
    inner = F.regexp_replace(text, r"(?s)^\s*<math\b[^>]*>|</math>\s*$", "")
    inner = F.regexp_replace(inner, r"^\s*\\\\\s*|\s*\\\\\s*$", "")
    inner = F.regexp_replace(inner, r"\\text[a-zA-Z]*\s*\{(.*?)\}", "$1")
    inner = F.regexp_replace(inner, r"\\([%$_&#‰])", "$1")
    return F.when(text.rlike(r"(?s)^<math\b[^>]*>.*?</math>") & ~inner.rlike(r"[\^_\\{}]"), F.btrim(inner)).otherwise(text)


def dehyphenate(line: Column, following: Column) -> Column:
    """Drop the last hyphen if the line ends in one and the next starts in lower case."""
    broken = line.rlike(rf"[{HYPHENS}]\s?$") & F.coalesce(following, F.lit("")).rlike(r"^\s?\p{Ll}")
    return F.when(broken, F.regexp_replace(line, rf"[{HYPHENS}](\s?)$", "$1")).otherwise(line)


#: Names of the font flag bits, by position from 1.
FONT_FLAGS = {1: "FixedPitch", 2: "Serif", 3: "Symbolic", 4: "Script", 6: "Nonsymbolic", 7: "Italic", 17: "AllCap", 18: "SmallCap", 19: "ForceBold", 20: "UseExternAttr"}


def _mask(*names: str) -> int:
    return sum(1 << (bit - 1) for bit, name in FONT_FLAGS.items() if name in names)


def font_formats(flags: Column, name: Column) -> Column:
    """Sorted array of plain, bold, italic from font flags and the font's name."""
    known = flags.bitwiseAND(_mask(*FONT_FLAGS.values()))
    simple = known.isin(0, _mask("Symbolic", "Italic"), _mask("Symbolic", "Italic", "UseExternAttr"), _mask("UseExternAttr"))
    has = lambda *names: known.bitwiseAND(_mask(*names)) != 0
    upright = has("FixedPitch", "Serif", "Script", "Nonsymbolic", "AllCap", "SmallCap", "UseExternAttr")
    low = F.lower(F.coalesce(name, F.lit("")))
    found = F.array(
        F.when(low.contains("bold") | (~simple & has("ForceBold")), F.lit("bold")),
        F.when(low.contains("ital") | (~simple & has("Italic")), F.lit("italic")),
        F.when(flags.isNull() | simple | upright, F.lit("plain")),
    )
    return F.array_compact(found)


def replace_bullets(text: Column) -> Column:
    """Remove bullet glyphs that start an item."""
    return F.regexp_replace(text, rf"(^|[\n ]|<[^>]*>)[{BULLETS}]( )", "$1$2")


def is_list_start(text: Column) -> Column:
    return text.rlike(rf"^\s*(?:[{BULLETS}]|\(?\d{{1,3}}[.)]|\(?[a-zA-Z][.)]|\(?[ivxlcIVXLC]{{1,5}}[.)])\s")


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def detect_bad_text(text: Column) -> Column:
    """Too many spaces, newlines or invalid characters, or too few letters and digits."""
    runs = lambda c, mark: F.char_length(c) - F.char_length(F.replace(c, F.lit(mark), F.lit("")))

    def judge(x: Column) -> Column:
        t, spaced, lined, packed = x["t"], x["spaced"], x["lined"], x["packed"]
        spaces, newlines = runs(spaced, " "), runs(lined, "\n")
        ratio = F.when(F.char_length(packed) == 0, 1.0).otherwise((F.char_length(packed) - x["odd"]) / F.char_length(packed))
        return (spaces / F.char_length(spaced) > 0.7) | (newlines / F.char_length(lined) > 0.6) | (ratio < 0.3) | (runs(t, "\ufffd") > F.greatest(F.lit(6.0), F.char_length(t) * 0.03))

    def parts(t: Column) -> Column:
        packed = F.translate(t, " \n", "")
        lined = F.when(t.contains("\n"), F.regexp_replace(t, r"\n+", "\n")).otherwise(t)
        return bind(F.struct(t.alias("t"), F.regexp_replace(t, r"\s+", " ").alias("spaced"), lined.alias("lined"), packed.alias("packed"), F.char_length(_without(packed, r"[\p{L}\p{N}]+")).alias("odd")), judge)

    bad = bind(F.regexp_replace(text, r"(?:[.·•…_\-]\s*){3,}", " "), parts)
    return F.when(F.char_length(text) == 0, True).otherwise(bad)


def is_garbled(text: Column) -> Column:
    odd = F.char_length(text) - F.char_length(_without(text, r"[\x{E000}-\x{F8FF}\x{FFFD}]"))
    return F.when(F.char_length(text) == 0, True).otherwise(odd / F.char_length(text) > 0.02)


#: Fixed ranges of mathematical characters and hints in the names of mathematical fonts.
MATH_RANGES = r"[\x{0370}-\x{03FF}\x{2070}-\x{209F}\x{2100}-\x{214F}\x{2190}-\x{21FF}\x{2200}-\x{22FF}\x{2A00}-\x{2AFF}]"
MATH_FONTS = ["cmmi", "cmsy", "cmex", "msam", "msbm", "stix", "mathjax", "math", "symbol"]


def math_char_fraction(text: Column) -> Column:
    return F.when(F.char_length(text) > 0, (F.char_length(text) - F.char_length(_without(text, MATH_RANGES))) / F.char_length(text)).otherwise(0.0)


def has_math_font(font: Column) -> Column:
    return F.lower(F.coalesce(font, F.lit(""))).rlike("|".join(MATH_FONTS))


def header_clean(text: Column) -> Column:
    """Without newlines and digits at either end."""
    return F.regexp_replace(F.regexp_replace(F.btrim(F.replace(text, F.lit("\n"), F.lit(""))), r"^\p{Nd}+\s*", ""), r"\s*\p{Nd}+$", "")


def fold_persian(text: Column) -> Column:
    """Arabic letter forms and digits as Persian ones."""
    return F.translate(F.translate(text, PERSIAN_FROM, PERSIAN_TO), ARABIC_DIGITS, PERSIAN_DIGITS)


def normalize_fa(text: Column, characters: bool = True, digits: bool = True, double_alef: bool = True, marks: bool = True, zwnj: bool = False, whitespace: bool = True) -> Column:
    """Persian normalisation; steps in fixed order, each with a switch."""
    t = text
    if characters:
        t = F.translate(t, PERSIAN_FROM, PERSIAN_TO)
    if digits:
        t = F.translate(t, ARABIC_DIGITS, PERSIAN_DIGITS)
    if double_alef:
        t = F.replace(t, F.lit("اال"), F.lit("الا"))
    if marks:  # a text of one byte a character has none
        t = once(t, lambda x: F.when(F.octet_length(x) == F.char_length(x), x).otherwise(F.regexp_replace(x, rf"(?<![\p{{Lo}}\p{{Ll}}\p{{Lu}}\p{{Mn}}])[{MARKS}]+", "")))
    if zwnj:
        t = insert_zwnj(t)
    if whitespace:  # patterns run where a plain search finds something for them
        has = lambda x, *what: reduce(lambda a, b: a | b, [F.contains(x, F.lit(w)) for w in what])
        t = once(F.translate(t, ZERO_WIDTH + CONTROLS, ""), lambda x: F.when(has(x, "  ", "\u00a0"), F.regexp_replace(x, r"[ \u00a0]+", " ")).otherwise(x))
        t = once(t, lambda x: F.when(has(x, "\n"), F.regexp_replace(F.regexp_replace(x, r" *\n *", "\n"), r"\n{3,}", "\n\n")).otherwise(x))
        t = F.btrim(F.regexp_replace(t, r"\s+([،؛,.!؟?:])", "$1"), F.lit(" \t\n\x0b\x0c\r"))
    return t


def insert_zwnj(text: Column) -> Column:
    t = F.regexp_replace(text, rf"([\u0600-\u06ff])ه(ها(?:ی|یی)?)(?![\p{{L}}\p{{N}}_])", rf"$1ه{ZWNJ}$2")
    return F.regexp_replace(t, r"(?<![\p{L}\p{N}_])(ن?می)([\u0600-\u06ff]{3,})", rf"$1{ZWNJ}$2")


def suspect_lam_alef(text: Column) -> Column:
    """Words whose first alef-lam isn't at their start."""
    words = F.regexp_extract_all(text, F.lit(rf"([\u0600-\u06ff{ZWNJ}]+)"))
    return F.filter(words, lambda w: F.regexp_instr(w, F.lit(rf"ا[{MARKS}]*ل")) > 1)


def digits_to_int(text: Column) -> Column:
    """Value of a token of ASCII, Persian or Arabic digits, else null."""
    t = F.translate(F.btrim(text), PERSIAN_DIGITS + ARABIC_DIGITS, ASCII_DIGITS * 2)
    return F.when(t.rlike("^[0-9]+$"), t.try_cast("bigint"))


def compact(text: Column) -> Column:
    """Letters (no modifiers) and numbers alone, folded, digits in ASCII."""
    t = F.translate(F.translate(text, PERSIAN_FROM, PERSIAN_TO), PERSIAN_DIGITS + ARABIC_DIGITS, ASCII_DIGITS * 2)
    return F.regexp_replace(t, r"[^\p{Lu}\p{Ll}\p{Lt}\p{Lo}\p{N}]", "")


# Persian ordinal words.
ORDINAL_UNITS = {
    "یکم": 1, "اول": 1, "اولین": 1, "دوم": 2, "سوم": 3, "چهارم": 4, "پنجم": 5, "ششم": 6, "هفتم": 7, "هشتم": 8, "نهم": 9, "دهم": 10, "یازدهم": 11,
    "دوازدهم": 12, "سیزدهم": 13, "چهاردهم": 14, "پانزدهم": 15, "شانزدهم": 16, "هفدهم": 17, "هجدهم": 18, "نوزدهم": 19,
}
ORDINAL_TENS = {"بیست": 20, "سی": 30, "چهل": 40, "پنجاه": 50}
ORDINAL_WHOLE = {"بیستم": 20, "سیام": 30, "چهلم": 40, "پنجاهم": 50}


def ordinals() -> dict[str, int]:
    joined = {f"{t}و{u}": a + b for t, a in ORDINAL_TENS.items() for u, b in ORDINAL_UNITS.items()}
    return {**joined, **ORDINAL_WHOLE, **ORDINAL_UNITS}


def ordinal_to_int(text: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ordinals().items() for x in pair])
    return F.element_at(known, compact(text))


#: Characters of a unit's word, at most.
UNIT_WORD = 8


def unit_heading(title: Column, most: int = UNIT_WORD) -> Column:
    """(word, index) that a contents row declares, or nulls: a word and an ordinal, a word and a numeral, or a leading index.

    Read on the compact title; of several ordinals the earliest counts, then the longest.
    """
    return bind(compact(title), lambda t: compact_heading(t, most))


def compact_heading(t: Column, most: int = UNIT_WORD) -> Column:
    """The same of a title that is compact already."""
    known = ordinals()
    # the shortest lead, then the longest word, as alternatives are tried in order
    ordinal = rf"^(.{{1,{most}}}?)({'|'.join(sorted(known, key=len, reverse=True))})"
    value = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    numeral, leading = rf"^([^0-9]{{1,{most}}})([0-9]{{1,2}})(?![0-9])", r"^([0-9]{1,2})(?![0-9])"

    return (
        F.when(t.rlike(ordinal), F.struct(F.regexp_extract(t, ordinal, 1).alias("word"), F.element_at(value, F.regexp_extract(t, ordinal, 2)).cast("int").alias("index")))
        .when(t.rlike(numeral), F.struct(F.regexp_extract(t, numeral, 1).alias("word"), F.regexp_extract(t, numeral, 2).cast("int").alias("index")))
        .when(t.rlike(leading), F.struct(F.lit("").alias("word"), F.regexp_extract(t, leading, 1).cast("int").alias("index")))
    )


def id_slug(text: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(normalize_fa(F.coalesce(text, F.lit(""))), r"\s+", " ")))


def make_id(book: Column, kind: str, *parts: Column) -> Column:
    """book:kind:first 10 hex digits of the hash of the canonical parts."""
    payload = F.concat_ws("|", book, F.lit(kind), F.concat_ws("|", *[id_slug(p.cast("string")) for p in parts]))
    return F.concat_ws(":", book, F.lit(kind), F.substring(F.sha2(payload, 256), 1, 10))


def ordinal_id(book: Column, kind: str, *numbers: Column) -> Column:
    two = lambda n: F.when(F.length(n.cast("string")) >= 2, n.cast("string")).otherwise(F.lpad(n.cast("string"), 2, "0"))
    return F.concat_ws(":", book, F.lit(kind), F.concat_ws(".", *[two(n) for n in numbers]))


def split_trailing_page(text: Column) -> Column:
    """(title, page) of ``title ... 64``; nulls if it isn't one."""
    pattern = rf"^(.*\S)[\s.·•…_\-]+([0-9{PERSIAN_DIGITS}{ARABIC_DIGITS}]+)$"
    title = F.regexp_replace(F.regexp_extract(F.btrim(text), pattern, 1), r"[\s.·•…_\-]+$", "")
    ok = (F.char_length(title) > 0) & digits_to_int(title).isNull()
    return F.struct(F.when(ok, title).alias("title"), F.when(ok, digits_to_int(F.regexp_extract(F.btrim(text), pattern, 2))).alias("page"))


def strip_opening_number(text: Column) -> Column:
    return F.regexp_replace(text, rf"^\s*[0-9{PERSIAN_DIGITS}{ARABIC_DIGITS}]+\s+(?=\S)", "")


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two token arrays; 0 if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(0.0)


#: Fixed patterns of the kinds of table cells, in their order.
CELL_PATTERNS = {"year": r"^(19|20)\d\d$", "num": r"^-?[\d,.]*\d[\d,.]*%?$", "range": r"(less than|to less|%)"}


def cell_class(text: Column) -> Column:
    """``empty``, the first of ``CELL_PATTERNS`` that suits, or ``text``."""
    c = F.btrim(text)
    return F.when(c == "", "empty").otherwise(F.coalesce(*[F.when(c.rlike(p), F.lit(kind)) for kind, p in CELL_PATTERNS.items()], F.lit("text")))


def fix_equation_html(text: Column) -> Column:
    """One block of display maths, or an empty text if there is none."""
    t = F.regexp_replace(F.regexp_replace(text, r"</?p[^>]*>", ""), r"<math[^>]*>", '<math display="block">')
    return F.when(text.contains("<math"), F.regexp_replace(F.replace(t, F.lit("<br>"), F.lit("")), r"^(\\n|\s)+|(\\n|\s)+$", "")).otherwise("")


#: Fixed ranges of Arabic-script letters and marks that make words (no tatweel, no joiner), as pattern text.
ARABIC_LETTERS = r"\u0621-\u063a\u0641-\u064a\u064b-\u0655\u0670\u0671-\u06d3\u06d5\u06e5-\u06e6\u06ee-\u06ef\u06fa-\u06ff"
TATWEEL = "ـ"


def tokens(text: Column, **switches: bool) -> Column:
    """Arabic-script words; a joiner ends a word, a tatweel is left out. ``switches`` are those of ``normalize_fa``."""
    return F.regexp_extract_all(F.replace(normalize_fa(text, **switches), F.lit(TATWEEL), F.lit("")), F.lit(f"([{ARABIC_LETTERS}]+)"))


def joined_tokens(text: Column) -> Column:
    """The same with joiners read through."""
    return F.regexp_extract_all(F.translate(normalize_fa(text), TATWEEL + ZWNJ, ""), F.lit(f"([{ARABIC_LETTERS}]+)"))


def word_forms(text: Column) -> Column:
    """Both readings, each word once."""
    return F.array_union(tokens(text), joined_tokens(text))


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that it names many times and that is worked out once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _escaped(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), (("-\n", ""), ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")), text)


def format_span(text: Column, formats: Column, url: Column, superscript: Column) -> Column:
    """A span's html: newlines out, escaped, superscript, link, and the first format that applies."""
    ending = lambda t: F.when(t.rlike(r"-[\r\n]+$"), F.regexp_replace(t, r"[\r\n]+$", "")).otherwise(F.regexp_replace(t, r"[\r\n]+$", " "))
    whole = lambda t: F.concat(F.lit("<sup>"), t, F.lit("</sup>"))
    raise_ = lambda t: F.when(~superscript, t).when(t.rlike(r"^[0-9\W]+"), F.regexp_replace(t, r"^([0-9\W]+)(.*)", "<sup>$1</sup>$2")).otherwise(whole(t))
    link = lambda t: F.when(url.isNull(), t).otherwise(F.concat(F.lit("<a href='"), url, F.lit("'>"), t, F.lit("</a>")))
    # the first that applies wins
    tags = {"italic": "i", "bold": "b", "math": "math", "highlight": "mark", "subscript": "sub", "superscript": "sup", "underline": "u", "small": "small", "code": "code"}
    tag = F.coalesce(*[F.when(F.array_contains(formats, name), F.lit(tag)) for name, tag in tags.items()])
    block = lambda t: F.when(t.rlike(r"\\begin\{(split|align|gather|multline)\}"), F.lit(" display='block'")).otherwise(" display='inline'")
    wrap = lambda t: F.when(tag.isNull(), t).when(tag == "math", unwrap_math(F.concat(F.lit("<math"), block(t), F.lit(">"), t, F.lit("</math>")))).otherwise(F.concat(F.lit("<"), tag, F.lit(">"), t, F.lit("</"), tag, F.lit(">")))
    out = _escaped(once(F.regexp_replace(text, r"^[\r\n]+", ""), ending))
    for step in (raise_, link, wrap):
        out = once(out, step)
    return out


# Fixed folds of the benchmark's checker.
FANCY = "\u2018\u2019\u201a\u201c\u201d\u201e\uff3f\u2013\u2014\u2011\u2012\u2212\u00b5"
PLAIN = "'''" + '"""' + "_-----\u03bc"


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFC")


def bench_normalize(md: Column) -> Column:
    """Rendered text as the checker reads it: no breaks, bold or italics, single spaces, composed characters, plain punctuation."""
    t = F.regexp_replace(F.regexp_replace(md, r"<br/?>", " "), r"</?[bi]>", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(\*\*|__)(.*?)\1", "$2"), r"(\*|_)(.*?)\1", "$2")
    return F.translate(nfc(F.regexp_replace(t, r"\s+", " ")), FANCY, PLAIN)


SUPER_FROM, SUPER_TO = "0123456789+-=()n", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾ⁿ"
SUB_FROM, SUB_TO = "0123456789+-=()", "₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎"


def _plain_entities(t: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), t)


def _pieces(text: Column, borders: str, f: Callable[[Column], Column]) -> Column:
    """The text with ``f`` applied to each part between borders (a pattern of places, not characters)."""
    return F.array_join(F.transform(F.split(text, borders), f), "")


def math_to_text(math: Column) -> Column:
    """A maths element of a table cell as plain text: fractions by a slash, commands and braces left out."""
    t = _plain_entities(F.regexp_replace(math, r"(?is)^<math\b[^>]*>|</math>$", ""))
    t = F.regexp_replace(t, r"\\(?:text|mathrm)\s*\{([^}]*)\}", "$1")
    t = F.regexp_replace(t, r"\\frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", "$1/$2")
    return F.btrim(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\\[a-zA-Z]+", ""), r"[{}\\]", ""), r"\s+", " "))


def bench_postprocess(md: Column) -> Column:
    """Rendered text for the checker: maths elements, sub- and superscripts as characters, no escapes outside maths, no images.

    Entities are the common ones (``ENTITIES``).
    """
    t = _pieces(md, r"(?i)(?=<math\b)|(?<=</math>)", lambda x: F.when(x.rlike(r"(?is)^<math\b[^>]*>.*</math>$"), math_to_text(x)).otherwise(x))
    low = lambda x: F.translate(F.regexp_replace(x, r"(?i)</?sub>", ""), SUB_FROM, SUB_TO)
    high = lambda x: F.translate(F.regexp_replace(x, r"(?i)</?sup>", ""), SUPER_FROM, SUPER_TO)
    t = _pieces(t, r"(?i)(?=<su[bp]>)|(?<=</su[bp]>)", lambda x: F.when(x.rlike(r"(?is)^<sub>.*</sub>$"), low(x)).when(x.rlike(r"(?is)^<sup>.*</sup>$"), high(x)).otherwise(x))
    t = F.regexp_replace(t, r"(?i)</?su[bp]>", "")
    # maths in dollars is set apart by a character that texts don't hold
    t = F.regexp_replace(t, r"(?s)(\$\$.*?\$\$|\$[^$\n]+\$)", "\ue000$1\ue000")
    t = _pieces(t, "\ue000", lambda x: F.when(x.rlike(r"(?s)^\$.*\$$"), _plain_entities(x)).otherwise(F.regexp_replace(x, r"\\([_*$%&#.+()\[\]!>~^{}])", "$1")))
    return F.regexp_replace(t, r"!\[[^\]]*\]\([^)]*\)", "")
