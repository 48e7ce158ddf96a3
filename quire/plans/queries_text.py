"""Queries of the text and geometry functions, each over all lines, pages or boxes of the data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions import geometry as G
from quire.functions import text as X
from quire.plans.fixtures import doc_lines, layout, lines_boxed, with_fixtures
from quire.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _line_query(name: str, columns: Callable[[], dict[str, Column]], sql: str) -> None:
    """A projection of every document line."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return doc_lines(spark, sf_dir).select("doc_id", "line_idx", *[c.alias(k) for k, c in columns().items()])

    QUERIES[name] = query
    ORACLES[name] = with_fixtures(f"SELECT doc_id, line_idx, {sql} FROM doc_lines", "doc_lines")


_T = lambda: F.col("text")
# Lines are given the traits that each function looks for, alike in both engines.
_tagged = lambda: F.concat(F.lit("<b>"), "text", F.lit("</b> <b>x</b><b>y</b>&amp; <i>z</i>"))
_TAGGED = "'<b>' || text || '</b> <b>x</b><b>y</b>&amp; <i>z</i>'"
_persian = lambda: F.translate(F.lower(_T()), "abcdefghij", "يكةابلمن٣ّ")
_PERSIAN = "translate(lower(text), 'abcdefghij', 'يكةابلمن٣ّ')"
_FOLD = f"translate(translate({{}}, '{X.PERSIAN_FROM}', '{X.PERSIAN_TO}'), '{X.ARABIC_DIGITS}', '{X.PERSIAN_DIGITS}')"


def t1_html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.html_to_text(F.col("html")).alias("text"))


QUERIES["t1_html_to_text"] = t1_html_to_text
_ENT = "regexp_replace(html, '<[^>]+>', ' ', 'g')"
for _e, _c in X.ENTITIES.items():
    _ENT = "replace({}, '{}', '{}')".format(_ENT, _e, _c.replace("'", "''"))
ORACLES["t1_html_to_text"] = f"SELECT page_id, trim(regexp_replace({_ENT}, '[\\s\\x{{00a0}}]+', ' ', 'g')) AS text FROM pages"

_line_query("t2_normalize_spaces", lambda: {"v": X.normalize_spaces(F.replace(_T(), F.lit(" e"), F.lit(" e")))}, "replace(replace(text, ' e', chr(8195) || 'e'), chr(8195), ' ') AS v")


def t3_cleanup_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    loose = F.concat(F.replace("text", F.lit("\n"), F.lit("\n\n\n\n")), F.lit(" \n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.cleanup_text(loose)).alias("v"))


QUERIES["t3_cleanup_text"] = t3_cleanup_text
ORACLES["t3_cleanup_text"] = r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(10), repeat(chr(10), 4)) || ' ' || chr(10), '\n{3,}', chr(10) || chr(10), 'g'),
  '(\n\s){3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS v FROM documents"""

_line_query(
    "t4_escape_markdown",
    lambda: {"t": X.escape_markdown(F.concat(F.lit("$"), _T())), "l": X.escape_markdown(F.concat(F.lit("[a](b) "), _T()), "link"), "c": X.escape_markdown(F.concat(_T(), F.lit("|\n")), "cell")},
    r"replace('$' || text, '$', '\$') AS t, regexp_replace('[a](b) ' || text, '([\[\]()])', '\\\1', 'g') AS l, translate(text || '|' || chr(10), '|' || chr(10), '  ') AS c",
)
_line_query("t5_merge_consecutive_tags", lambda: {"v": X.merge_consecutive_tags(_tagged(), "b")}, f"regexp_replace(replace({_TAGGED}, '</b><b>', ''), '</b>\\s+<b>', ' ', 'g') AS v")
_line_query(
    "t6_unwrap_math",
    lambda: {"v": X.unwrap_math(F.when(F.col("line_idx") % 2 == 0, F.concat(F.lit("<math display='inline'>"), F.regexp_replace(_T(), r"[\^_\\{}]", ""), F.lit("</math>"))).otherwise(F.concat(F.lit("<math>x^2 "), _T(), F.lit("</math>"))))},
    r"CASE WHEN line_idx % 2 = 0 THEN trim(regexp_replace(text, '[\^_\\{}]', '', 'g')) ELSE '<math>x^2 ' || text || '</math>' END AS v",
)


def t7_dehyphenate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = doc_lines(spark, sf_dir).withColumn("text", F.regexp_replace("text", r"[.,]$", "-"))
    w = W.partitionBy("doc_id").orderBy("line_idx")
    return lines.select("doc_id", "line_idx", "text", F.lower(F.lead("text").over(w)).alias("n")).select("doc_id", "line_idx", X.dehyphenate(F.col("text"), F.col("n")).alias("v"))


QUERIES["t7_dehyphenate"] = t7_dehyphenate
ORACLES["t7_dehyphenate"] = with_fixtures(
    r""", h AS (SELECT doc_id, line_idx, regexp_replace(text, '[.,]$', '-') AS text FROM doc_lines),
n AS (SELECT *, lower(lead(text) OVER (PARTITION BY doc_id ORDER BY line_idx)) AS n FROM h)
SELECT doc_id, line_idx, CASE WHEN regexp_matches(text, '[-—¬]\s?$') AND regexp_matches(coalesce(n, ''), '^\s?\p{Ll}') THEN regexp_replace(text, '[-—¬](\s?)$', '\1') ELSE text END AS v FROM n""",
    "doc_lines",
)
_line_query(
    "t9_font_formats",
    lambda: {"v": F.array_join(X.font_formats(F.char_length("text").cast("int") * 37, F.when(F.col("line_idx") % 3 == 0, F.lit("Arial-BoldItal"))), ",")},
    f"""concat_ws(',',
  CASE WHEN line_idx % 3 = 0 OR (NOT s AND k & {X._mask('ForceBold')} <> 0) THEN 'bold' END,
  CASE WHEN line_idx % 3 = 0 OR (NOT s AND k & {X._mask('Italic')} <> 0) THEN 'italic' END,
  CASE WHEN s OR k & {X._mask('FixedPitch', 'Serif', 'Script', 'Nonsymbolic', 'AllCap', 'SmallCap', 'UseExternAttr')} <> 0 THEN 'plain' END) AS v
FROM (SELECT *, k IN (0, {X._mask('Symbolic', 'Italic')}, {X._mask('Symbolic', 'Italic', 'UseExternAttr')}, {X._mask('UseExternAttr')}) AS s FROM (SELECT *, (length(text) * 37) & {X._mask(*X.FONT_FLAGS.values())} AS k FROM doc_lines)) --""",
)
ORACLES["t9_font_formats"] = ORACLES["t9_font_formats"].split(" --")[0]
_line_query(
    "t10_replace_bullets", lambda: {"v": X.replace_bullets(F.concat(F.when(F.col("line_idx") % 2 == 0, "• ").otherwise("<p>- "), _T()))},
    rf"regexp_replace(CASE WHEN line_idx % 2 = 0 THEN '• ' ELSE '<p>- ' END || text, '(^|[\n ]|<[^>]*>)[{X.BULLETS}]( )', '\1\2', 'g') AS v",
)
_line_query(
    "t11_is_list_start", lambda: {"v": X.is_list_start(F.concat(F.element_at(F.array(*map(F.lit, ["• ", "1. ", "(iv) ", "a) ", "", "12 "])), (F.col("line_idx") % 6 + 1)), _T()))},
    rf"regexp_matches(['• ', '1. ', '(iv) ', 'a) ', '', '12 '][line_idx % 6 + 1] || text, '^\s*(?:[{X.BULLETS}]|\(?\d{{1,3}}[.)]|\(?[a-zA-Z][.)]|\(?[ivxlcIVXLC]{{1,5}}[.)])\s') AS v",
)
_line_query(
    "t12_detect_bad_text",
    lambda: {"v": X.detect_bad_text(F.when(F.col("line_idx") % 4 == 0, F.regexp_replace(_T(), r"\w", "#")).when(F.col("line_idx") % 4 == 1, F.concat(_T(), F.repeat(F.lit("�"), F.lit(9)))).otherwise(_T()))},
    r"""CASE WHEN length(t0) = 0 THEN true ELSE len(regexp_extract_all(t, '\s+')) / (len(regexp_extract_all(t, '\s+')) + length(regexp_replace(t, '\s+', '', 'g'))) > 0.7
   OR len(regexp_extract_all(t, '\n+')) / (len(regexp_extract_all(t, '\n+')) + length(regexp_replace(t, '\n+', '', 'g'))) > 0.6
   OR CASE WHEN length(replace(t, ' ', '')) = 0 THEN 1.0 ELSE (length(replace(t, ' ', '')) - length(regexp_replace(replace(t, ' ', ''), '[\p{L}\p{N}]', '', 'g'))) / length(replace(t, ' ', '')) END < 0.3
   OR length(t) - length(replace(t, chr(65533), '')) > greatest(6.0, length(t) * 0.03) END AS v
FROM (SELECT *, regexp_replace(t0, '(?:[.·•…_\-]\s*){3,}', ' ', 'g') AS t FROM (SELECT *, CASE line_idx % 4 WHEN 0 THEN regexp_replace(text, '\w', '#', 'g') WHEN 1 THEN text || repeat(chr(65533), 9) ELSE text END AS t0 FROM doc_lines)) --""",
)
ORACLES["t12_detect_bad_text"] = ORACLES["t12_detect_bad_text"].split(" --")[0]
_line_query(
    "t13_is_garbled", lambda: {"v": X.is_garbled(F.when(F.col("line_idx") % 3 == 0, F.concat(_T(), F.repeat(F.lit(""), F.lit(5)))).otherwise(_T()))},
    "CASE WHEN length(CASE WHEN line_idx % 3 = 0 THEN text || repeat(chr(57345), 5) ELSE text END) = 0 THEN true WHEN line_idx % 3 = 0 THEN 5 / (length(text) + 5) > 0.02 ELSE false END AS v",
)
_line_query(
    "t14_math_char_fraction", lambda: {"v": F.round(X.math_char_fraction(F.translate(_T(), "aeo", "α∑ℝ")), 9), "f": X.has_math_font(F.when(F.col("line_idx") % 2 == 0, "CMMI10").otherwise("Arial"))},
    "round(CASE WHEN length(text) = 0 THEN 0.0 ELSE (length(text) - length(replace(replace(replace(text, 'a', ''), 'e', ''), 'o', ''))) / length(text) END, 9) AS v, line_idx % 2 = 0 AS f",
)
_line_query(
    "t15_header_clean", lambda: {"v": X.header_clean(F.concat(F.col("line_idx").cast("string"), F.lit(" "), _T(), F.lit(" "), F.col("page_id").cast("string")))},
    r"regexp_replace(regexp_replace(trim(concat(line_idx, ' ', text, ' ', page_id)), '^\d+\s*', ''), '\s*\d+$', '') AS v",
)
_line_query(
    "t16_normalize_fa", lambda: {"v": X.normalize_fa(_persian())},
    r"trim(regexp_replace(regexp_replace(regexp_replace(replace(" + _FOLD.format(_PERSIAN) + r", 'اال', 'الا'), '(^|[^\p{Lo}\p{Ll}\p{Lu}\p{Mn}])[" + X.MARKS + r"]+', '\1', 'g'), ' +', ' ', 'g'), '\s+([،؛,.!؟?:])', '\1', 'g')) AS v",
)
_line_query(
    "t18_suspect_lam_alef", lambda: {"v": F.array_join(X.suspect_lam_alef(_persian()), " ")},
    r"array_to_string(list_filter(regexp_extract_all(" + _PERSIAN + rf", '[\x{{0600}}-\x{{06ff}}\x{{200c}}]+'), lambda w: regexp_matches(w, '^[^ا]*(ا+[{X.MARKS}]*[^ال{X.MARKS}][^ا]*)*.*ا[{X.MARKS}]*ل') AND length(regexp_extract(w, '^(.*?)ا[{X.MARKS}]*ل', 1)) > 0), ' ') AS v",
)
_line_query(
    "t19_digits_to_int", lambda: {"v": X.digits_to_int(F.translate(F.char_length("text").cast("string"), "0123456789", X.PERSIAN_DIGITS)), "n": X.digits_to_int(_T())},
    "length(text) AS v, CASE WHEN regexp_matches(trim(text), '^[0-9]+$') THEN TRY_CAST(trim(text) AS BIGINT) END AS n",
)
_line_query("t20_compact", lambda: {"v": X.compact(_persian())}, rf"regexp_replace(translate(translate({_PERSIAN}, '{X.PERSIAN_FROM}', '{X.PERSIAN_TO}'), '{X.PERSIAN_DIGITS}{X.ARABIC_DIGITS}', '{X.ASCII_DIGITS * 2}'), '[^\p{{Lu}}\p{{Ll}}\p{{Lt}}\p{{Lo}}\p{{N}}]', '', 'g') AS v")
_ORD = sorted(X.ordinals().items())


def _word() -> Column:
    return F.element_at(F.array(*[F.lit(w) for w, _ in _ORD], F.lit("متن")), (F.col("line_idx") * 7 % (len(_ORD) + 1) + 1).cast("int"))


_line_query("t21_ordinal_to_int", lambda: {"v": X.ordinal_to_int(F.concat(_word(), F.lit(" ")))}, f"[{', '.join(str(n) for _, n in _ORD)}, NULL][line_idx * 7 % {len(_ORD) + 1} + 1] AS v")
_line_query(
    "t22_make_id", lambda: {"v": X.make_id(F.lit("b1"), "concept", _T(), F.col("line_idx")), "o": X.ordinal_id(F.lit("b1"), "lesson", F.col("page_id"), F.col("line_idx"))},
    r"'b1:concept:' || substr(sha256('b1|concept|' || lower(trim(regexp_replace(regexp_replace(regexp_replace(text, '[ \x{00a0}]+', ' ', 'g'), '\s+([،؛,.!؟?:])', '\1', 'g'), '\s+', ' ', 'g'))) || '|' || line_idx), 1, 10) AS v, "
    "'b1:lesson:' || lpad(page_id::VARCHAR, greatest(2, length(page_id::VARCHAR))::INT, '0') || '.' || lpad(line_idx::VARCHAR, greatest(2, length(line_idx::VARCHAR))::INT, '0') AS o",
)
_line_query(
    "t25_split_trailing_page",
    lambda: {"t": X.split_trailing_page(F.concat(_T(), F.lit(" ..... "), F.col("page_id").cast("string")))["title"], "p": X.split_trailing_page(F.concat(_T(), F.lit(" ..... "), F.col("page_id").cast("string")))["page"]},
    r"CASE WHEN length(h) > 0 AND NOT regexp_matches(h, '^[0-9]+$') THEN h END AS t, CASE WHEN length(h) > 0 AND NOT regexp_matches(h, '^[0-9]+$') THEN page_id END AS p FROM (SELECT *, regexp_replace(trim(text), '[\s.·•…_\-]+$', '') AS h FROM doc_lines) --",
)
ORACLES["t25_split_trailing_page"] = ORACLES["t25_split_trailing_page"].split(" --")[0]
_line_query("t27_strip_opening_number", lambda: {"v": X.strip_opening_number(F.concat(F.col("line_idx").cast("string"), F.lit(" "), _T()))}, r"CASE WHEN regexp_matches(text, '\S') THEN regexp_replace(text, '^\s+', '') ELSE concat(line_idx, ' ', text) END AS v")


def t28_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("doc_id").orderBy("line_idx")
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r" +"), lambda x: x != ""))
    lines = doc_lines(spark, sf_dir).select("doc_id", "line_idx", words.alias("a"))
    lines = lines.select("*", F.coalesce(F.lag("a").over(w), F.array().cast("array<string>")).alias("b"))
    return lines.select("doc_id", "line_idx", F.round(X.jaccard(F.col("a"), F.col("b")), 9).alias("v"))


QUERIES["t28_jaccard"] = t28_jaccard
ORACLES["t28_jaccard"] = with_fixtures(
    """, a AS (SELECT doc_id, line_idx, list_distinct(list_filter(regexp_split_to_array(lower(text), ' +'), lambda x: x <> '')) AS a FROM doc_lines),
b AS (SELECT *, coalesce(lag(a) OVER (PARTITION BY doc_id ORDER BY line_idx), []) AS b FROM a)
SELECT doc_id, line_idx, round(CASE WHEN len(a) > 0 AND len(b) > 0 THEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) ELSE 0.0 END, 9) AS v FROM b""",
    "doc_lines",
)
_line_query(
    "t31_cell_class", lambda: {"v": X.cell_class(F.element_at(F.array(F.lit(""), F.lit("1999"), F.concat(F.col("line_idx").cast("string"), F.lit(",000%")), F.lit("less than 5"), _T()), (F.col("line_idx") % 5 + 1).cast("int")))},
    r"CASE line_idx % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'year' WHEN 2 THEN 'num' WHEN 3 THEN 'range' ELSE CASE WHEN trim(text) = '' THEN 'empty' WHEN regexp_matches(trim(text), '^(19|20)\d\d$') THEN 'year' WHEN regexp_matches(trim(text), '^-?[\d,.]*\d[\d,.]*%?$') THEN 'num' WHEN regexp_matches(text, '(less than|to less|%)') THEN 'range' ELSE 'text' END END AS v",
)
_line_query(
    "t33_fix_equation_html", lambda: {"v": X.fix_equation_html(F.concat(F.lit("<p>"), F.when(F.col("line_idx") % 2 == 0, "<math>").otherwise("<i>"), _T(), F.lit("</math><br></p>")))},
    'CASE WHEN line_idx % 2 = 0 THEN \'<math display="block">\' || text || \'</math>\' ELSE \'\' END AS v',
)


# geometry: each line's box against the next line's, or the page
def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("doc_id").orderBy("line_idx")
    b = lines_boxed(spark, sf_dir).select("doc_id", "line_idx", G.box().alias("a"))
    return b.select("*", F.lead("a", 2).over(w).alias("b")).where("b is not null")


_PAIRS = """, p AS (SELECT doc_id, line_idx, x0 AS ax0, y0 AS ay0, x1 AS ax1, y1 AS ay1, lead(x0, 2) OVER w AS bx0, lead(y0, 2) OVER w AS by0, lead(x1, 2) OVER w AS bx1, lead(y1, 2) OVER w AS by1
  FROM lines_boxed WINDOW w AS (PARTITION BY doc_id ORDER BY line_idx)), q AS (SELECT * FROM p WHERE bx0 IS NOT NULL)
"""


def _pair_query(name: str, columns: Callable[[Column, Column], dict[str, Column]], sql: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _pairs(spark, sf_dir).select("doc_id", "line_idx", *[F.round(c, 6).alias(k) for k, c in columns(F.col("a"), F.col("b")).items()])

    QUERIES[name] = query
    ORACLES[name] = with_fixtures(_PAIRS + f"SELECT doc_id, line_idx, {sql} FROM q", "lines_boxed")


_OX, _OY = "greatest(0.0, least(ax1, bx1) - greatest(ax0, bx0))", "greatest(0.0, least(ay1, by1) - greatest(ay0, by0))"
_DX, _DY = "greatest(0.0, ax0 - bx1, bx0 - ax1)", "greatest(0.0, ay0 - by1, by0 - ay1)"
_pair_query(
    "g1_box_measures", lambda a, b: {"w": G.width(a), "h": G.height(a), "s": G.area(a), "cx": G.center(a)["x"], "cy": G.center(a)["y"]},
    "round(ax1 - ax0, 6) AS w, round(ay1 - ay0, 6) AS h, round((ax1 - ax0) * (ay1 - ay0), 6) AS s, round((ax0 + ax1) / 2, 6) AS cx, round((ay0 + ay1) / 2, 6) AS cy",
)
_pair_query(
    "g2_expand_rescale", lambda a, b: {"e": G.expand(a, 0.1, 0.2)["x0"], "r": G.rescale(a, (612, 792), (1000, 1000))["y1"], "f": G.fit_to_bounds(a, 0.0, 0.0, 300.0, 500.0)["x1"]},
    "round(ax0 - (ax1 - ax0) * 0.1, 6) AS e, round(ay1 * (1000 / 792), 6) AS r, round(greatest(least(ax1, 300.0), 0.0), 6) AS f",
)
_pair_query(
    "g3_intersection", lambda a, b: {"x": G.overlap_x(a, b), "y": G.overlap_y(a, b), "s": G.intersection_area(a, b), "p": G.intersection_pct(a, b)},
    f"round({_OX}, 6) AS x, round({_OY}, 6) AS y, round({_OX} * {_OY}, 6) AS s, round(CASE WHEN (ax1 - ax0) * (ay1 - ay0) = 0 THEN 0.0 ELSE {_OX} * {_OY} / ((ax1 - ax0) * (ay1 - ay0)) END, 6) AS p",
)
_pair_query("g4_minimum_gap", lambda a, b: {"g": G.minimum_gap(a, b)}, f"round(sqrt({_DX} * {_DX} + {_DY} * {_DY}), 6) AS g")
_pair_query(
    "g5_center_distance", lambda a, b: {"d": G.center_distance(a, b, 5.0), "m": G.center_distance(a, b, 5.0, absolute=True)},
    "round(sqrt(5 * ((ax0 + ax1 - bx0 - bx1) / 2) ** 2 + ((ay0 + ay1 - by0 - by1) / 2) ** 2), 6) AS d, round(5 * abs((ax0 + ax1 - bx0 - bx1) / 2) + abs((ay0 + ay1 - by0 - by1) / 2), 6) AS m",
)
_pair_query(
    "g8_vertical_overlap_ratio", lambda a, b: {"v": G.vertical_overlap_ratio(a, b)},
    f"round(CASE WHEN least(ay1 - ay0, by1 - by0) <= 0 THEN 0.0 ELSE {_OY} / least(ay1 - ay0, by1 - by0) END, 6) AS v",
)
_pair_query("g9_normalize_bbox", lambda a, b: {k: G.normalize_bbox(a, 612.0, 792.0)[k] for k in ("x0", "y0", "x1", "y1")}, "round(ax0 / 612 * 1000, 6) AS x0, round(ay0 / 792 * 1000, 6) AS y0, round(ax1 / 612 * 1000, 6) AS x1, round(ay1 / 792 * 1000, 6) AS y1")


def g6_merge_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_boxed(spark, sf_dir).groupBy("doc_id", "page_id").agg(*G.merge_boxes())


QUERIES["g6_merge_boxes"] = g6_merge_boxes
ORACLES["g6_merge_boxes"] = with_fixtures("SELECT doc_id, page_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM lines_boxed GROUP BY ALL", "lines_boxed")


def g7_covered_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each line that the page's text boxes cover, 1 at most."""
    li, b = lines_boxed(spark, sf_dir).alias("l"), layout(spark, sf_dir).where("block_type = 'Text' and pos % 2 = 0").alias("b")
    over = G.intersection_area(G.box(alias="l"), G.box(alias="b"))
    j = li.join(b, (F.col("l.doc_id") == F.col("b.doc_id")) & (F.col("l.page_id") == F.col("b.page_id")), "left")
    size = G.area(G.box(alias="l"))
    return j.groupBy("l.doc_id", "l.line_idx").agg(F.coalesce(F.sum(over), F.lit(0.0)).alias("o"), F.max(size).alias("s")).select(
        "doc_id", "line_idx", F.round(F.when(F.col("s") <= 0, 0.0).otherwise(F.least(F.lit(1.0), F.col("o") / F.col("s"))), 6).alias("v")
    )


QUERIES["g7_covered_fraction"] = g7_covered_fraction
ORACLES["g7_covered_fraction"] = with_fixtures(
    """SELECT l.doc_id, l.line_idx, round(CASE WHEN max((l.x1 - l.x0) * (l.y1 - l.y0)) <= 0 THEN 0.0 ELSE least(1.0,
  coalesce(sum(greatest(0.0, least(l.x1, b.x1) - greatest(l.x0, b.x0)) * greatest(0.0, least(l.y1, b.y1) - greatest(l.y0, b.y0))), 0.0) / max((l.x1 - l.x0) * (l.y1 - l.y0))) END, 6) AS v
FROM lines_boxed l LEFT JOIN layout b ON l.doc_id = b.doc_id AND l.page_id = b.page_id AND b.block_type = 'Text' AND b.pos % 2 = 0 GROUP BY ALL""",
    "lines_boxed", "layout",
)
