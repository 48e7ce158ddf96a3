"""Markup: balanced again against an XML reader, markdown against a converter that walks a tree."""

import random
import xml.etree.ElementTree as ET
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import SF
from quire.functions.markup import RULE, balance_html, balanced, clean_table_html, grid_of, html_to_markdown, markdown_of, pipe_table

CASES = {
    "<p>a<b> bold </b>c_d $5</p><p>x</p>": "a **bold** c\\_d \\$5\n\nx",
    "<h1>T <br> u</h1><ul><li>a<ul><li>b</li><li>c</ul><li><p>d</p></ul><ol start=3><li>x<li>y</ol>": "# T u\n\n- a\n  - b\n  - c\n- d\n\n3. x\n4. y",
    "<p block-type='Text' class='has-continuation'>exam-</p><p block-type='Text'>ple text</p>": "example text",
    "<p block-type='Text' class='has-continuation'>one</p><p block-type='Text'>two</p>": "one two",
    "<p block-type='Text' class='has-continuation'>No-</p><h2>T</h2>": "No\n\n## T",
    "<p>f <math>x_1</math> and <math display='block'>\\frac{a}{b}</math></p><chem>C1CC</chem>": "f  $x_1$  and\n$$\\frac{a}{b}$$\n\n```chem\nC1CC\n```",
    "<pre>a\n  b</pre> <p><code>x`y</code> <a href='http://u.v/1'>see [1](a)</a> <a href='http://x.y'>http://x.y</a></p>": "```\na\n  b\n```\n\n``x`y`` [see \\[1\\]\\(a\\)](http://u.v/1) <http://x.y>",
    "<blockquote><p>q</p><blockquote><p>r</p></blockquote></blockquote><hr><img src='a.png' alt='z'>": "> q\n>\n> > r\n\n---\n\n![z](a.png)",
    "<p><b>one<br><p>two</p><p>three</p>": "one\n\ntwo\n\nthree",
    "text <sub>2</sub> <span id='p-1'>r</span> <span>s</span>": 'text <sub>2</sub> <span id="p-1">r</span> s',
    "a &lt;b&gt; &amp; c": "a <b> & c",
    "<title>t</title><script>var a='</p>';</script>x": "x",
    "<table><tr><td>54<i>.45</i>67<br>89<math>x</math></td></tr></table>": "| 54 <i>.45</i> 67<br>89 $x$ |\n|----------------------------|\n|----------------------------|",
    "<table><tr><td></td><td></td></tr><tr><th rowspan=2>A</th><th>b|c</th></tr><tr><td>$1</td></tr></table>": "| A | b c |\n|---|-----|\n|   | \\$1 |",
    "": "",
    "no markup at all": "no markup at all",
}


@pytest.mark.parametrize("html", CASES)
def test_markdown_cases(html):
    assert markdown_of(html) == CASES[html]


def test_pages_and_tables():
    html = "<div class='page' data-page-id='0'><p>a</p></div><div class='page' data-page-id='1'></div>"
    assert markdown_of(html, paginate=True) == f"\n\n{{0}}{RULE}\n\na\n\n{{1}}{RULE}\n\n"
    assert markdown_of(html) == "a"
    table = "<table><tr><td colspan='2'>a</td></tr></table>"
    assert markdown_of(table, tables="html") == '<table><tr><td colspan="2">a</td></tr></table>'


def test_grid_of_spans():
    rows = [[("a", 2, 1), ("b", 1, 2)], [("c", 3, 1), ("d", 1, 1)], [("e", 1, 1)]]
    assert [[t for t, _ in r] for r in grid_of(rows)] == [["a", "b", ""], ["", "c", "d"], ["e", "", ""]]
    assert pipe_table([]) == "" and grid_of([]) == []


TAGS = ["table", "tbody", "tr", "td", "th", "b", "i", "p", "ul", "li", "div", "math"]


def test_broken_markup_parses_again():
    rng = random.Random(4)
    for _ in range(500):
        parts = []
        for _ in range(rng.randint(0, 40)):
            tag = rng.choice(TAGS)
            parts.append(rng.choice([f"<{tag}>", f"</{tag}>", f"<{tag} a='1' data-bbox=\"0 0\">", "text & <", "&lt;", "<br>", "<img src=x>", " "]))
        made = balanced("".join(parts))
        tree = ET.fromstring(f"<root>{made}</root>")
        assert balanced(made) == made, parts
        assert not any("data-bbox" in e.attrib for e in tree.iter())
        for cell in tree.iter("td"):
            assert not any(child.tag in ("td", "th") for child in cell), made


class _Tree(HTMLParser):
    """Pages as nested lists: [tag, children], text as strings. Ends what an end tag skips over."""

    def __init__(self):
        super().__init__()
        self.stack = [["root", []]]

    def handle_starttag(self, tag, attrs):
        if tag == "p" and self.stack[-1][0] == "p":
            self.stack.pop()
        node = [tag, [], dict(attrs)]
        self.stack[-1][1].append(node)
        if tag not in ("br", "meta"):
            self.stack.append(node)

    def handle_endtag(self, tag):
        at = max((k for k, n in enumerate(self.stack) if n[0] == tag), default=0)
        if at:
            del self.stack[at:]

    def handle_data(self, data):
        self.stack[-1][1].append(data)


def _paragraphs(node, out):
    """Markdown blocks of a page: a list of blocks, the last of which takes inline text."""
    for child in node[1]:
        if isinstance(child, str):
            out[-1] += " ".join(x for x in child.split(" ")).replace("*", "\\*").replace("_", "\\_").replace("$", "\\$")
        elif child[0] in ("head", "style", "script", "title"):
            continue
        elif child[0] == "br":
            out[-1] += "\n"
        elif child[0] == "ul":
            items = []
            for li in (c for c in child[1] if not isinstance(c, str)):
                a = li[1][0]
                items.append(f"- [{a[1][0]}]({a[2]['href']})")
            out += ["\n".join(items), ""]
        elif child[0] in ("h1", "p", "div", "article", "footer", "nav", "body", "html"):
            inner = _paragraphs(child, [""])
            if child[0] == "h1":
                inner = ["# " + inner[0]]
            out += [*inner, ""]
        elif child[0] == "b":
            inner = _paragraphs(child, [""])
            full = [x for x in inner if x.strip()]
            if len(full) == 1 and "\n" not in full[0].strip():
                out[-1] += "**" + full[0].strip() + "**" + ("\n" if full[0].endswith("\n") else "")
            else:
                out[-1] += inner[0]
                out += inner[1:]
    return out


def test_web_pages_against_a_tree(spark):
    from quire.session import table

    html = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    seen = 0
    for row in entry.queries()["m3_page_markdown"](spark, SF).collect():
        tree = _Tree()
        tree.feed(html[row.page_id])
        tree.close()
        blocks = [b.strip() for b in _paragraphs(tree.stack[0], [""])]
        squeezed = lambda t: [" ".join(x.replace("**", "").split()) for x in t if x.strip()]
        assert squeezed(row.markdown.split("\n\n")) == squeezed(blocks), row.page_id
        seen += 1
    assert seen == len(html)


def test_documents_keep_their_words(spark):
    """Every word of the visible blocks is in the document's markdown, in order."""
    from quire.plans.fixtures import blocks

    shown = blocks(spark, SF).where("NOT removed AND block_type NOT IN ('PageHeader', 'PageFooter', 'Picture')").orderBy("doc_id", "page_id", "pos").select("doc_id", "text").collect()
    words = {}
    for row in shown:
        words.setdefault(row.doc_id, []).extend(w for w in row.text.split() if w.isalpha())
    for row in entry.queries()["m3_document_markdown"](spark, SF).collect():
        text = iter(row.markdown.replace("*", " ").replace("|", " ").split())
        assert all(any(w in t for t in text) for w in words.get(row.doc_id, [])), row.doc_id


def test_columns_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<table><tr><td>a"), (4, "<p>" + "x " * 50_000), (5, "<b>" * 3000 + "x"), (6, "<td>no table")], "id int, html string")
    out = {r.id: r for r in df.select("id", html_to_markdown(F.col("html")).alias("md"), balance_html(F.col("html")).alias("ok"), clean_table_html(F.col("html")).alias("table")).collect()}
    assert out[1].md is None and out[1].ok is None and out[1].table == ""
    assert out[2].md == "" and out[3].table == "<table><tr><td>a</td></tr></table>" and out[6].table == ""
    assert len(out[4].md) == 99_999 and out[5].md == "**x**"
    assert df.where("false").select(html_to_markdown(F.col("html"))).count() == 0
