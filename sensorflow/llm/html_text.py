"""Main text of web pages by minimum-cut labelling.

A page is read into blocks (runs of text between block-level tags).  A classifier
turns what is known of a block - the elements and names it stands in, its tag,
length and link share - into a log-odds; its two logistic costs are the
capacities to the terminals "content" and "boilerplate".  Blocks next to each
other and blocks of one parent element are joined by smoothness edges, heavier
the closer they stand in the DOM.  The minimum cut, found by maximum flow, is the
labelling; the text of the content side is returned.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm.common import table

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe xmp noembed noframes".split())
# Controls and what is not shown: their text stands apart from the text around them. Of one kind, LONE do not nest.
CONTROL = set("button select object noscript svg template annotation annotation-xml".split())
LONE = {"button", "select"}
BLOCK = set("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot
th thead tr ul caption""".split())
PARTING = BLOCK | CONTROL  # what end tags and implied ends of other elements do not reach across
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "tbody": {"tr", "td", "th", "tbody", "thead"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "tbody": {"table"}, "option": {"select"}}

# The classifier: log-odds for content of what a block stands in and is.
IN_ARTICLE = 4.0
ELEMENT = {"nav": -9.0, "aside": -9.0, "footer": -9.0, "form": -9.0, "menu": -9.0, "header": -7.0, "dialog": -9.0,
           "fieldset": -8.0, "figcaption": 0.0}
ROLE = {"navigation": -9.0, "banner": -8.0, "contentinfo": -9.0, "complementary": -9.0, "search": -9.0, "alert": -9.0,
        "dialog": -9.0, "form": -9.0, "note": -3.0}
BAD_NAMES = set("""ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment
comments commentary consent cookie cookies copyright disclaimer disqus feedback foot footer gdpr login masthead
menu menus meta modal nav navbar navigation newsletter notice notices overlay pager pagination popup popups privacy promo
promotion reader-comments related reply replies respond search share sharing sidebar signup skip social sponsor sponsored
subscribe subscription tags teaser toolbar topbar widget widgets alert""".split())
# A name counts as a whole: "sidebar-left" is a sidebar, "social-impact" is not social. These words do not change what it names.
PLACE_WORDS = set("""area articles bar block bottom box button buttons center container fixed float form global group icon icons
inner item items js left link links list main mobile news outer page panel posts primary right secondary site slot sticky
stories thread title top unit wrap wrapper x""".split())
# Headings and parts of an article get ids from their wording; of those only names of reader input count.
HEADINGS, PARTS = set("h1 h2 h3 h4 h5 h6".split()), set("section p li dt dd a span".split())
READER_IDS = {"comments", "respond", "disqus", "disqus_thread"}
GOOD_NAMES = set("article content entry main post story text articlebody".split())
MIXED_NAMES = {"with", "has", "no"}  # "has-sidebar" names a layout, not a sidebar
BAD_NAME, HEADER_NAME, GOOD_NAME, HIDDEN = -9.0, -6.0, 1.5, -12.0
TAG = {"p": 1.0, "h1": 1.5, "h2": 1.0, "h3": 1.0, "h4": 0.5, "blockquote": 1.0, "pre": 1.0, "li": -0.3}
LENGTH_PER, LENGTH_MOST, BIAS, LINKS = 60.0, 3.0, 0.4, -4.0
# Elements nested deeper than browsers build them belong to the deepest one kept; their text is read all the same.
MOST_DEPTH = 512
# Smoothness: next to each other, and one parent.
NEXT, SAME_PARENT, UNIT = 0.25, 0.5, 1000

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SECTION = re.compile(r"section|level\d")


@dataclass
class Element:
    tag: str
    number: int
    log_odds: float  # of all elements from the root down to this
    article: bool
    header: bool
    link: bool


@dataclass
class Block:
    tag: str
    parent: int
    path: tuple[int, ...]
    log_odds: float
    header: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _element(tag: str, attrs: str, number: int, up: Element) -> Element:
    odds, article, header = up.log_odds, up.article, up.header or tag == "header"
    odds += ELEMENT.get(tag, 0.0) + (HIDDEN if tag in CONTROL else 0.0)
    inside = tag in ("article", "main")
    if attrs and tag not in ("html", "body"):
        names: list[str] = []
        own_id = ""
        for m in ATTR.finditer(attrs):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "class":
                names += value.split()
            elif key == "id":
                own_id = value.strip()
            elif key == "role":
                odds += ROLE.get(value.lower(), 0.0)
                inside |= value.lower() in ("main", "article")
            elif key == "itemprop":
                inside |= value.lower() == "articlebody"
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (
                    key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
                odds += HIDDEN
        worded = tag in HEADINGS or article and (tag in PARTS or tag == "div" and any(SECTION.fullmatch(n) for n in names))
        if own_id and (not worded or article and tag not in HEADINGS and own_id.lower() in READER_IDS):
            names.append(own_id)
        named = [{w.lower() for w in NAME.findall(n)} for n in names]
        named = [n for n in named if not n & MIXED_NAMES]
        if any(n & BAD_NAMES and n <= BAD_NAMES | PLACE_WORDS for n in named):
            odds += BAD_NAME
        elif any("header" in n and n <= {"header"} | PLACE_WORDS for n in named):
            odds += HEADER_NAME
        elif any(n & GOOD_NAMES for n in named):
            odds += GOOD_NAME
    if inside and not article:
        odds += IN_ARTICLE
    return Element(tag, number, odds, article or inside, header, up.link or tag == "a")


def _tokens(page: str) -> Iterator[tuple[re.Match, int]]:
    """Comments and tags in page order, and where each ends; a raw text element is one token."""
    at = 0
    while m := TOKEN.search(page, at):
        at = m.end()
        if m[2] and not m[1] and m[2].lower() in RAW and not m[0].endswith("/>"):
            end = re.compile(rf"</{re.escape(m[2])}\s*[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        yield m, at


def _ended(tokens: list[tuple[re.Match, int]]) -> set[int]:
    """Where the controls start that have an end tag."""
    out: set[int] = set()
    open_: dict[str, list[int]] = {t: [] for t in CONTROL}
    for m, _ in tokens:
        if m[2] and (starts := open_.get(m[2].lower())) is not None:
            if m[1]:
                if starts:
                    out.add(starts.pop())
            elif not m[0].endswith("/>"):
                if m[2].lower() in LONE:
                    starts.clear()
                starts.append(m.start())
    return out


def read_blocks(page: str) -> list[Block]:
    """Blocks of text in page order, with what the classifier needs."""
    stack = [Element("", 0, 0.0, False, False, False)]
    blocks: list[Block] = []
    current: Block | None = None
    number, at = 0, 0
    tokens = list(_tokens(page))
    ended = _ended(tokens)
    around: dict[int, Block | None] = {}  # by number of an open control: the block that goes on after it
    lone_ends: set[int] = set()  # open controls without an end tag

    def cut(deep: int) -> None:
        """Ends the elements from there on."""
        nonlocal current
        for e in stack[deep:]:
            if e.tag in CONTROL:
                current = around[e.number]
                break
        lone_ends.difference_update(e.number for e in stack[deep:])
        del stack[deep:]

    def add(raw: str) -> None:
        nonlocal current
        if not raw:
            return
        if current is None:
            if raw.isspace():
                return
            owner = next((e for e in reversed(stack) if e.tag in BLOCK), stack[0])
            held = [e.number for e in stack if e.tag in BLOCK]
            current = Block(owner.tag, held[-2] if len(held) > 1 else 0, tuple(held), stack[-1].log_odds, owner.header)
            blocks.append(current)
        current.parts.append(raw)
        if stack[-1].link:
            current.linked += len(raw)

    for m, after in tokens:
        add(page[at:m.start()])
        at = after
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:  # end tag
            deep = len(stack) - 1
            while deep and stack[deep].tag != tag and (tag in PARTING or stack[deep].tag not in PARTING):
                deep -= 1
            if deep and stack[deep].tag == tag:
                cut(deep)
            if tag in BLOCK:
                current = None
            continue
        if tag in RAW and not m[0].endswith("/>"):
            add(" ")
            continue
        if tag == "br":
            add(" ")
            continue
        if lone_ends and (tag in BLOCK or tag in LONE):  # a control that is never ended holds no blocks
            cut(next(k for k, e in enumerate(stack) if e.number in lone_ends))
        if tag in BLOCK:
            deep = len(stack) - 1
            while deep and stack[deep].tag not in PARTING:
                deep -= 1
            if stack[deep].tag == "p":  # a block-level tag ends an open paragraph
                cut(deep)
            if tag in CLOSES:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in SCOPE[tag] or stack[k].tag in CONTROL:
                        break
                    if stack[k].tag in CLOSES[tag]:
                        cut(k)
                        break
            current = None
        if tag in VOID:
            continue
        number += 1
        element = _element(tag, m[3], number, stack[-1])
        if m[0].endswith("/>"):
            continue
        if tag in CONTROL:
            add(" ")
        if len(stack) < MOST_DEPTH:
            stack.append(element)
            if tag in CONTROL:
                around[number], current = current, None
                if m.start() not in ended:
                    lone_ends.add(number)
    add(page[at:])
    out = []
    for b in blocks:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
        if b.text:
            out.append(b)
    return out


def log_odds(b: Block) -> float:
    s = b.log_odds + TAG.get(b.tag, 0.0) + BIAS + min(len(b.text) / LENGTH_PER, LENGTH_MOST)
    share = b.linked / max(1, sum(map(len, b.parts)))
    return s + (LINKS * share if share > 0.3 else 0.0)


def edges(blocks: list[Block]) -> dict[tuple[int, int], int]:
    """Smoothness between neighbours, by how much of their DOM path they share, and between blocks of one parent."""
    out: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            a = blocks[i - 1]
            shared = 0
            for x, y in zip(a.path, b.path):
                if x != y:
                    break
                shared += 1
            out[i - 1, i] = round(UNIT * NEXT * shared / max(len(a.path), len(b.path), 1))
        if (j := last.get(b.parent)) is not None:
            out[j, i] = out.get((j, i), 0) + round(UNIT * SAME_PARENT)
        last[b.parent] = i
    return out


def minimum_cut(gain: list[int], smooth: dict[tuple[int, int], int]) -> list[bool]:
    """True where a node is on the content side of the minimum cut.

    gain > 0: capacity from the content terminal, gain < 0: to the boilerplate
    terminal.  Nodes whose gain outweighs all their edges keep their side; their
    edges become gains of their neighbours.  Maximum flow decides the rest.
    """
    n = len(gain)
    side: list[bool | None] = [None] * n
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for (i, j), c in smooth.items():
        near[i][j] = near[j][i] = c
    gain = list(gain)
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if side[i] is None and abs(gain[i]) > sum(near[i].values()):
            side[i] = gain[i] > 0
            for j, c in near[i].items():
                gain[j] += c if side[i] else -c
                del near[j][i]
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if not rest:
        return side
    s, t = n, n + 1
    cap: list[dict[int, int]] = [dict(near[i]) for i in range(n)] + [{}, {}]
    for i in rest:
        cap[s][i], cap[i][s], cap[i][t], cap[t][i] = max(gain[i], 0), 0, max(-gain[i], 0), 0
    while True:
        via = {s: s}
        queue = deque([s])
        while queue and t not in via:
            u = queue.popleft()
            for v, c in cap[u].items():
                if c > 0 and v not in via:
                    via[v] = u
                    queue.append(v)
        if t not in via:
            break
        path, v = [], t
        while v != s:
            path.append((via[v], v))
            v = via[v]
        push = min(cap[u][v] for u, v in path)
        for u, v in path:
            cap[u][v] -= push
            cap[v][u] += push
    for i in rest:
        side[i] = i in via
    return side


def main_text(page: str) -> str:
    """Text of the content blocks, one line each."""
    blocks = read_blocks(page)
    if not blocks:
        return ""
    gain = []
    for b in blocks:
        s = max(-30.0, min(30.0, log_odds(b)))
        as_content, as_boilerplate = math.log1p(math.exp(-s)), math.log1p(math.exp(s))
        gain.append(round(UNIT * (as_boilerplate - as_content)))
    content = minimum_cut(gain, edges(blocks))
    return "\n".join(b.text for b, c in zip(blocks, content) if c)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row; null html counts as empty, a page without content has an empty text.

    Repeated rows give repeated rows, an empty table none; other columns are ignored.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([main_text(h.as_py() or "") for h in b.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), texts], names=["page_id", "url", "text"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return (rows.mapInArrow(work, f"page_id {kind}, url string, text string")
            .withColumn("n_chars", F.char_length("text").cast("bigint")))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
