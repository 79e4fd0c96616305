"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is cut into blocks at block elements. A linear classifier turns the place and the look of a block into evidence
for content (positive) or boilerplate (negative); this becomes the capacity of the block's edge from the source or to the
sink. Neighbours in page order and blocks under the same parent are tied by smoothness edges whose capacity falls with
their distance in the element tree. The minimum cut is the labelling with the least total cost. Blocks whose evidence
outweighs all their ties are settled first, which changes no minimum; augmenting paths settle the rest. Evidence and ties are
of the same order, so a block of weak evidence goes with its neighbours.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stockloom.llm.common import table
from stockloom.shipping import ship_with_tasks

# Element names of the markup language, and words that sites use in class and id.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = "script style noscript template svg math iframe object audio video canvas select textarea button title"
AWAY = frozenset("nav footer aside form dialog menu fieldset".split())
HOME = frozenset("article main".split())
SECTIONS = AWAY | HOME | frozenset(["header", "section"])
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIER = frozenset("ul ol dl table tbody thead tr div section article main aside nav footer header form body html blockquote".split())
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner bottombar breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer discussion disqus footer footnav gdpr "
    "header masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination paywall popup promo promotion promoted rail recommended recommendations related replies reply respond "
    "search share sharing sidebar signin signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget".split()
)
GOOD_WORDS = frozenset("article body content entry main post story text".split())
BAD_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
GOOD_ROLES = frozenset(["article", "main"])
CUES = re.compile(r"©|\bcookies?\b|all rights reserved|\bsubscribe\b|newsletter|privacy policy|\bsign up\b|\badvertisement\b", re.I)

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:svg|math)(?=[\s/])(?:[^>\"'/]|/(?!>)|\"[^\"]*\"|'[^']*')*/>"
    r"|<(?P<unseen>" + "|".join(UNSEEN.split()) + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=unseen)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<[a-zA-Z/][^<>]*\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# log odds of the evidence and, of the same order, capacities of the ties
LONG, BAD, GOOD, AWAY_ODDS, HOME_ODDS, OUTSIDE_ODDS = 60, 4.5, 1.0, 5.0, 1.5, 3.0
NEXT, SIBLING = 3.0, 1.5
SCALE = 1000  # capacities are whole numbers of thousandths


class Element:
    __slots__ = ("name", "parent", "depth", "evidence", "home", "away", "section")

    def __init__(self, name: str, parent: Element | None, attributes: str) -> None:
        self.name, self.parent = name, parent
        self.depth = parent.depth + 1 if parent else 0
        self.home, self.away = (parent.home, parent.away) if parent else (False, False)
        self.evidence = parent.evidence if parent else 0.0
        self.section = parent.section if parent else self
        if name in SECTIONS:
            self.section = self
        if name in HOME:
            self.home = True
        if name in AWAY or name == "header" and not self.home:
            self.away = True
        elif name == "header":
            self.evidence -= 1.0
        if attributes and name not in ("html", "body"):
            self._attributes(attributes)

    def _attributes(self, attributes: str) -> None:
        words: set[str] = set()
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id"):
                words.update(w.lower() for w in WORD.findall(value))
            elif key == "role":
                self.away = self.away or value.lower() in BAD_ROLES
                self.home = self.home or value.lower() in GOOD_ROLES
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                self.away = True
        if words & BAD_WORDS:
            self.evidence -= BAD / 3 if self.name in HOME and not words & {"comment", "comments", "reply"} else BAD
            self.section = self
        elif words & GOOD_WORDS:
            self.evidence += GOOD


class Block:
    __slots__ = ("text", "element", "words", "linked")

    def __init__(self, text: str, element: Element, words: int, linked: int) -> None:
        self.text, self.element, self.words, self.linked = text, element, words, linked


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order; unclosed and stray tags are read as browsers read them, as far as blocks need it."""
    found: list[Block] = []
    here = root = Element("html", None, "")
    raw: list[tuple[str, bool]] = []
    in_link = False

    def close_block() -> None:
        if raw:
            text = " ".join(entities.unescape("".join(t for t, _ in raw)).split())
            if text:
                linked = sum(len(entities.unescape(t).split()) for t, link in raw if link)
                found.append(Block(text, here, len(text.split()), linked))
            raw.clear()

    at = 0
    for m in TAG.finditer(page):
        if m.start() > at:
            raw.append((page[at : m.start()], in_link))
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                in_link = not m["end"]
            continue
        if name == "br":
            raw.append((" ", False))
            continue
        close_block()
        in_link = False
        if name in VOID:
            continue
        if m["end"]:
            node = here
            while node is not None and node.name != name:
                node = node.parent
            if node is not None and node.parent is not None:
                here = node.parent
            continue
        if name in CLOSES_P:
            here = _leave(here, {"p"}) if name[0] != "h" or name not in ("h1", "h2", "h3", "h4", "h5", "h6") else _leave(here, {"p", "h1", "h2", "h3", "h4", "h5", "h6"})
        if name in SAME_CLOSES:
            here = _leave(here, SAME_CLOSES[name] | {"p"}, stop=BARRIER - SAME_CLOSES[name])
        if name in ("html", "head", "body"):
            continue
        here = Element(name, here, m["attributes"].rstrip("/"))
    if at < len(page):
        raw.append((page[at:], in_link))
    close_block()
    return found


def _leave(here: Element, names: set[str], stop: frozenset[str] | set[str] = BARRIER) -> Element:
    """The place after closing the nearest of ``names``, unless a barrier lies between."""
    node = here
    while node.parent is not None and node.name not in stop:
        if node.name in names:
            return node.parent
        node = node.parent
    return here


def home_share(blocks: list[Block]) -> float:
    """Share of a page's prose, its words outside links and boilerplate elements, that lies in article or main elements."""
    prose = [(b.words - b.linked if not b.element.away and b.element.evidence > -BAD / 2 else 0) for b in blocks]
    return sum(w for w, b in zip(prose, blocks, strict=True) if b.element.home) / max(1, sum(prose))


def evidence_of(block: Block, share: float) -> float:
    """The classifier: log odds, positive for content. ``share`` says how far article elements tell where the prose is."""
    e = block.element
    score = 0.8 * math.log1p(min(block.words, LONG)) - 1.6 + e.evidence - 4.0 * block.linked / block.words
    if e.away:
        score -= AWAY_ODDS
    score += HOME_ODDS * share if e.home else -OUTSIDE_ODDS * share
    if e.name in ("h1", "h2", "h3"):
        score += 0.8
    if not e.home and block.words < 40 and CUES.search(block.text):
        score -= 2.0
    return score


def tie(a: Element, b: Element, most: float) -> float:
    """Capacity of the edge between blocks in two elements: a quarter for each level above two up to their common ancestor."""
    if a.section is not b.section:
        return 0.05
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return most * 0.25 ** max(0, steps - 2)


def labelled(blocks: list[Block]) -> list[bool]:
    """True for the content side of the minimum cut."""
    n = len(blocks)
    share = home_share(blocks)
    pull = [round(SCALE * evidence_of(b, share)) for b in blocks]
    ties: list[dict[int, int]] = [{} for _ in range(n)]

    def join(i: int, j: int, capacity: float) -> None:
        c = round(SCALE * capacity)
        ties[i][j] = ties[i].get(j, 0) + c
        ties[j][i] = ties[j].get(i, 0) + c

    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            join(i - 1, i, tie(blocks[i - 1].element, b.element, NEXT))
        parent = id(b.element.parent or b.element)
        if parent in last and last[parent] != i - 1:
            join(last[parent], i, tie(blocks[last[parent]].element, b.element, SIBLING))
        last[parent] = i
    side: list[bool | None] = [None] * n
    total = [sum(t.values()) for t in ties]
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is None and abs(pull[i]) >= total[i]:
            side[i] = pull[i] >= 0
            for j, c in ties[i].items():
                if side[j] is None:
                    pull[j] += c if side[i] else -c
                    total[j] -= c
                    queue.append(j)
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        content = _source_side(rest, pull, ties)
        for i in rest:
            side[i] = i in content
    return [bool(s) for s in side]


def _source_side(nodes: list[int], pull: list[int], ties: list[dict[int, int]]) -> set[int]:
    """Nodes on the source's side of a minimum cut, by shortest augmenting paths (source -1, sink -2)."""
    inside = set(nodes)
    room: dict[int, dict[int, int]] = {i: {j: c for j, c in ties[i].items() if j in inside and c} for i in nodes}
    room[-1] = {i: pull[i] for i in nodes if pull[i] > 0}
    room[-2] = {}
    for i in nodes:
        if pull[i] < 0:
            room[i][-2] = -pull[i]
    while True:
        before = {-1: -1}
        queue = deque([-1])
        while queue and -2 not in before:
            i = queue.popleft()
            for j, c in room[i].items():
                if c > 0 and j not in before:
                    before[j] = i
                    queue.append(j)
        if -2 not in before:
            return before.keys() - {-1}
        path, j = [], -2
        while j != -1:
            path.append((before[j], j))
            j = before[j]
        flow = min(room[i][j] for i, j in path)
        for i, j in path:
            room[i][j] -= flow
            room[j][i] = room[j].get(i, 0) + flow


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, content in zip(blocks, labelled(blocks), strict=True) if content)


@F.arrow_udf(StringType())
def _main_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([main_text(batch[i].as_py()) for i in range(len(batch))], pa.string())


def extracted(pages: DataFrame, html: str | Column = "html", text: str = "text") -> DataFrame:
    """``pages`` with their main text: blocks of the article in page order, one to a line.

    Null or empty html gives an empty text. Each page stands for itself, so repeated rows, empty tables and other columns
    need no care; a column named ``text`` is replaced. A page is held whole in one task, no more than one at a time
    besides its Arrow batch.
    """
    return pages.withColumn(text, _main_text(html))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


ship_with_tasks(__name__)
