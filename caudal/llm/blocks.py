"""Main text of HTML pages: flat text blocks classified by a decision tree (operator 2)."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import parts

BATCH_BYTES = 4 << 20
#: A tag name; a tag whose quoted values hold no bracket, up to its end; an attribute's name up to its value; a bare value.
_NAME = re.compile(r"[a-zA-Z][^\s/><]*+")
_PLAIN = re.compile(r"""((?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+')*+)>""")
_BEFORE_VALUE = re.compile(r"""[\s/]*+([^\s/>=<]*+)\s*+(=?)\s*+""")
_BARE = re.compile(r"[^\s><]*+")
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=<]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s><]*+))?""")
_TOKEN = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")

# The names HTML and its common authors use.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("template noscript svg".split())
CONTROLS = frozenset("button select option optgroup datalist label".split())
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE_TAGS = frozenset("nav aside footer menu dialog search header".split())
MAIN_TAGS = frozenset("article main".split())
OUTSIDE_NAMES = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising alert alerts banner breadcrumb breadcrumbs byads "
    "comment comments commentlist consent contentinfo cookie cookies copyright discussion disqus footer footnav gdpr header "
    "hidden legal login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "popup promo promoted promotion related recommended replies reply respond search share sharing sidebar signup skip "
    "social sponsor sponsored subscribe toolbar topbar widget widgets complementary".split()
)
#: Names that authors also give to what is around an article: an article below them is one all the same.
AROUND = frozenset("banner header login masthead menu nav navbar navigation search share sharing sidebar signup social subscribe toolbar topbar widget widgets".split())
MAIN_NAMES = frozenset("article articlebody content entry main maincontent post story".split())
#: Words at the end of a name that say nothing of what the block holds, and words at its start that speak of another block.
PLACES = frozenset("area bar block body box container content group inner item items left line links list outer panel right row section text thread top wrap wrapper".split())
OTHERS = frozenset("has no with without is not hide hides show shows tag category".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "outside", "inside", "heading", "item")

#: Small labelled pages.  ``12+`` stands for a text of 12 words that is main text, ``3-`` for one of 3 that is not.
EXAMPLES = (
    # An article between menu, advert and footer, with short and long paragraphs, lists, references and a note below.
    "<nav><ul><li><a>1-</a><li><a>2-</a><li><a>1-</a></ul></nav><div class=ad>9-</div><article><h1>7+</h1><p>60+<p>1+<p>4+<p>45+<h2>3+</h2>"
    "<ul><li>9+<li>2+<li>14+</ul><p>6+ <a>4+</a><p>50+<p>2+<ol><li><a>8+</a><li><a>6+</a><li><a>11+</a></ol></article><footer>11-</footer>",
    "<article><p>1+</article><div class=cookie>30-</div>",
    "<main><h1>4+</h1><p>25+<p><a>12+</a><p>30+<ul><li><a>1-</a><li><a>2-</a><li><a>1-</a><li><a>2-</a></ul></main><aside>40-<p>60-</aside>",
    "<article><h1>5+</h1><p>3+<p>2+<p>5+<section class=comments><h3>2-</h3><p>35-<p>8-<p>50-</section><footer>6-</footer></article>",
    "<article><h2>2+</h2><table><tr><td>1+<td>2+<td>1+<tr><td>12+<td>3+</table><p>20+ <a>1+</a></article><div class=related><ul><li><a>9-</a><li><a>12-</a></ul></div>",
    # Articles of a few words, at the end of a page, before links, in pieces.
    "<article>1+</article>",
    "<article><h1>2+</h1><p>3+<p>1+<p>5+<p>2+</article>",
    "<article><p>30+<p>4+<p>70+<p>3+<p>9+</article><div><a>2-</a></div>",
    "<nav><a>1-</a></nav><article><p>1+<p>2+<p>4+</article><div><a>3-</a> <a>1-</a></div><footer>9-</footer>",
    "<main><div>5+</div><div>2+</div><div>60+</div><div>1+</div><div>80+</div></main><ul><li><a>3-</a><li><a>9-</a></ul>",
    "<article><ul><li>1+<li>3+<li>2+</ul><p>4+ <a>4+</a><dl><dt>1+<dd>12+<dt>2+<dd>3+</dl></article>",
    "<article><p>40+<p>2+</article>", "<article><h1>5+</h1><p>60+<p>1+</article>", "<article><p>90+<p>3+</article><div><a>2-</a></div>",
    "<a>3-</a><article><p>2+<p>80+<p>1+<p>2+<p>90+<p>3+</article>", "<div><a>2-</a></div><main><p>1+<p>30+<p>2+<p>4+</main><div><a>4-</a></div>",
    "<article><p>25+<p>3+<p>2+<p>1+<p>50+<p>4+<p>1+</article>", "<div>20-</div><article><p>3+<p>1+<p>44+<p>2+<p>1+</article><div>8-</div>",
    "<ul><li><a>2-</a><li><a>1-</a></ul><article><h1>2+</h1><p>1+<p>65+<p>4+<p>2+</article><ul><li><a>5-</a></ul>",
    "<nav><a>2-</a></nav><article><p>9+</article>", "<nav><a>1-</a></nav><article>5+</article>", "<ul><li><a>1-</a></ul><article><p>14+</article>",
    "<nav><a>4-</a></nav><article><p>2+</article>", "<article><p>6+<p>9+</article>", "<article><p>30+<p>12+</article>", "<div><a>3-</a></div><main>12+</main>",
    "<nav><a>3-</a></nav><article><p>8+<p>60+<p>14+<p>90+<p>3+<p>70+<p>9+</article><aside><a>1-</a></aside>",
    # Menus of any length beside articles of any length.
    *(f"<nav><a>{m}-</a></nav><article><p>{a}+<p>{b}+</article><ul><li><a>{m}-</a></ul>" for m in (1, 6, 30) for a in (2, 12, 60) for b in (3, 14, 40)),
    # Pages that name nothing: links around the block, its length and its neighbours have to tell.
    "<div><a>1-</a> <a>2-</a> <a>1-</a></div><h1>6+</h1><p>48+<p>7+<p>35+<p>14+<p>70+<div><a>5-</a></div><div>6-</div>",
    "<ul><li><a>1-</a><li><a>1-</a><li><a>2-</a></ul><div>55+</div><div>40+</div><div>11+</div><div>30+</div><ul><li><a>4-</a><li><a>6-</a></ul><div>4-</div>",
    "<table><tr><td><a>2-</a><td><a>3-</a></table><h2>5+</h2><p>22+<ul><li>14+<li>9+<li>18+</ul><p>33+<p><a>7-</a> 1-<p>5-",
    "<div>3-</div><div>2-</div><div><a>4-</a></div><h1>8+</h1><div>38+ <a>4+</a></div><div>27+</div><h2>3+</h2><div>44+</div><div><a>9-</a></div><div><a>14-</a></div><div>7-</div>",
    "<h3>3-</h3><ul><li><a>4-</a><li><a>5-</a></ul><h3>2-</h3><ul><li><a>3-</a><li><a>6-</a></ul><p>26+<p>31+<p>5-",
    "<p><a>3-</a> 2- <a>1-</a><p>4-<p>60+<p>9+<p>52+<p>6+<p>41+<p>5- <a>6-</a><p>3-",
    "<div>5-</div><div><a>2-</a></div><div>4-</div><div><a>3-</a></div><div>6-</div>",
    "3+", "30+", "<p>30+<p>60+<p>25+", "<h1>4+</h1><p>90+", "<div><a>1-</a></div><div>35+</div>", "<div>70+</div><div><a>3-</a></div>",
    "<div><a>1-</a></div><div><a>2-</a></div><div>40+</div><div>80+</div><div>30+</div><div><a>4-</a></div><div>6-</div>",
    "<div><a>2-</a></div><div>30+</div><h2>5+</h2><div>26+</div><h2>3+</h2><div>64+</div><div>28+</div><li><a>2-</a><li><a>5-</a><div>4-</div>",
    "<div><a>3-</a></div><h1>6+</h1><div>90+</div><div>45+</div><h2>4+</h2><div>55+</div><li><a>7-</a><li><a>2-</a><div>3-</div>",
    "<div><a>1-</a></div><h2>7+</h2><p>50+<h2>3+</h2><p>85+<p>28+<ul><li><a>8-</a></ul><p>5-",
    # Notices and forms of some length, which only their names give away.
    "<div class=notice>45-<p>30-</div><div class=content><p>40+<p>6+<p>28+</div><div id=newsletter><p>25-<p>12-</div><div class=copyright>14-</div>",
    "<aside><p>50-<p>2-<p>34-<p>3-</aside><div><p>28+<p>2+<p>45+<p>3+<p>30+</div><footer><p>30-<p>4-<p>26-<p>2-</footer>",
    "<div class=promo>27-</div><p>36+<p>26+<p>4+<div class=cookie-banner>60-<p>3-</div><form><p>32-<p>2-</form><div class=disqus>29-<p>4-<p>90-<p>1-</div>",
    "<header><p>12-</header><div class=entry><h1>5+</h1><p>33+<p>4+</div><div class=comments><p>40-<p>65-<p>22-</div>",
)


@lru_cache(1)
def labelled() -> tuple[tuple[float, ...], ...]:
    """The labelled table: features of the blocks of ``EXAMPLES`` in the order of ``FEATURES``, and 1 for main text."""
    table = []
    for page in EXAMPLES:
        blocks = text_blocks(re.sub(r"\b(\d+)([+-])", lambda m: " ".join([m[2]] + ["x"] * (int(m[1]) - 1)), page))
        table += [(*row, int(b[0].count("+") >= b[0].count("-"))) for b, row in zip(blocks, features(blocks), strict=True)]
    return tuple(table)


@dataclass
class Tree:
    """A node: rows with ``feature`` at most ``most`` go left; a leaf has only ``main``."""

    main: bool
    feature: int = -1
    most: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    def tell(self, row: tuple[float, ...]) -> bool:
        node = self
        while node.feature >= 0:
            node = node.left if row[node.feature] <= node.most else node.right
        return node.main


def grow(table: tuple[tuple[float, ...], ...] | None = None, depth: int = 10) -> Tree:
    """A classification tree by Gini impurity; of equal splits the first feature and value are taken."""
    rows = np.array(labelled() if table is None else table, dtype=float)
    x, y = rows[:, :-1], rows[:, -1]
    leaf = Tree(bool(y.mean() >= 0.5))
    if depth == 0 or y.min() == y.max():
        return leaf
    best = (len(y) * y.mean() * (1 - y.mean()) - 1e-9, -1, 0.0)
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for most in (values[:-1] + values[1:]) / 2:
            sides = y[x[:, j] <= most], y[x[:, j] > most]
            impurity = sum(len(s) * s.mean() * (1 - s.mean()) for s in sides)
            if impurity < best[0] - 1e-9:
                best = impurity, j, float(most)
    if best[1] < 0:
        return leaf
    low = x[:, best[1]] <= best[2]
    halves = (tuple(map(tuple, rows[low])), tuple(map(tuple, rows[~low])))
    return Tree(leaf.main, best[1], best[2], grow(halves[0], depth - 1), grow(halves[1], depth - 1))


def _names(value: str) -> set[str]:
    """What the names in a class, id or role say the block is: each name's last word that is not just a place."""
    said = set()
    for name in value.split():
        words = [x.lower() for x in _TOKEN.findall(name)]
        if words and words[0] in OTHERS:
            continue
        while len(words) > 1 and words[-1] in PLACES:
            words.pop()
        said.update(words[-1:])
    return said


@lru_cache(4096)
def _kind(tag: str, attributes: str, inside: bool) -> str:
    """What an element makes of the text below it: outside, around (outside but for an article), form, control, main or plain."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        found.setdefault(name.lower(), value.strip("\"'"))
    if tag in UNSEEN or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return "outside"
    if "display:none" in re.sub(r"\s", "", found.get("style", "")).lower():
        return "outside"
    if tag in CONTROLS:
        return "control"
    said = set().union(*(_names(found.get(k, "")) for k in ("class", "id", "role")))
    if inside:  # An article has a header of its own.
        said.discard("header")
    if tag in OUTSIDE_TAGS and not (tag == "header" and inside):
        return "around" if tag in ("header", "search") else "outside"
    if tag not in ("html", "body") and said & OUTSIDE_NAMES:
        return "outside" if said & OUTSIDE_NAMES - AROUND else "around"
    if tag in MAIN_TAGS or said & MAIN_NAMES:
        return "main"
    return "form" if tag == "form" else "plain"


def _tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of every tag and comment (empty name), each place looked at a few times at most.

    A tag ends at the first closing bracket outside of quoted values.  A quote that is never closed is part of a bare value, and an
    opening bracket where no value stands ends the tag: what follows a broken tag is text again.
    """
    at, size, never = 0, len(page), set()
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            start, at = at, end + 3 if end >= 0 else size
            yield start, at, "", False, ""
            continue
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            start, at = at, end + 1 if end >= 0 else size
            yield start, at, "", False, ""
            continue
        closing = page.startswith("</", at)
        name = _NAME.match(page, at + 1 + closing)
        if not name:
            at += 1
            continue
        start, at = at, name.end()
        plain = _PLAIN.match(page, at)
        if plain:
            at = plain.end()
            yield start, at, name[0].lower(), closing, plain[1]
            continue
        held = []
        while at < size and page[at] not in "<>":
            part = _BEFORE_VALUE.match(page, at)
            before, at = at, part.end()
            value, quote = "", page[at : at + 1]
            if part[2]:
                end = page.find(quote, at + 1) if quote in ("'", '"') and quote not in never else -1
                if quote in ("'", '"') and end < 0:
                    never.add(quote)
                    at += 1
                if end >= 0:
                    value, at = page[at + 1 : end], end + 1
                else:
                    bare = _BARE.match(page, at)
                    value, at = bare[0], bare.end()
            elif at == before:
                at += 1
            if part[1]:
                held.append(f"{part[1]}='{value}'" if "'" not in value else f'{part[1]}="{value}"')
        at += page.startswith(">", at)
        yield start, at, name[0].lower(), closing, " ".join(held)


Block = tuple[str, float, int, int, int, int]


def text_blocks(page: str) -> list[Block]:
    """Flat blocks of a page: text, link density, and whether outside the main text, in an article, a heading, an item.

    Time and memory are in proportion to the page, however broken it is.
    """
    blocks: list[tuple[str, float, int, int, int, int, int]] = []
    stack: list[tuple[str, str, int]] = []
    depth: Counter[str] = Counter()
    state: Counter[str] = Counter()  # open elements by what they make of their text
    pieces: list[str] = []
    linked: list[str] = []
    raw_open: set[str] = set()
    tag_now, in_link, at, size = "", False, 0, len(page)

    def close() -> None:
        if pieces:
            text = "".join(pieces)
            words = (html.unescape(text) if "&" in text else text).split()
            if words:
                links = len(html.unescape("".join(linked)).split()) / len(words)
                outside = state["outside"] > 0 or state["around"] > 0 or state["control"] > 0
                blocks.append((" ".join(words), min(1.0, links), int(outside), int(state["main"] > 0), int(tag_now in HEADINGS), int(tag_now in ("li", "dd", "dt")), int(state["form"] > 0)))
            pieces.clear()
            linked.clear()

    def leave(level: int) -> None:
        if any(kind != "plain" for _, kind, _ in stack[level:]):
            close()
        for tag, kind, hidden in reversed(stack[level:]):
            depth[tag] -= 1
            state[kind] -= 1
            if hidden:  # An article that put aside what was around it.
                state["around"], state["form"] = hidden >> 20, hidden & 0xFFFFF
        del stack[level:]

    for start, end, tag, closing, attributes in _tags(page):
        if start < at:  # inside raw text
            continue
        if start > at:
            text = page[at:start]
            pieces.append(text)
            if in_link:
                linked.append(text)
        at = end
        if not tag:
            continue
        if tag in RAW:
            if not closing and tag not in raw_open:
                shut = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                if shut:
                    at = shut.end()
                    pieces.append(" ")
                elif tag in ("script", "style"):
                    at = size
                    break
                else:
                    raw_open.add(tag)  # never closed: what follows is text
            continue
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            pieces.append(" ")
            if in_link:
                linked.append(" ")
        if tag in BREAKS:
            close()
            tag_now = "" if closing else tag
        if tag in VOID or attributes.endswith("/") and tag not in BREAKS:
            continue
        if closing:
            if depth[tag]:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            continue
        if tag in BREAKS:
            # These end where the next block begins.
            while stack and (stack[-1][1] == "control" or stack[-1][0] == "p" or stack[-1][0] == tag == "li"):
                leave(len(stack) - 1)
        kind = _kind(tag, attributes, state["main"] > 0)
        if kind != "plain" or tag in BREAKS and tag not in ("html", "head", "body"):
            hidden = 0
            if kind != "plain":
                close()
            if tag in MAIN_TAGS and kind == "main" and not state["main"] and (state["around"] or state["form"]):
                hidden = state["around"] << 20 | state["form"]
                state["around"] = state["form"] = 0
            stack.append((tag, kind, hidden))
            depth[tag] += 1
            state[kind] += 1
    if at < size:
        pieces.append(page[at:])
    close()
    # A form around most of the page's text is how the page is built; a smaller one is a form.
    words = Counter()
    for text, _, outside, _, _, _, form in blocks:
        words[form] += 0 if outside else text.count(" ") + 1
    built = words[1] > words[0]
    return [(text, links, int(outside or (form and not built)), inside, heading, item) for text, links, outside, inside, heading, item, form in blocks]


def features(blocks: list[Block]) -> list[tuple[float, ...]]:
    """The rows of ``FEATURES`` of a page's blocks."""
    words = [0, *(b[0].count(" ") + 1 for b in blocks), 0]
    links = [0.0, *(b[1] for b in blocks), 0.0]
    return [
        (words[i], links[i], words[i - 1], links[i - 1], words[i + 1], links[i + 1], *b[2:]) for i, b in enumerate(blocks, 1)
    ]


def main_text(page: str, tree: Tree) -> str:
    """The page's main text blocks, joined by an empty line."""
    blocks = text_blocks(page)
    return "\n\n".join(b[0] for b, row in zip(blocks, features(blocks), strict=True) if tree.tell(row))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per page: the article without menus, adverts, forms, comments and the like.

    The scan is the only stage; a page is cut into flat blocks, described by words and link density of the block and
    its neighbours and by the elements around it, and classified by a tree trained on the blocks of ``EXAMPLES``.
    A page is worked on whole, in time and memory (about ten times its size) in proportion to it, however broken its tags are.
    NULL or empty HTML and pages without main text give empty text; text without any markup counts as one block; repeated
    rows give repeated results; other columns are never read; an empty table gives an empty result.
    """
    tree = grow()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, BATCH_BYTES, "html"):
            texts = [main_text(x or "", tree) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
