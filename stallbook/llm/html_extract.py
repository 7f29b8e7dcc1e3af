"""Main text of web pages by a minimum cut: every text block is a node, the
log-odds of a block classifier are its terminal capacities, blocks that are near
in page order and in the document tree are joined by smoothness edges; the
maximum flow separates the article from the rest of the page."""

from __future__ import annotations

import html
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from stallbook.llm.common import annotate

# Elements of HTML by what they do to text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Their content is no text of the page.
SILENT = frozenset(
    "script style noscript template svg math iframe object canvas audio video select button "
    "textarea head title datalist option noframes".split()
)
#: Their content is not markup: only their own end tag ends it.
RAW = frozenset("script style textarea title noframes iframe noscript template".split())
#: Elements of the same group end each other when they are left open.
SELF_CLOSING = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}

# What a page's parts are called.
OUTSIDE_TAGS = frozenset("nav footer aside form label legend menu dialog".split())
ARTICLE_TAGS = frozenset(["article", "main"])
OUTSIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar".split()
)
ARTICLE_ROLES = frozenset(["main", "article"])
#: Words in class and id of parts that hold no article if the page has one elsewhere.
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo "
    "promotion cookie cookies consent gdpr comment comments disqus reply replies respond "
    "nav navbar navigation menu breadcrumb breadcrumbs share sharing social related recommended "
    "newsletter subscribe subscription signup login popup modal pagination pager footer copyright "
    "skip search sharebar toolbar".split()
)
#: Words of parts that hold none unless an article is marked inside.
OUTER_WORDS = frozenset(
    "header masthead sidebar banner notice notices alert widget aside topbar bottombar "
    "overlay legal disclaimer toc".split()
)
ARTICLE_WORDS = frozenset("article content post entry story main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    # quotes enclose a value behind an equals sign alone; elsewhere they are stray
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|$)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"([a-zA-Z][\w:-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.DOTALL
)
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: White space of HTML; other space characters are text.
SPACE = re.compile(r"[ \t\n\r\f\v]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: SIDE is an OUTER part inside an article, HEADER a <header> inside one.
OUTSIDE, SIDE, OUTER, NEUTRAL, ARTICLE, TAGGED, HEADER = -3, -2, -1, 0, 1, 2, 3

#: Log-odds of a block in a marked part, and weights of the others. Smoothness
#: alone cannot keep a block of a side part: its edges add up to less.
MARKED_ARTICLE, MARKED_SIDE, MARKED_OUTSIDE = 5.0, -5.0, -7.0
NEAR, TREE = 1.5, 0.75
#: Log-odds that speak against a part named by an outside word: text outside of
#: it is the page's content if its blocks have as much, else the part is weighed.
#: Each of its blocks that no article mark vouches for then has so much less; for
#: that comparison blocks that one vouches for have so much more.
NAMED, IN_NAMED, VOUCHED = 4.0, 0.5, 1.0


def mark(tag: str, attributes: str, in_article: bool = False) -> tuple[int, int]:
    """What an element says about the text in it, and 1 if an outside word names
    it, -1 if it is the main part whatever words stand around it, else 0.
    ``in_article``: an <article> is open around it."""
    if tag in OUTSIDE_TAGS:
        return OUTSIDE, 0
    found = TAGGED if tag in ARTICLE_TAGS else HEADER if tag == "header" else NEUTRAL
    main = tag == "main"
    if not attributes.strip() or tag in ("html", "body"):
        return found, -main
    names: list[set[str]] = []
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id"):
            names += [set(WORD.findall(CAMEL.sub(" ", v).lower())) for v in value.split()]
        elif name == "role":
            role = value.strip().lower()
            if role in OUTSIDE_ROLES:
                return OUTSIDE, 0
            if role in ARTICLE_ROLES:
                found, main = TAGGED, main or role == "main"
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return OUTSIDE, 0
        elif name == "style" and HIDDEN.search(value):
            return OUTSIDE, 0
    if main:
        return found, -1
    words: set[str] = set().union(*names)
    if words & OUTSIDE_WORDS:
        # "post comments-open" is a post in some state, "post-comments" is not.
        outside = [n for n in names if n & OUTSIDE_WORDS]
        state = all(n - OUTSIDE_WORDS - ARTICLE_WORDS for n in outside) and any(
            n and n <= ARTICLE_WORDS for n in names
        )
        if found == TAGGED:
            # An article inside another may well be a comment on it.
            return found, int(in_article and not state)
        if not state:
            return NEUTRAL, 1
    if found == HEADER and not words & OUTER_WORDS - {"header"}:
        return HEADER, 0
    if words & OUTER_WORDS and found != TAGGED and not words & ARTICLE_WORDS:
        return OUTER, 0
    if words & ARTICLE_WORDS and found == NEUTRAL:
        return ARTICLE, 0
    return OUTER if found == HEADER else found, 0


class Node:
    """A block element that is open: its number, its parent, how deep it lies."""

    __slots__ = ("number", "parent", "depth")

    def __init__(self, number: int, parent: Node | None):
        self.number, self.parent = number, parent
        self.depth = parent.depth + 1 if parent else 0

    def steps_to(self, other: Node) -> int:
        """Elements between the two over their nearest common one."""
        a, b, steps = self, other, 0
        while a is not b:
            if a.depth >= b.depth:
                a = a.parent
            else:
                b = b.parent
            steps += 1
        return steps


class Block:
    """A run of text between block boundaries. ``named``: so many parts that it
    stands in are named by an outside word."""

    __slots__ = ("text", "links", "node", "mark", "tag", "named")

    def __init__(self, text: str, links: int, node: Node, mark: int, tag: str, named: int):
        self.text, self.links, self.node, self.mark, self.tag = text, links, node, mark, tag
        self.named = named


def inherited(outer: int, own: int) -> int:
    """A marked part inside another: nothing inside an outside part is an
    article again, an article inside a header or side column is; inside a side
    part of an article only one with an article's tag or role is."""
    if outer == OUTSIDE or own == OUTSIDE:
        return OUTSIDE
    if outer == SIDE:
        return own if own == TAGGED else SIDE
    if outer >= ARTICLE:
        if own == OUTER:
            return SIDE
        if outer == HEADER:
            return own if own == TAGGED else HEADER
        return max(outer, own)
    if own == HEADER:
        return OUTER
    return own if own != NEUTRAL else outer


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order. Elements left open end with their parent."""
    # One entry per open block element: tag, node, mark, parts named around it.
    stack: list[tuple[str, Node, int, int]] = [("", Node(0, None), NEUTRAL, 0)]
    headed: set[int] = set()  # headers that hold a heading
    blocks: list[Block] = []
    parts: list[str] = []
    links = in_link = silent = number = 0

    def flush() -> None:
        nonlocal links
        text = SPACE.sub(" ", "".join(parts)).strip(" ")
        if text:
            within, node, own, named = stack[-1]
            blocks.append(Block(text, links, node, own, within, named))
        parts.clear()
        links = 0

    def add(text: str) -> None:
        nonlocal links
        if text and not silent:
            text = html.unescape(text)
            parts.append(text)
            if in_link:
                links += len(text)

    at = 0
    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = m.group(1), (m.group(2) or "").lower(), m.group(3) or ""
        if not tag:
            continue
        if closing:
            if tag == "a":
                in_link = 0
            elif tag not in INLINE and tag not in VOID:
                depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == tag), 0)
                if depth:
                    flush()
                    for t, *_ in stack[depth:]:
                        silent -= t in SILENT
                    del stack[depth:]
                elif tag == "p":
                    flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                parts.append(" " if tag == "br" else "")
            continue
        if tag in INLINE:
            in_link = 1 if tag == "a" else in_link
            continue
        if tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}[^>]*>", re.IGNORECASE).search(page, at)
            if tag != "iframe":
                flush()
            at = end.end() if end else len(page)
            continue
        flush()
        if tag == "body" or tag in ARTICLE_TAGS and any(t in ("nav", "footer") for t, *_ in stack):
            # The page's head, menus and footers that were never closed end here.
            cut = next(
                (d for d in range(1, len(stack)) if stack[d][0] in ("head", "nav", "footer")),
                len(stack),
            )
            for t, *_ in stack[cut:]:
                silent -= t in SILENT
            del stack[cut:]
        ends = SELF_CLOSING.get(tag, ())
        if stack[-1][0] in ends or stack[-1][0] == "p" and tag not in SILENT:
            stack.pop()
        number += 1
        in_article = tag == "article" and any(t == "article" for t, *_ in stack)
        own, by_word = mark(tag, attributes, in_article)
        own = inherited(stack[-1][2], own)
        named = 0 if by_word < 0 else stack[-1][3] + by_word
        if attributes.endswith("/") and tag in SILENT:
            continue
        stack.append((tag, Node(number, stack[-1][1]), own, named))
        silent += tag in SILENT
        if tag in HEADINGS and own == HEADER:
            headed.update(n.number for _, n, m, _ in stack if m == HEADER)
    flush()
    settle(blocks, headed)
    return blocks


def settle(blocks: list[Block], headed: set[int]) -> None:
    """Marks that hang on the rest of the page. A header with the heading of its
    article belongs to it, another one is a side part. Parts named by outside
    words are outside, but those around the whole content are weighed. If all
    that an article has stands in side parts, they are no more than outer parts."""
    within: dict[int, bool] = {}  # whether an element lies in such a header

    def in_headed(node: Node | None) -> bool:
        above = []
        while node and node.number not in within and node.number not in headed:
            above.append(node.number)
            node = node.parent
        found = bool(node) and within.get(node.number, node.number in headed)
        within.update(dict.fromkeys(above, found))
        return found

    for b in blocks:
        if b.mark == HEADER:
            b.mark = TAGGED if in_headed(b.node) else SIDE
    if any(b.named for b in blocks):
        level = content_level(blocks)
        for b in blocks:
            if b.named > level:
                b.mark = OUTSIDE
    if not any(b.mark >= ARTICLE for b in blocks):
        for b in blocks:
            if b.mark == SIDE:
                b.mark = OUTER


def content_level(blocks: list[Block]) -> int:
    """How many parts named by outside words stand around the page's content: the
    fewest with an article by tag or role, or with blocks whose odds outweigh
    such a word; unmarked blocks do not when fewer words leave an article or a
    page heading."""
    marked = False
    for level in sorted({b.named for b in blocks if b.mark != OUTSIDE}):
        here = [b for b in blocks if b.named == level and b.mark != OUTSIDE]
        if any(b.mark == TAGGED for b in here):
            return level
        article = any(b.mark >= ARTICLE for b in here)
        if article or not marked:
            odds = (plain_odds(b) + (VOUCHED if b.mark >= ARTICLE else 0.0) for b in here)
            if sum(max(o, 0.0) for o in odds) >= NAMED:
                return level
        marked |= article or any(b.tag == "h1" and b.mark == NEUTRAL for b in here)
    return 0


def log_odds(block: Block) -> float:
    """How much likelier a block is content, from the parts that it stands in
    or else from what it is like."""
    if block.mark == OUTSIDE:
        return MARKED_OUTSIDE
    if block.mark == SIDE:
        return MARKED_SIDE
    if block.mark >= ARTICLE:
        return MARKED_ARTICLE
    return plain_odds(block)


def plain_odds(block: Block) -> float:
    """The odds from a block's length, links, punctuation and kind."""
    words = block.text.count(" ") + 1
    odds = -1.1 + 0.12 * min(words, 40) - 5.0 * block.links / len(block.text)
    odds += 0.8 if block.text[-1] in ".!?…。\"'”" else -0.3
    if block.tag in ("p", "blockquote", "pre", "figcaption"):
        odds += 0.8
    if block.tag == "h1":
        odds += 1.5
    if block.tag in ("li", "td", "th", "dt", "dd"):
        odds += -0.6 if block.links else 0.3
    if "©" in block.text and words < 40:
        odds -= 3.0
    if block.mark < ARTICLE and block.named:
        odds -= IN_NAMED
    return odds - (3.0 if block.mark in (OUTER, SIDE) else 0.0)


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness: neighbours in page order, the more the nearer in the tree,
    and the next block with the same parent."""
    edges = []
    last_in: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEAR / max(1, blocks[i - 1].node.steps_to(b.node) / 2)))
        parent = b.node.parent.number if b.node.parent else 0
        if last_in.get(parent, i) < i - 1:
            edges.append((last_in[parent], i, TREE))
        last_in[parent] = i
    return edges


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source's side. The source feeds nodes with
    positive odds, the others drain into the sink; Dinic's maximum flow with
    breadth-first levels and an explicit stack, so long pages do not recurse."""
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, o in enumerate(odds):
        link(*((source, i) if o > 0 else (i, sink)), abs(o), 0.0)
    for a, b, w in edges:
        link(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        following = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if room[e] <= tiny)
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while following[u] < len(out[u]):
                e = out[u][following[u]]
                if room[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                following[u] += 1
            if following[u] < len(out[u]):
                path.append(out[u][following[u]])
                u = to[path[-1]]
            elif not path:
                break
            else:
                u = to[path.pop() ^ 1]
                following[u] += 1


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    content = minimum_cut([log_odds(b) for b in blocks], edges_of(blocks))
    return " ".join(b.text for b, kept in zip(blocks, content) if kept)


SCHEMA = pa.schema([("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """Every row with ``text``, the main text of the whole page, and ``n_chars``,
    its code points.

    Character references are decoded, white space inside a block becomes one
    space, blocks of the article are joined in page order by one space. A page
    that is null, empty or without an article gives an empty text. Broken markup
    is read as far as it goes. Repeated pages give equal texts, an empty table
    stays empty, input columns with these names are replaced.
    """

    def run(column: pa.Array) -> list:
        texts = [main_text(p).encode("utf-8", "replace").decode() for p in column.to_pylist()]
        return [texts, [len(t) for t in texts]]

    return annotate(pages, [page], run, SCHEMA)
