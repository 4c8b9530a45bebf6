"""Main text of web pages by tree scoring.

A page is read into a tree of elements whose texts form blocks. Each paragraph
block gives points for its length and its commas to its container and, in
falling shares, to the container's ancestors; a container's total is
discounted by its link density. An <article> or <main> around the best
container is the article, with the siblings that score near it and the titles
before it. Without one, the best container is never left out, and what stands
beside it or its ancestors stays whatever its length, but for boxes of links
with a sign of a menu and copyright lines. Elements that are never part of the text (scripts, forms, menus, page
headers and footers, sidebars, notices, adverts, reader comments) are left
out by tag or by the words of their class, id and role.

Defined results: null and empty pages give an empty text; broken, unclosed and
truncated markup is read as far as it goes; a page whose parts all look like
furniture is read again with only scripts, styles and the like left out; <br>
is white space inside its block; nothing is capped. Rows stand for themselves,
so repeated rows give repeated results and an empty table an empty one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element kinds of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p "
    "pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
CLOSES_P = BLOCKS - {"body", "html", "head", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option"}
# an opening tag ends an open element of these kinds, up to the given fences
SAME_KIND = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

# Never part of the text, whatever the page.
NEVER = RAW | frozenset("audio button canvas datalist head map math object select svg video".split())
# Page furniture by tag.
FURNITURE = frozenset("aside dialog footer form menu nav search".split())
FURNITURE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
# Words of names (class, id) that say furniture by themselves, and words that say it
# only where the whole name is made of such words and stands outside an article.
CERTAIN_WORDS = re.compile(
    r"ads?|adbox|adsense|adslot|advert\w*|breadcrumbs?|comments?|commentlist|consent|cookies?|disqus|footer|gdpr|menu|"
    r"modal|nav|navbar|navigation|newsletter|pager|pagination|popup|replies|respond|sidebar|signup|sponsor\w*|"
    r"subscribe|subscription|toolbar|topbar"
)
POSSIBLE_WORDS = re.compile(
    r"banner|header|masthead|notice|notification|overlay|promo\w*|recommended|related|reply|share|sharing|social|widgets?"
)
# Words that say nothing beside those.
PLAIN_WORDS = re.compile(
    r"area|articles?|bar|block|bottom|box|buttons?|container|content|form|global|group|icons?|inner|items?|left|links?|"
    r"lists?|main|module|outer|page|pages|panel|posts?|right|section|side|site|slot|stories|story|thread|top|unit|wrap|"
    r"wrapper|\d+"
)
FURNITURE_WORDS = re.compile(rf"(?:^|[\s_-])(?:{CERTAIN_WORDS.pattern}|{POSSIBLE_WORDS.pattern})(?:$|[\s_-])")
LAYOUT_WORDS = re.compile(r"(?:^|(?<=[\s_-]))(?:with|has|no|without)[_-][a-z]+")  # say what stands beside
TEXT_WORDS = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|story|text)(?:$|[\s_-])")
CONTAINERS = frozenset(["html", "body", "article", "main"])

TOKEN = re.compile(
    r"(?P<text>[^<]+)"
    r"|<!--(?:>|->|(?P<comment>.*?)(?:-->|--!>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:\"[^\"<]*+\"|'[^'<]*+'|[^'\">])*+|[^>]*+)(?P<end>>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<stray><)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

LEGAL = re.compile(r"(?:©|\(c\)\s*(?:©|\d{4})|copyright\s*(?:©|\(c\)|\d{4}))", re.I)  # at the start of a line
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOXES = frozenset("ul ol div table section dl".split())

SHORT = 25  # characters; shorter paragraphs give no points, links of shorter labels are a sign of a menu
LINKED = 0.66  # link density above which a box is one of links
SIBLING_SHARE = 0.2
PARAGRAPH = 80  # characters of a block, without its links, that make a box one of text


class Node:
    __slots__ = (
        "tag", "parent", "skip", "weight", "link", "chars", "link_chars", "points", "order",
        "links", "labelled", "first", "last", "own", "doubtful", "longest",
    )

    def __init__(self, tag, parent, skip, weight, link, order):
        self.tag, self.parent, self.skip, self.weight, self.link, self.order = tag, parent, skip, weight, link, order
        self.chars = self.link_chars = 0
        self.points = 0.0
        self.links = int(tag == "a")
        self.labelled = tag in ("th", "caption")  # a table of data
        self.first = self.last = None  # places of its first and last block
        self.doubtful = False  # by its name it may be furniture
        self.longest = 0  # unlinked characters of its longest block
        self.own = []  # link characters of its own blocks

    def density(self) -> float:
        return self.link_chars / self.chars if self.chars else 0.0


def _name(names: str, inside_article: bool) -> str:
    """What class and id say of a box: 'certain' or 'possible' furniture, or ''."""
    found = ""
    for one in names.split():
        words = [w for w in re.split(r"[_-]+", one) if w]
        certain = any(CERTAIN_WORDS.fullmatch(w) for w in words)
        possible = any(POSSIBLE_WORDS.fullmatch(w) for w in words)
        if not certain and not possible:
            continue
        whole = all(
            CERTAIN_WORDS.fullmatch(w) or POSSIBLE_WORDS.fullmatch(w) or PLAIN_WORDS.fullmatch(w) for w in words
        )
        if whole and (certain or not inside_article):
            return "certain"
        if inside_article and not certain and set(words) & {"header", "banner", "masthead"}:
            continue  # an article's own head
        found = "possible"
    return found


def _traits(tag: str, attrs: str, inside_article: bool, strict: bool) -> tuple[bool, int, bool]:
    """(left out, weight by names, perhaps to be left out) of an element."""
    if tag in NEVER:
        return True, 0, False
    if not strict:
        return False, 0, False
    if tag in FURNITURE or tag == "header" and not inside_article:
        return True, 0, False
    names = []
    for name, a, b, c in ATTRIBUTE.findall(attrs) if attrs else ():
        name, value = name.lower(), (a or b or c).lower()
        if name == "role":
            if value in FURNITURE_ROLES and tag not in CONTAINERS:
                return True, 0, False
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            if tag not in CONTAINERS:
                return True, 0, False
        else:
            names.append(value)
    words = LAYOUT_WORDS.sub("", " ".join(names))
    if not words:
        return False, 0, False
    said = "" if tag in CONTAINERS or tag in ("h1", "h2") else _name(words, inside_article)
    if said == "certain":
        return True, 0, False
    return False, 25 if TEXT_WORDS.search(words) else 0, said == "possible"


class _Open:
    """The open elements, with the places of each kind, so that no step walks the whole stack."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def last(self, *tags: str) -> int:
        """Place of the innermost open element of these kinds; 0 if there is none."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def push(self, node: Node) -> None:
        at = len(self.stack)
        self.stack.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag in BLOCKS:
            self.blocks.append(at)

    def pop_to(self, at: int) -> None:
        while len(self.stack) > at:
            node = self.stack.pop()
            self.places[node.tag].pop()
            if node.tag in BLOCKS:
                self.blocks.pop()

    def block(self) -> Node:
        """The innermost open block, or the root."""
        return self.stack[self.blocks[-1] if self.blocks else 0]


def _read(page: str, strict: bool) -> tuple[list[Node], list[tuple[Node, str]]]:
    """The page's elements in order and its blocks (container, text)."""
    root = Node("", None, False, 0, False, 0)
    nodes, blocks, opened = [root], [], _Open(root)
    stack = opened.stack
    parts: list[tuple[str, bool]] = []  # of the block being read, with whether each is link text
    place, size = 0, len(page)

    def flush():
        if parts:
            raw = "".join(p for p, _ in parts)
            text = " ".join(html.unescape(raw).split())
            if text:
                node = opened.block()
                node.chars += len(text)
                linked_chars = min(len(text), sum(len(p.strip()) for p, linked in parts if linked))
                node.link_chars += linked_chars
                node.longest = max(node.longest, len(text) - linked_chars)
                node.first = len(blocks) if node.first is None else node.first
                node.last = len(blocks)
                node.own.append(linked_chars)
                blocks.append((node, text))
            parts.clear()

    def pop_to(at: int):
        if opened.blocks and opened.blocks[-1] >= at:
            flush()
        opened.pop_to(at)

    while place < size:
        token = TOKEN.match(page, place)
        place = token.end()
        top = stack[-1]
        if (text := token["text"] or token["stray"]) is not None:
            if not top.skip:
                parts.append((text, top.link))
            continue
        if token["name"] is None or not token["end"]:
            continue
        tag = token["name"].lower()
        if token["close"]:
            at = opened.last(tag)
            fenced = 0 if tag in CONTAINERS or tag == "table" else opened.last("article", "main", "td", "table")
            if at and at >= fenced:
                pop_to(at)
            elif not fenced and tag in BLOCKS:
                flush()
            continue
        if tag in CLOSES_P and opened.block().tag == "p":
            pop_to(opened.blocks[-1])
        if tag in SAME_KIND:
            ends, fences = SAME_KIND[tag]
            while (at := opened.last(*ends)) > opened.last(*fences):
                pop_to(at)
                if tag != "tr":
                    break
        if tag in BLOCKS:
            flush()
        if tag == "br":
            parts.append((" ", False))
        if tag in VOID:
            continue
        attrs = token["attrs"]
        if tag in RAW and not attrs.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, place)
            place = end.end() if end else size
            continue
        top = stack[-1]
        inside = opened.last("article", "main") > 0
        left_out, weight, doubtful = (True, 0, False) if top.skip else _traits(tag, attrs, inside, strict)
        node = Node(tag, top, left_out, weight, top.link or tag == "a", len(nodes))
        node.doubtful = doubtful
        if attrs.endswith("/") and tag not in BLOCKS:
            continue
        nodes.append(node)
        opened.push(node)
    flush()
    return nodes, blocks


def _score(nodes: list[Node], blocks: list[tuple[Node, str]]) -> None:
    for node, text in blocks:
        if len(text) < SHORT or node.tag in HEADINGS:
            continue
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - node.density())
        up = node.parent if node.tag in ("p", "pre", "td", "li", "blockquote") and node.parent else node
        share = 1.0
        while up is not None and share > 0.1:
            up.points += points * share
            up, share = up.parent, share / 2
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.link_chars += node.link_chars
            node.parent.links += node.links
            node.parent.labelled |= node.labelled
            node.parent.longest = max(node.parent.longest, node.longest)
            if node.first is not None:
                node.parent.first = node.first if node.parent.first is None else min(node.first, node.parent.first)
                node.parent.last = node.last if node.parent.last is None else max(node.last, node.parent.last)
    for node in nodes:
        if node.points:
            node.points = (node.points + node.weight) * (1 - node.density())
    for node in nodes:  # in page order, so parents come first
        if node.parent is not None and node.parent.skip:
            node.skip, node.points = True, 0.0
        elif node.doubtful and (node.longest < PARAGRAPH or node.density() > LINKED / 2):
            node.skip, node.points = True, 0.0


def _menu(node: Node, blocks: list[tuple[Node, str]]) -> bool:
    """Whether a box is one of links by its density and a further sign: short labels that nothing introduces.

    A heading under the title, or a line ending in a colon, introduces the
    links after it, unless its words are those of furniture. Tables with
    header cells or a caption are data.
    """
    if not node.chars or node.density() <= LINKED or node.link_chars >= SHORT * node.links or node.labelled:
        return False
    for place in (node.first, node.first - 1):
        up, text = blocks[place] if place >= 0 else (node, "")
        if up.tag in HEADINGS and up.tag != "h1" or text.endswith(":"):
            return FURNITURE_WORDS.search(text.lower()) is not None
    return True


def _foot(blocks: list[tuple[Node, str]]) -> int:
    """Where the page's foot starts: its last blocks, as far as they are copyright lines or links."""
    at = len(blocks)
    while at and (LEGAL.match(blocks[at - 1][1]) or blocks[at - 1][0].density() > LINKED):
        at -= 1
    return at


def _legal(blocks: list[tuple[Node, str]], first: int, last: int, foot: int) -> bool:
    """Whether the blocks from ``first`` to ``last`` are copyright lines at the page's foot."""
    return foot <= first and all(LEGAL.match(text) for _, text in blocks[first : last + 1])


def _beside(node: Node, blocks: list[tuple[Node, str]], foot: int) -> bool:
    """Whether an element beside the best container or its ancestors is text of the page."""
    if node.skip or not node.chars or _legal(blocks, node.first, node.last, foot):
        return False
    return not ((node.tag in BOXES or node.links > 1) and _menu(node, blocks))


def _inside(nodes: list[Node], blocks: list[tuple[Node, str]]) -> list[bool]:
    """Whether each block is part of the article."""
    foot = _foot(blocks)
    best = max(nodes, key=lambda n: (n.points, -n.order))
    path, keep = set(), set()  # ancestors of the best container; kept elements
    if best.points <= 0:
        named = [n for n in nodes if n.tag in ("article", "main") and n.chars and not n.skip]
        best = max(named, key=lambda n: (n.chars, -n.order)) if named else nodes[0]
    else:
        up = best
        while up is not None and up.tag not in ("article", "main"):
            up = up.parent
        if up is not None:
            best = up
            for node in nodes:
                if node.parent is best.parent and node is not best and not node.skip and node.chars:
                    near = node.points >= SIBLING_SHARE * best.points
                    text = node.tag in ("article", "p", "blockquote", "pre") or node.tag in HEADINGS
                    legal = _legal(blocks, node.first, node.last, foot)
                    if near or text and node.density() < 0.25 and not legal:
                        keep.add(node.order)
        else:
            up = best.parent
            while up is not None:
                path.add(up.order)
                up = up.parent
    keep.add(best.order)
    inside = [False] * len(nodes)
    for node in nodes:
        if node.parent is None or node.order in keep or node.order in path:
            inside[node.order] = node.order in keep
        elif node.parent.order in path:
            inside[node.order] = _beside(node, blocks, foot)
        elif inside[node.parent.order]:
            inside[node.order] = not node.skip and not (node.tag in BOXES and _menu(node, blocks))
    found = []
    seen = dict.fromkeys(path, 0)
    for place, (node, text) in enumerate(blocks):
        if node.order in path:
            linked = node.own[seen[node.order]]
            seen[node.order] += 1
            kept = linked <= LINKED * len(text)
        else:
            kept = inside[node.order]
        found.append(kept and (best.tag in ("article", "main") or not _legal(blocks, place, place, foot)))
    return found


def extract(page: str | None) -> str:
    """The page's main text: blocks in page order, one a line."""
    if not page:
        return ""
    for strict in (True, False):
        nodes, blocks = _read(page, strict)
        if not blocks:
            continue
        _score(nodes, blocks)
        found = "\n".join(text for (_, text), kept in zip(blocks, _inside(nodes, blocks), strict=True) if kept)
        if found:
            return found
    return ""


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
