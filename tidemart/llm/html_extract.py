"""Main-text extraction by tree scoring."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
    ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul""".split())
RAW = "script|style|noscript|template|textarea|title|svg|iframe|object|canvas|select|video|audio"
DROPPED = frozenset("nav footer aside form fieldset dialog menu head search input".split())
OUTSIDE = frozenset("header button label".split())  # dropped but for inside an article
CLOSES = {  # an opening tag ends these open elements, up to the enclosing one of the second set
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
#: Words in a class or id that mark what isn't the article.
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|signup|paywall|sidebar|side-bar|rail|widgets?|comments?|commentlist|replies|reply|"
    r"respond|disqus|discussion|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|footer|colophon|masthead|"
    r"site-?header|page-?header|top-?bar|share|sharing|social|related|recommended|recommendations|trending|toolbar|tags|skip|"
    r"search|login)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_QUOTED = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+"
_RAW_OR_COMMENT = r"<!--.*?(?P<closed>-->|\Z)|<(?P<raw>" + RAW + r")\b" + _QUOTED + r">.*?(?P<end></(?P=raw)\s*>|\Z)|<[!?][^>]*>"
_TAG = r"<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?:(?P<strict>" + _QUOTED + r")>|(?P<loose>[^>]*)>)"
_LOOSE_TAG = r"<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<strict>(?P<loose>[^>]*))>"
TOKEN = re.compile(f"{_RAW_OR_COMMENT}|{_TAG}", re.S | re.I)
#: For the rest of a page once a quote turned out to be open to its end.
LOOSE_TOKEN = re.compile(f"{_RAW_OR_COMMENT}|{_LOOSE_TAG}".replace(_QUOTED, "[^>]*+"), re.S | re.I)
CUT_OFF = re.compile(r"<[a-zA-Z/!?]")
PARAGRAPH = 25  # characters from which a block passes points on


@dataclass(eq=False)
class Node:
    tag: str
    parent: Node | None
    out: bool = False  # it or an element around it isn't the article's
    doubt: str = ""  # its class or id has a word of furniture: as a "word" of its own, or as a "part" of one
    doubts: int = 0  # such elements around it, itself included
    inside: bool = False  # it is in an article or main element
    block: Node | None = None  # the nearest block element, itself included
    items: Node | None = None  # the nearest list
    score: float = 0.0
    points: float = 0.0  # of all blocks inside
    chars: int = 0
    link_chars: int = 0
    kept: bool = False


@dataclass(eq=False)
class Block:
    node: Node
    pieces: list[str] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""


def attributes(source: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(source)}


def furniture(tag: str, source: str, inside: bool) -> str:
    """Whether an element is page furniture: "yes" by its name, role or being
    hidden, "word" or "part" if only a word in its class or id says so, ""."""
    if tag in DROPPED or (tag in OUTSIDE and not inside):
        return "yes"
    if not source or tag in ("html", "body", "main") or tag[0] == "h" and tag[1:].isdigit():
        return ""
    a = attributes(source)
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in ROLES:
        return "yes"
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "")):
        return "yes"
    name = f"{a.get('class', '')} {a.get('id', '')}"
    if not UNLIKELY.search(name) or tag == "article" and not re.search("comment|reply|promo|sponsor|related", name, re.I):
        return ""
    return "word" if any((m := UNLIKELY.search(x)) and m[0] == x for x in name.split()) else "part"


def tokens(source: str) -> Iterator[re.Match | str]:
    """Tags as matches and the text between them.  Comments, scripts and the
    like are passed over, open ones to the end of the page.  A tag cut off by
    the end is dropped."""
    pattern, at, stop = TOKEN, 0, source.rfind(">") + 1
    while at < stop and (m := pattern.search(source, at, stop)):
        if m.start() > at:
            yield source[at:m.start()]
        at = m.end()
        if m["tag"]:
            if m["strict"] is None:
                pattern = LOOSE_TOKEN
            yield m
        elif m["closed"] == "" or m["end"] == "":
            return
    rest = source[at:]
    cut = CUT_OFF.search(rest)
    yield rest[:cut.start()] if cut else rest


def parse(source: str) -> tuple[list[Node], list[Block]]:
    """The elements in page order, and the text blocks in page order."""
    root = Node("", None)
    root.block = root
    nodes, stack, opened = [root], [root], Counter()
    blocks, block = [], None

    def pop_to(n: int) -> None:
        opened.subtract(x.tag for x in stack[n:])
        del stack[n:]

    def nearest(wanted: frozenset | set, limit: frozenset | set) -> int:
        """Place of the innermost open element of some kinds, 0 if one of the limit is before it."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in wanted:
                return i
            if stack[i].tag in limit:
                return 0
        return 0

    for m in tokens(source):
        if isinstance(m, str):
            if stack[-1].out or (block is None and m.isspace()) or not m:
                continue
            if block is None:
                block = Block(stack[-1].block)
                blocks.append(block)
            piece = entities.unescape(m) if "&" in m else m
            block.pieces.append(piece)
            if opened["a"] > 0:
                block.link_chars += len(piece)
            continue
        tag = m["tag"].lower()
        inline = tag not in BLOCK
        if not inline:
            block = None
        if m["close"]:
            if opened[tag] > 0 and (n := nearest({tag}, BLOCK if inline else frozenset())):
                pop_to(n)
            continue
        if tag in VOID:
            if tag == "br" and block is not None:
                block.pieces.append(" ")
            continue
        if not inline and opened["p"] > 0 and (n := nearest({"p"}, BLOCK)):
            pop_to(n)  # a paragraph ends where the next block begins
        if tag in CLOSES and (n := nearest(*CLOSES[tag])):
            pop_to(n)
        up = stack[-1]
        kind = furniture(tag, m["strict"] or m["loose"] or "", up.inside)
        node = Node(tag, up, up.out or kind == "yes" or bool(kind) and inline, inside=up.inside or tag in ("article", "main"))
        node.doubt = kind if kind != "yes" and not inline else ""
        node.doubts = up.doubts + bool(node.doubt)
        node.block = up.block if inline else node
        node.items = node if tag in ("ul", "ol") else up.items
        nodes.append(node)
        stack.append(node)
        opened[tag] += 1
    for b in blocks:
        b.text = " ".join("".join(b.pieces).split())
    return nodes, [b for b in blocks if b.text]


def above(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def points(block: Block) -> float:
    """What a block passes on: 1, one for each comma and one for each hundred
    characters (three at most); short and linked blocks pass nothing."""
    if len(block.text) < PARAGRAPH or block.link_chars > len(block.text) / 2:
        return 0
    return 1 + block.text.count(",") + min(len(block.text) // 100, 3)


def settle(nodes: list[Node], blocks: list[Block]) -> list[Block]:
    """Decide on the elements that only a class or id calls furniture, and
    give the blocks that are left.

    Such a word never takes the article away: the elements around the article
    or main element (the one with fewest doubts around it, then the longest)
    stay.  On a page without one, an element with such a word as part of a
    longer one stays if it has over half of all points."""
    held = Counter()
    for b in blocks:
        b.node.points += points(b)
        held[b.node] += len(b.text)
    for n in reversed(nodes[1:]):
        n.parent.points += n.points
        held[n.parent] += held[n]
    articles = [n for n in nodes if n.tag in ("article", "main") and not n.doubt and not n.out and held[n]]
    if articles:
        stay = set(above(min(articles, key=lambda n: (n.doubts, -held[n]))))
    else:
        stay = {n for n in nodes if n.doubt == "part" and n.points > nodes[0].points / 2}
    for n in nodes[1:]:
        n.out = n.out or n.parent.out or bool(n.doubt) and n not in stay
    return [b for b in blocks if not b.node.out]


def main_text(source: str | None) -> str:
    """The article of a page, one block a line.

    A block passes points (see ``points``) to the elements around it, in full
    to the nearest container and a falling share to the five around that.  A
    container's points are discounted by its link density.  The best
    container is kept, widened to the article or main element around it, with
    its siblings: beside an article other articles and what scores a fifth of
    it, else all that isn't mostly links, however short.  Page furniture (see
    ``furniture`` and ``settle``) and lists of links never count.  A page
    without a block that passes points gives the article or main element,
    else all that isn't furniture.  Null gives '', as does an empty page."""
    if not source:
        return ""
    nodes, blocks = parse(source)
    blocks, scored = settle(nodes, blocks), []
    for b in blocks:
        b.node.chars += len(b.text)
        b.node.link_chars += min(b.link_chars, len(b.text))
        own = b.node.parent if b.node.tag in ("p", "pre", "li", "td", "th", "dd", "dt", "blockquote", "figcaption") else b.node
        if gain := points(b):
            for n, part in zip(above(own), (1, 2, 3, 6, 9, 12)):
                if n.tag not in ("html", ""):
                    n.score += gain / part
                    scored.append(n)
    for n in reversed(nodes[1:]):  # children come after their parents
        n.parent.chars += n.chars
        n.parent.link_chars += n.link_chars

    def value(n: Node) -> float:
        return n.score * (1 - n.link_chars / n.chars) if n.chars else 0.0

    if scored:
        best = max(scored, key=value)
        best = next((n for n in above(best) if n.tag == "article"), None) or next((n for n in above(best) if n.tag == "main"), best)
    else:
        best = max((n for n in nodes if n.tag in ("article", "main") and n.chars and not n.out), key=lambda n: n.chars, default=nodes[0])
    best.kept, level = True, value(best)
    for n in nodes:
        if n.parent is not None and n.parent is best.parent and n.chars and not n.kept and n.link_chars <= n.chars / 2:
            n.kept = n.tag == best.tag or value(n) >= level / 5 if best.tag in ("article", "main") else True
    for n in nodes[1:]:
        n.kept = n.kept or n.parent.kept
    menu = lambda n: n.items is not None and not n.inside and n.items.link_chars >= 0.9 * n.items.chars
    return "\n".join(b.text for b in blocks if b.node.kept and not menu(b.node))


def extract(html: Column) -> Column:
    """``main_text`` of a string column, in Arrow batches.  Null and empty
    pages give ''; a page's text depends on that page alone, so repeated rows
    get the same; an empty table gives no rows."""
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return run(html)
