"""Main text of web pages by composite text density.

A page becomes a tree of its block elements and links.  Every node has the
density

    C / T * ln(C / LC * T / LT) / ln(max(e, ln(C / (C - LC) * LC + LB / CB * C + e)))

with C characters and T tags in it, LC characters and LT tags of links, and LB,
CB the same of the body (zeros count as one), so that link lists score low.  A
node's sum adds the densities of its children and of its own text.  The node of
the largest sum is the centre of the main text (of equals the first) and is
taken whole.  The threshold is the least density on the path from the body to
it; siblings along the path, and runs of bare text of the nodes on it, that reach
the threshold are taken with it.  ``article`` and ``main`` elements decide
nothing; ``marked_text`` gives their text for comparison.

Elements that are page furniture by tag or role (menus, headers, footers, scripts,
styles) are taken out before anything is counted.  A word of the class or id (sidebar,
notice, advert) only raises a doubt: such an element goes if links are a third of
its text, or unless it has ``PROSE`` characters and is half of the page's text or half
as dense (in characters a tag).  One that holds all of the page's text stays.

Reader comments can be as long and as dense as the article, so their containers
(a class or id such as ``comments``, ``comment-list`` or ``disqus_thread``) go whatever they
hold, unless nothing else is left or the page's ``h1`` or ``main`` is in them.  Names of a
state, such as ``has-comments`` or ``comments-open``, say nothing.  A form goes unless it
is a wrapper: half of the page's text or more, and ``PROSE`` characters.

Character references are decoded, white space within a block becomes one space,
and blocks are joined by a line feed in page order.  Null and empty pages, and
pages without text, give the empty text.  Unclosed and stray tags are repaired
as browsers do in the common cases; a page cut anywhere keeps what was read.
Rows are judged one by one, so ties, repeated rows and empty tables need no
care; columns other than ``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
# Every attribute is read, so that no value is taken for a name.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
# Characters from which a doubted element can be running text.
PROSE = 100
_NAME_PART = re.compile(r"[a-z]+")

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Contents are not markup.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
_FURNITURE = frozenset(
    "script style noscript template nav footer aside button select textarea iframe svg head title menu dialog object".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner menu nav navbar navigation breadcrumb breadcrumbs sidebar "
    "footer cookie cookies consent gdpr notice popup modal newsletter subscribe subscription signup comment comments disqus reply "
    "replies share sharing social related recommended login search masthead topbar".split()
)
_COMMENTS = frozenset("comment comments reply replies disqus".split())
# A name with one of these is a state of its element.
_STATES = frozenset("has with without no not show hide hidden open closed enabled disabled count off on page article post content main body wrapper layout".split())
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LIMITS = frozenset("ul ol dl table tbody thead tfoot select article body section div".split())


class _Node:
    __slots__ = ("tag", "parent", "children", "text", "chars", "tags", "link_chars", "link_tags", "own", "density", "total", "doubted", "comments")

    def __init__(self, tag: str, parent: _Node | None, doubted: bool = False, comments: bool = False):
        self.tag, self.parent, self.doubted, self.comments = tag, parent, doubted, comments
        # Texts and nodes in page order.
        self.children: list[str | _Node] = []


def _named(attributes: str, names: tuple[str, ...], words: frozenset[str]) -> bool:
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() in names and any(w in words for w in _NAME_PART.findall((a or b or c).lower())):
            return True
    return False


def _is_furniture(tag: str, attributes: str, stack: list[_Node]) -> bool:
    if tag in _FURNITURE or (tag == "header" and not any(n.tag == "article" for n in stack)):
        return True
    return tag not in ("body", "html", "article", "main") and _named(attributes, ("role",), _ROLES)


def _is_doubted(tag: str, attributes: str) -> bool:
    return tag not in ("body", "html", "article", "main") and _named(attributes, ("class", "id"), _WORDS)


def _is_comments(tag: str, attributes: str) -> bool:
    """Whether a name of the class or id stands for reader comments; an ``article`` or ``main`` has to be one comment by its whole name."""
    if tag in ("body", "html"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() not in ("class", "id"):
            continue
        for one in (a or b or c).lower().split():
            words = _NAME_PART.findall(one)
            if _COMMENTS.intersection(words) and not _STATES.intersection(words) and (tag not in ("article", "main") or len(words) == 1):
                return True
    return False


def parse(page: str) -> _Node:
    """Tree of what is left of a page without what is furniture by tag or role."""
    root = _Node("body", None)
    stack = [root]
    # Open elements inside furniture: nothing of it is kept.
    hidden: list[str] = []
    at, n = 0, len(page)
    while at < n:
        token = _TOKEN.search(page, at)
        begin = token.start() if token else n
        if begin > at and not hidden:
            stack[-1].children.append(page[at:begin])
        if not token:
            break
        at = token.end()
        tag = token[2]
        if not tag:
            continue
        tag = tag.lower()
        if token[1]:
            if hidden:
                if tag in hidden:
                    while hidden.pop() != tag:
                        pass
                elif tag in ("body", "html", "article", "main") and any(x.tag == tag for x in stack):
                    hidden.clear()
                else:
                    continue
                if tag not in ("body", "html", "article", "main"):
                    continue
            for i in range(len(stack) - 1, 0, -1):
                # Inline elements stand in the tree only in doubt, and never close a block.
                if tag in _INLINE and tag != "a" and stack[i].tag not in _INLINE:
                    break
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        raw = tag in _RAW
        if raw:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            body = page[at : end.start()] if end else page[at:]
            at = n if not end else (page.find(">", end.end()) + 1 or n)
            if not hidden and tag not in _FURNITURE and tag not in ("xmp",):
                continue
            if tag == "xmp" and not hidden:
                stack[-1].children.append(_html.escape(body))
            continue
        void = tag in _VOID or token[3].endswith("/") and tag in ("br", "hr", "img")
        if hidden:
            if tag == "body":
                hidden.clear()
            elif not void:
                if tag == "p" and hidden[-1] == "p" or tag == "li" and hidden[-1] == "li":
                    hidden.pop()
                hidden.append(tag)
            continue
        if tag in ("html", "body"):
            continue
        if tag in _CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag != "a":
                    break
        for other in _SAME.get(tag, ()):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == other:
                    del stack[i:]
                    break
                if stack[i].tag in _LIMITS:
                    break
        if _is_furniture(tag, token[3], stack):
            if not void:
                hidden.append(tag)
            continue
        comments = _is_comments(tag, token[3])
        doubted = comments or _is_doubted(tag, token[3])
        # Within a doubted inline element its like are counted too, so that it ends at its own end tag.
        kept_inline = tag in _INLINE and (doubted or any(x.tag == tag for x in stack))
        if tag in ("br", "wbr"):
            stack[-1].children.append("\n" if tag == "br" else "")
        elif void or (tag in _INLINE and tag != "a" and not kept_inline):
            if tag == "hr":
                stack[-1].children.append(_Node("hr", stack[-1]))
            continue
        else:
            node = _Node(tag, stack[-1], doubted, comments)
            stack[-1].children.append(node)
            stack.append(node)
    return root


def _in_order(root: _Node) -> list[_Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in reversed(node.children) if isinstance(c, _Node))
    return out


def _measure(nodes: list[_Node]):
    """Set the figures of all nodes; gives the density as a function."""
    for node in reversed(nodes):
        own = sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str))
        node.own, node.chars, node.tags, node.link_chars, node.link_tags = own, own, 1, 0, 0
        for c in node.children:
            if isinstance(c, _Node):
                node.chars += c.chars
                node.tags += c.tags
                node.link_chars += c.link_chars
                node.link_tags += c.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    body = nodes[0]
    share = body.link_chars / max(body.chars, 1)

    def density(chars: int, tags: int, link_chars: int, link_tags: int) -> float:
        if not chars:
            return 0.0
        base = math.log(chars / max(chars - link_chars, 1) * link_chars + share * chars + math.e)
        return chars / tags * math.log(chars / max(link_chars, 1) * tags / max(link_tags, 1)) / math.log(max(base, math.e))

    for node in reversed(nodes):
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags)
        inner = sum(c.density for c in node.children if isinstance(c, _Node))
        node.total = inner + (0.0 if node.tag == "a" else density(node.own, 1, 0, 0))
    return density


def _settle(root: _Node) -> list[_Node]:
    """Take the doubted elements out that are furniture by what they hold; the nodes that are left."""
    nodes = _in_order(root)
    if any(x.comments for x in nodes):
        _measure(nodes)
        # The outermost containers go first; one that holds the page's heading is its layout.
        heads = set()
        for x in reversed(nodes):
            if x.tag in ("h1", "main") or any(id(c) in heads for c in x.children if isinstance(c, _Node)):
                heads.add(id(x))
        gone = {id(x) for x in nodes if x.comments and id(x) not in heads and x.chars < root.chars}
        nodes = _without(root, gone)
    if not any(x.doubted or x.tag == "form" for x in nodes):
        return nodes
    _measure(nodes)
    gone = set()
    for x in nodes:
        half = 2 * x.chars >= root.chars
        if x.tag == "form" and not (half and x.chars >= PROSE):
            gone.add(id(x))
        dense = half or 2 * x.chars * root.tags >= root.chars * x.tags
        if x.doubted and (3 * x.link_chars >= x.chars or not (x.chars == root.chars or x.chars >= PROSE and dense)):
            gone.add(id(x))
    return _without(root, gone)


def _without(root: _Node, gone: set[int]) -> list[_Node]:
    for x in _in_order(root):
        x.children = [c for c in x.children if isinstance(c, str) or id(c) not in gone]
    return _in_order(root)


def _blocks(node: _Node, out: list[list[str]], taken: set[int] | None = None) -> None:
    """Text of a subtree, or of the children in ``taken`` and what lies in them; blocks begin and end at block elements."""
    todo: list[tuple[_Node, int, bool]] = [(node, 0, taken is None or id(node) in taken)]
    out.append([])
    while todo:
        current, i, whole = todo.pop()
        if i == len(current.children):
            if current.tag not in _INLINE:
                out.append([])
            continue
        todo.append((current, i + 1, whole))
        child = current.children[i]
        if isinstance(child, str):
            if whole or (id(current), i) in taken:
                out[-1].append(child)
        else:
            if child.tag not in _INLINE:
                out.append([])
            todo.append((child, 0, whole or id(child) in taken))


def _lines(blocks: list[list[str]]) -> str:
    lines = (" ".join(_html.unescape("".join(parts)).split()) for parts in blocks)
    return "\n".join(line for line in lines if line)


def marked_text(page: str) -> str | None:
    """Text of the page's only ``article`` (or else only ``main``) element; None if it has none or several."""
    nodes = _settle(parse(page))
    for tag in ("article", "main"):
        found = [x for x in nodes if x.tag == tag]
        if found:
            blocks: list[list[str]] = []
            _blocks(found[0], blocks)
            return _lines(blocks) if len(found) == 1 else None
    return None


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    nodes = _settle(root)
    density = _measure(nodes)
    if not root.chars:
        return ""
    best = max(nodes, key=lambda x: x.total)
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(x.density for x in path)
    taken: set = {id(best)}
    for on, parent in zip(path, path[1:]):
        for i, c in enumerate(parent.children):
            if c is on:
                continue
            reached = density(len(" ".join(c.split())), 1, 0, 0) if isinstance(c, str) else c.density
            if reached >= threshold > 0:
                taken.add((id(parent), i) if isinstance(c, str) else id(c))
    blocks: list[list[str]] = []
    _blocks(root, blocks, taken)
    return _lines(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main ``text`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id bigint, url string, text string")
