"""Main text of HTML pages by composite text density.

A page becomes a tree of elements. Elements that are never article text by their tag, role or class
(menus, page headers and footers, side columns, notices, adverts, forms, scripts, comments of
readers) are cut off, but for headings, forms and wrappers that hold most of the page's text, and parts
of an article that are named by their topic and aren't mostly links. For every node that is left, with C characters, T tags below it, LC characters
and LT tags of links, the density is

    C / T * log( C/LC * T/LT ) / log( ln( C/(C-LC) * LC + LCb/Cb * C + e ) )

with the body's LCb and Cb, zero counts as 1 and the last divisor at least 1. A node's density sum
adds up its children's densities. The node of the largest sum is the core, and the smallest density
on the path from the body to it is the threshold. The core is widened to its enclosing article (else
the nearest block container) and the articles beside it that reach the threshold; without one, blocks beside its path that reach the threshold and aren't mostly
links are text as well, as is a page title ``h1`` beside it.

Character references are decoded, white space inside a block (``br`` included) is one blank, blocks
are trimmed, and those that are not empty are joined by one line end in page order.

Defined results: a null or empty page, or one without article text, gives the empty text and 0
characters. Markup that is broken or cut off is read as far as it goes: an unclosed comment or script
runs to the end, open elements end there. Repeated rows each get a row; extra columns are left out.
Time and memory are linear in a page's length, and deep nesting needs no recursion.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, small_batches

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*+>?|</[^a-zA-Z][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAMES = re.compile(r"[a-z]+|[A-Z][a-z]*")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
HEAD = frozenset("title meta link script style base noscript template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are no article text wherever they are.
CUT = frozenset("head script style noscript template iframe object svg math canvas audio video map nav footer aside menu dialog button select textarea title input label option datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words in class or id that mark what is no article text.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion sidebar widget widgets"
    " comment comments commentlist disqus respond reply replies discussion cookie cookies consent gdpr notice notices popup modal overlay"
    " newsletter subscribe subscription signup login signin register share sharing social related recommend recommended recommendations"
    " breadcrumb breadcrumbs nav navbar navigation navigator menu menus menubar submenu footer masthead topbar toolbar pagination pager"
    " skip legal copyright hidden toc outbrain taboola paywall search searchbox".split()
)
#: Of these, the ones that cut even an ``article`` element off.
OTHER_VOICES = frozenset("comment comments commentlist disqus respond reply replies discussion ad ads advert advertisement sponsored promo related recommended".split())
#: Of these, the ones that also name what an article is about: there they cut only what is mostly links.
TOPICS = frozenset("discussion related recommend recommended recommendations legal copyright notice notices navigation search share sharing social register promotion sponsor".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: The mark of what an attribute hides or gives a role, which no name is.
HIDDEN = "!hidden"
CONTAINERS = frozenset("article main section div body td center blockquote form fieldset details root".split())
#: A start tag ends an open element of the second set, up to one of the third.
_CLOSES = {
    **dict.fromkeys(("li",), (("li",), ("ul", "ol", "menu", "dir"))),
    **dict.fromkeys(("dd", "dt"), (("dd", "dt"), ("dl",))),
    **dict.fromkeys(("td", "th"), (("td", "th"), ("tr", "table"))),
    "tr": (("tr",), ("table",)),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (("tbody", "thead", "tfoot"), ("table",))),
    "option": (("option",), ("select",)),
    "a": (("a",), ("td", "th", "table")),
}
_P_SCOPE = ("td", "th", "table", "caption", "button", "object", "body")


class Node:
    __slots__ = ("tag", "parent", "parts", "cut", "marks", "chars", "tags", "link_chars", "link_tags", "density", "sum", "holds")

    def __init__(self, tag: str, parent: "Node | None"):
        self.tag, self.parent, self.parts = tag, parent, []
        self.cut = tag in CUT
        self.marks: set[str] = set()
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        self.holds = False  # an article or main element


def _marks(attributes: str) -> set[str]:
    """Words of class and id; roles and hiding as HIDDEN."""
    found: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            found.update(x.lower() for x in _NAMES.findall(value))
        elif name == "role" and value.lower() in ROLES or name == "aria-hidden" and value.lower() == "true":
            found.add(HIDDEN)
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            found.add(HIDDEN)
    if re.search(r"(?:^|\s)hidden(?:\s|/|$)", attributes):
        found.add(HIDDEN)
    return found


def tree(page: str) -> list[Node]:
    """All nodes in the order of their start tags; the first is the root."""
    root = Node("root", None)
    nodes, stack, open_count = [root], [root], {}

    def pop_to(i: int) -> None:
        for n in stack[i:]:
            open_count[n.tag] -= 1
        del stack[i:]

    def close(tags: tuple, scope: tuple) -> None:
        """Ends the innermost open element of ``tags`` unless one of ``scope`` is nearer."""
        if any(open_count.get(t) for t in tags):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in tags:
                    return pop_to(i)
                if stack[i].tag in scope:
                    return None
        return None

    def text(s: str) -> None:
        if s:
            if stack[-1].tag == "head" and not s.isspace():
                pop_to(len(stack) - 1)
            stack[-1].parts.append(html.unescape(s) if "&" in s else s)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m[3] is None:
            text(m[1] or "")
            continue
        tag, attributes = m[3].lower(), m[4]
        if at < end and page[at] != ">":  # a quote that never ends
            at = page.find(">", at)
            at = end if at < 0 else at
        at += 1
        if m[2]:
            if open_count.get(tag):
                inline = tag not in BLOCKS
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        pop_to(i)
                        break
                    if inline and stack[i].tag in BLOCKS:
                        break
            elif tag == "p" or tag == "br":
                stack[-1].parts.append(Node("br", stack[-1]) if tag == "br" else Node("p", stack[-1]))
                nodes.append(stack[-1].parts[-1])
            continue
        if tag == "html" or tag == "body" and open_count.get("body"):
            continue
        if stack[-1].tag == "head" and tag not in HEAD or tag == "body" and open_count.get("head"):
            close(("head",), ())
        if tag in BLOCKS:
            close(("p",), _P_SCOPE)
            if stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6") and tag[0] == "h" and tag[1:].isdigit():
                pop_to(len(stack) - 1)
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        node = Node(tag, stack[-1])
        if "=" in attributes or "hidden" in attributes:
            node.marks = _marks(attributes)
        stack[-1].parts.append(node)
        nodes.append(node)
        if tag in RAW:
            m = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end if m is None else m.end()
        elif tag not in VOID:
            stack.append(node)
            open_count[tag] = open_count.get(tag, 0) + 1
    return nodes


def _plain_chars(nodes: list[Node]) -> tuple[dict[int, int], dict[int, int], int]:
    """Characters outside and inside of links below each node, and the page's outside of links, without what is cut by tag or hidden."""
    out, plain, links, linked = set(), {}, {}, set()
    for n in nodes:
        up = id(n.parent)
        if n.cut or HIDDEN in n.marks and not n.holds or up in out:
            out.add(id(n))
        if n.tag == "a" or up in linked:
            linked.add(id(n))
        own = 0 if id(n) in out else sum(len("".join(p.split())) for p in n.parts if isinstance(p, str))
        plain[id(n)], links[id(n)] = (0, own) if id(n) in linked else (own, 0)
    for n in reversed(nodes):
        if n.parent is not None:
            plain[id(n.parent)] += plain[id(n)]
            links[id(n.parent)] += links[id(n)]
    return plain, links, plain[id(nodes[0])]


def _cut_off(nodes: list[Node]) -> None:
    """Marks the elements that are no article text."""
    for n in reversed(nodes):
        if n.parent is not None and (n.holds or n.tag in ("article", "main") and not n.marks & OTHER_VOICES):
            n.parent.holds = True
    plain, links, total = _plain_chars(nodes)
    inside: dict[int, bool] = {}
    for n in nodes:
        up = n.parent
        inside[id(n)] = up is not None and (inside[id(up)] or up.tag in ("article", "main"))
        if up is not None and up.cut:
            n.cut = True
        elif n.tag in ("root", "body", "main"):
            n.cut = False
        elif n.tag == "article":
            n.cut = bool(n.marks & OTHER_VOICES)
        elif HIDDEN in n.marks:
            n.cut = n.cut or not n.holds
        elif n.tag == "form" or n.marks & MARKS and n.tag not in HEADINGS:
            own, named = plain[id(n)], n.marks & MARKS
            if named & OTHER_VOICES - TOPICS:
                kept = own == total > 0  # nothing else is left
            else:  # a wrapper, or a part of an article that is named by its topic
                kept = 2 * own >= total > 0 or inside[id(n)] and n.tag != "form" and named <= TOPICS and links[id(n)] < own
            n.cut = n.cut or not n.holds and not kept
        elif n.tag == "header" or "header" in n.marks and n.tag not in ("h1", "h2", "h3"):
            n.cut = not inside[id(n)] and not n.holds


def _measure(nodes: list[Node], body: Node) -> None:
    """Densities and density sums of the nodes that are left."""
    for n in nodes:
        if not n.cut:
            n.chars += sum(len("".join(p.split())) for p in n.parts if isinstance(p, str))
    for n in reversed(nodes):
        if n.cut:
            continue
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.link_tags + 1
        if (up := n.parent) is not None:
            up.chars += n.chars
            up.tags += n.tags + 1
            up.link_chars += n.link_chars
            up.link_tags += n.link_tags
    share = body.link_chars / max(body.chars, 1)
    for n in nodes:
        if n.cut or not n.chars:
            continue
        c, t = n.chars, max(n.tags, 1)
        base = math.log(math.log(c / max(c - n.link_chars, 1) * n.link_chars + share * c + math.e))
        n.density = max(0.0, c / t * math.log(c / max(n.link_chars, 1) * t / max(n.link_tags, 1))) / max(base, 1.0)
        if n.parent is not None:
            n.parent.sum += n.density


def _core(nodes: list[Node], body: Node) -> tuple[Node, float]:
    """The node of the largest density sum below the body, and the threshold."""
    within = {id(body)}
    best = body
    for n in nodes:
        if n.parent is not None and id(n.parent) in within and not n.cut:
            within.add(id(n))
            if n.sum > best.sum or best is body and n.sum >= best.sum > 0:
                best = n
    threshold, n = math.inf, best
    while True:
        threshold = min(threshold, n.density)
        if n is body:
            return best, threshold
        n = n.parent


def _chosen(nodes: list[Node], body: Node) -> set[int]:
    """The ids of the roots of the subtrees that are article text."""
    core, threshold = _core(nodes, body)
    while core is not body and core.tag not in CONTAINERS:
        core = core.parent
    n, article = core, None
    while n is not None and n is not body:
        if n.tag == "article" or n.tag == "main" and article is None:
            article = n
        n = n.parent
    if article is not None:
        found, n = {id(article)}, article
        while n is not body:
            for beside in n.parent.parts:
                if isinstance(beside, Node) and beside.tag == "article" and not beside.cut and beside.chars:
                    if beside.density >= threshold and 2 * beside.link_chars < beside.chars:
                        found.add(id(beside))
            n = n.parent
        return found
    found, n = {id(core)}, core
    titled = False
    while n is not body:
        for beside in n.parent.parts:
            if isinstance(beside, Node) and beside is not n and not beside.cut and beside.chars:
                title = beside.tag == "h1" and not titled
                if title or beside.density >= threshold and 2 * beside.link_chars < beside.chars:
                    titled = titled or title
                    found.add(id(beside))
        n = n.parent
    return found


def main_text(page: str | None) -> str:
    """The article's text of a page."""
    if not page:
        return ""
    nodes = tree(page)
    _cut_off(nodes)
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    if body is not nodes[0] and any(n.parent is nodes[0] and not n.cut and n is not body and n.tag != "head" for n in nodes):
        body = nodes[0]  # text outside of the body
    _measure(nodes, body)
    if not body.chars:
        return ""
    chosen = _chosen(nodes, body)
    blocks, words = [], []

    def end_block() -> None:
        if line := " ".join("".join(words).split()):
            blocks.append(line)
        words.clear()

    walk: list[tuple] = [(body, False, False)]
    while walk:
        part, taken, done = walk.pop()
        if isinstance(part, str):
            if taken:
                words.append(part)
        elif done:
            end_block()
        elif not part.cut:
            taken = taken or id(part) in chosen
            if part.tag == "br":
                words.append(" ")
                continue
            if part.tag in BLOCKS or part is body:
                end_block()
                walk.append((part, taken, True))
            walk.extend((p, taken, False) for p in reversed(part.parts))
    end_block()
    return "\n".join(blocks)


SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def task(batches):
        for b in small_batches(batches):
            texts = [main_text(p) for p in b.column(2).to_pylist()]
            yield batch(SCHEMA, [b.column(0), b.column(1), texts, [len(t) for t in texts]])

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return rows.mapInArrow(task, "page_id long, url string, text string, n_chars long")
