"""Main text of web pages by composite text density.

Every node of the page's tree gets its characters per tag, discounted by the share of characters
and tags that stand in links; a node's density sum adds the densities of its children.  The
subtree of the largest sum is the article; the least density on the path from it to the body is
the threshold that other subtrees must reach to belong to it.

Scale: one map over the pages; a page is parsed in one pass with a single regular expression.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Subtrees that are never part of an article.
DROPPED = frozenset("nav footer aside form button select input label dialog menu svg math canvas audio video object embed map head fieldset".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar status".split())
#: Words of class and id that mark what surrounds an article.
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar sidebars footer foot masthead topbar toolbar ad ads adv advert adverts advertisement "
    "advertisements advertising sponsor sponsored sponsors promo promos promoted promotion banner banners cookie cookies consent gdpr notice notices alert alerts "
    "popup modal overlay newsletter subscribe subscription signup login signin register paywall comment comments commentlist discussion disqus respond replies reply "
    "reactions share sharing social related recommended recommendations recirculation trending widget widgets pagination pager skip search copyright legal disclaimer "
    "hidden aside adslot adbox adsense teaser outbrain taboola rail".split()
)
#: Parts of a name that say how a node looks or where it stands; the main part is the last of the others.
GENERIC_PARTS = frozenset(
    "left right top bottom center middle upper lower primary secondary main container wrapper wrap box block area section panel region zone inner outer "
    "slot unit bar list link links item items button buttons icon icons form group column col row posts articles stories desktop mobile".split()
)
#: Parts that make a name a statement about a layout.
STATE_PARTS = frozenset("has no not with without".split())
#: Elements that a generated id inside an article names for links; it says nothing about them.
ID_MARKS = frozenset("div ul ol dl".split())
#: Elements that may stand in a head.
HEAD_ELEMENTS = frozenset("base basefont bgsound link meta title noscript noframes style script template head html body".split())
#: Elements that an opening tag closes if they are open below the nearest listed boundary.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
    "tbody": (("tr", "td", "th", "thead", "tbody"), ("table",)),
    "tfoot": (("tr", "td", "th", "thead", "tbody"), ("table",)),
}
INLINE_CLOSED_BY_BLOCK = "p"
P_BOUNDARY = frozenset("body article section div td th li table blockquote main aside nav header footer form figure details dd dt button html".split())

TOKEN = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
PART = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("tag", "parent", "children", "items", "dropped", "marked", "link", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, marked: bool = False) -> None:
        self.tag, self.parent, self.dropped, self.marked = tag, parent, dropped, marked
        self.children: list[Node] = []
        self.items: list[Node | str] = []  # children and pieces of text in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _hidden(tag: str, attributes: str) -> bool:
    """Whether role or state of a node say that its subtree is not part of an article."""
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "role":
            if value.strip() in DROPPED_ROLES:
                return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _surrounds(name: str) -> bool:
    """Whether a word that marks surroundings is all of a class or id, or its main part."""
    parts = [x.rstrip("0123456789") for x in PART.findall(name.split("--")[0]) if not x[0].isdigit()]
    if STATE_PARTS.intersection(parts):
        return False
    while len(parts) > 1 and parts[-1] in GENERIC_PARTS:
        parts.pop()
    return bool(parts) and parts[-1] in DROPPED_WORDS


def _marked(tag: str, attributes: str, above: Node) -> bool:
    """Whether class or id mark a subtree as surroundings of an article; ``settle`` decides what becomes of it."""
    if not attributes or tag in HEADINGS or tag in ("body", "html", "article", "main"):
        return False
    values = {}
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), (a or b or c).lower().split())
    classes, ids = values.get("class", []), values.get("id", [])
    if not classes and not ids:
        return False
    while above is not None and above.tag not in ("article", "main"):
        above = above.parent
    if above is not None and (tag not in ID_MARKS or "section" in classes):
        ids = []
    return any(map(_surrounds, classes)) or any(map(_surrounds, ids))


def parse(page: str) -> Node:
    """The tree of a page; broken markup is closed as browsers close it where that matters for text."""
    root = Node("html", None, False)
    stack = [root]
    before_body = True

    def pop_to(names: tuple[str, ...] | frozenset[str], boundary) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in boundary:
                return

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        end = size if m is None else m.start()
        if end > at:
            if before_body and not page[at:end].isspace():
                before_body = False  # a head ends where it is left open and text follows
                del stack[1:]
            stack[-1].items.append(page[at:end])
        if m is None:
            break
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag == "br":
                stack[-1].items.append(" ")
            elif tag not in ("html", "body"):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        del stack[i:]
                        break
                    if stack[i].tag in ("article", "main", "body", "nav", "table", "div", "section", "aside", "footer", "header") and tag not in BLOCK:
                        break
            continue
        if before_body and (tag == "body" or tag not in HEAD_ELEMENTS):
            before_body = False  # or an element that may not stand in it
            del stack[1:]
        if tag in ("html", "body") or (tag == "head" and not before_body):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in BLOCK:
            pop_to(("p",), P_BOUNDARY)
            if tag in HEADINGS and stack[-1].tag in HEADINGS:
                stack.pop()
        if tag in CLOSES:
            names, boundary = CLOSES[tag]
            while any(s.tag in names for s in stack[1:]):
                n = len(stack)
                pop_to(names, boundary)
                if len(stack) == n:
                    break
        if tag == "a":
            pop_to(("a",), BLOCK)
        above = stack[-1]
        dropped = above.dropped or tag in DROPPED or _hidden(tag, attributes)
        node = Node(tag, above, dropped, not dropped and _marked(tag, attributes, above))
        above.children.append(node)
        above.items.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
        elif tag not in VOID and tag not in ("svg", "math", "path"):
            stack.append(node)  # a slash does not close an element of HTML
    return root


def _in_order(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(reversed(n.children))
    return out


def _site_header(node: Node) -> bool:
    """A header is the site's unless it stands in an article and holds its heading."""
    above = node.parent
    while above is not None and above.tag not in ("article", "main"):
        above = above.parent
    return above is None or not any(n.tag in HEADINGS for n in _in_order(node))


def _length(items: list[Node | str]) -> int:
    return sum([len("".join(x.split())) for x in items if type(x) is str])


def settle(nodes: list[Node]) -> None:
    """Drops the marked subtrees, but for paragraphs (``content`` begins no article with them) and what holds the article.

    A subtree holds it if an article or main element stands in it, unless such elements outside the marked
    subtrees hold a quarter of its characters or more (comments may be articles too), or if most of the page's
    characters outside links do, unless such elements outside hold any text.
    """
    if not any(n.marked for n in nodes):
        return
    plain, articles, inside, free = {}, {}, {}, 0
    for n in nodes:
        above = inside.get(n.parent, (False, False, False))
        article = above[0] or n.tag in ("article", "main")
        inside[n] = (article, above[1] or (n.marked and n.tag != "p"), above[2] or n.tag in HEADINGS)
        plain[n] = 0 if n.dropped or n.link else _length(n.items)
        articles[n] = not n.dropped and n.tag in ("article", "main")
        if inside[n] == (True, False, False):
            free += plain[n]
    for n in reversed(nodes):
        if n.parent is not None and not n.dropped:
            plain[n.parent] += plain[n]
            articles[n.parent] = articles[n.parent] or articles[n]
    for n in nodes:
        if n.parent is not None and n.parent.dropped:
            n.dropped = True
        elif n.marked and n.tag != "p" and not n.dropped:
            n.dropped = free * 4 >= plain[n] if articles[n] else free > 0 or plain[n] * 2 <= plain[nodes[0]]
            n.marked = n.dropped


def measure(root: Node) -> list[Node]:
    """Counts, densities and density sums of every node, children before parents in the sums; nodes in page order."""
    nodes = _in_order(root)
    for n in nodes:
        n.dropped = n.dropped or (n.parent is not None and n.parent.dropped) or (n.tag == "header" and _site_header(n))
        n.link = n.tag == "a" or (n.parent is not None and n.parent.link)
    settle(nodes)
    for n in reversed(nodes):
        if n.dropped:
            continue
        own = _length(n.items)
        n.chars += own
        if n.link:
            n.link_chars += own
        if n.parent is not None:
            p = n.parent
            p.chars += n.chars
            p.tags += n.tags + 1
            p.link_chars += n.link_chars
            p.link_tags += n.link_tags + (n.tag == "a")
    body = root
    lc_body, c_body = max(body.link_chars, 1), max(body.chars, 1)
    for n in nodes:
        if n.dropped or not n.chars:
            continue
        chars, tags, lc, lt = n.chars, max(n.tags, 1), n.link_chars, max(n.link_tags, 1)
        base = math.log(chars * lc / max(chars - lc, 1) + chars * lc_body / c_body + math.e)
        adjusted = (chars / max(lc, 1)) * (tags / lt)
        n.density = chars / tags * (math.log(adjusted) / math.log(base) if adjusted > 1 and base > 1 else 0.0)
        if n.parent is not None:
            n.parent.total += n.density
    return nodes


def _within(node: Node, other: Node) -> bool:
    while node is not None:
        if node is other:
            return True
        node = node.parent
    return False


def content(root: Node) -> list[Node]:
    """The subtrees, in page order, whose text is the article."""
    nodes = [n for n in measure(root) if not n.dropped and n.chars]
    if not nodes:
        return []
    best = max([n for n in nodes if not n.marked] or nodes, key=lambda n: (n.total if any(not c.dropped for c in n.children) else n.density, n.chars))
    threshold, up, container = best.density, best, None
    while up is not None:
        if up.parent is not None or up is best:
            threshold = min(threshold, up.density)
        if up.tag in ("article", "main"):
            container = up if container is None or container.tag == "article" and up.tag == "article" else container
        up = up.parent
    start = container or best
    main = start
    while main is not None and main.tag != "main":
        main = main.parent
    # beside an article that no main element holds, only articles count, and a title if it has none
    alone = container is not None and main is None
    untitled = not any(n.tag == "h1" and not n.dropped for n in _in_order(start))
    chosen, at = [start], start
    while at.parent is not None and at is not main:
        at = at.parent
        for c in at.children:
            if c.dropped or c.marked or not c.chars or any(_within(x, c) for x in chosen):
                continue
            if c.tag == "h1":
                if untitled or not alone:
                    chosen.append(c)
            elif c.density >= threshold and c.link_chars * 2 < c.chars and c.tag != "a" and (c.tag == "article" or not alone):
                chosen.append(c)
            elif main is not None and c.tag in ("header", "hgroup"):
                chosen += [n for n in _in_order(c) if n.tag == "h1" and not n.dropped and n.chars]
        own = "".join(x for x in at.items if type(x) is str)
        if len(own.strip()) > 0 and at.density >= threshold and at is not root and not alone:
            chosen = [at]  # text of its own beside the chosen subtrees
            if container is None:
                return chosen
    order = {id(n): i for i, n in enumerate(nodes)}
    return sorted(chosen, key=lambda n: order[id(n)])


def text_of(nodes: list[Node]) -> str:
    """Blocks of the subtrees in page order, one a line, white space inside a block made one space."""
    blocks: list[list[str]] = [[]]
    for top in nodes:
        blocks.append([])
        todo: list[Node | str | None] = [top]
        while todo:
            x = todo.pop()
            if x is None:
                blocks.append([])
            elif type(x) is str:
                blocks[-1].append(entities.unescape(x) if "&" in x else x)
            elif not x.dropped:
                if x.tag == "br":
                    blocks[-1].append(" ")
                if x.tag in BLOCK:
                    blocks.append([])
                    todo.append(None)
                todo.extend(reversed(x.items))
            elif x.tag in BLOCK:
                blocks.append([])
        blocks.append([])
    lines = (" ".join("".join(b).split()) for b in blocks if b)
    return "\n".join(x for x in lines if x)


def main_text(page: str | None) -> str:
    return text_of(content(parse(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    A null or empty page, and one without text outside menus and the like, gives an empty text.
    Repeated rows give repeated rows; other columns are ignored; an empty table gives an empty result.
    """
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column("html").to_pylist()]
            yield pa.record_batch([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", F.col("html")).mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
