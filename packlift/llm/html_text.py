"""HTML extraction by tree scoring.

The page is read into a tree (unclosed and misnested tags are closed as
browsers do for the common cases). Subtrees that are never main text are set
aside: by element (navigation, footers, asides, forms, scripts, styles and the
like), by their role, or as hidden. The words of a class or id (adverts, menus,
notices, comments, sidebars) count against a subtree's points, and set it aside only if
it has no good word, holds no article or main, and holds less than ``ASIDE_SHARE`` of
the page's unlinked paragraph text.

Every paragraph then earns points for itself, its commas and its length, and
passes them to its nearest ``ANCESTORS`` ancestors: all to its parent, half to
the next, a third and so on beyond. A container's points are weighted by its element and hint words and
discounted by the share of its text inside links. The best container is kept, with
those siblings that have a fifth of its points, are long paragraphs with few
links, or are headings before it. Of what is kept every block of text counts.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by an empty line in page order.

Defined cases: a null or empty page, or one without text, gives the empty text;
a page without paragraphs falls back to all text that was not set aside;
repeated rows are each extracted; an empty table gives an empty result; other
columns are ignored. Reading is linear in the page's length.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.llm.common import rows_udf, text_of

# ---- fixed values: element names and hint words ---------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table
tbody td tfoot th thead tr ul""".split())
ASIDE = frozenset("""nav footer aside form button select option input script style noscript iframe template svg math
object embed menu dialog head title textarea canvas audio video map datalist""".split())
PARAGRAPH = frozenset("p pre blockquote td li dd h1 h2 h3 h4 h5 h6".split())
HEADING = frozenset("h1 h2 h3".split())
BAD_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie
cookies consent notice notices popup modal overlay newsletter subscribe subscription signup login comment comments
disqus respond reply replies discussion sidebar aside widget nav navbar navigation menu breadcrumb breadcrumbs
pagination pager footer masthead topbar toolbar share sharing social related recommended recommendations
outbrain taboola skip hidden alert""".split())
GOOD_WORDS = frozenset("article body content entry main page post story text blog hentry".split())
COMMENT_WORDS = frozenset("comment comments disqus respond reply replies discussion".split())
BAD_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert menu menubar toolbar form".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "option": {"select", "datalist"}, "tbody": {"table"}}
CONTAINERS = frozenset("article main section div body td table ul ol dl blockquote figure form header footer aside".split())
# ---------------------------------------------------------------------------------
ANCESTORS = 5
ASIDE_SHARE = 0.4     # a subtree with bad words is set aside if it holds less of the page's unlinked paragraph text

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"']|$)""", re.I)
_HINT = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "parent", "items", "hints", "bad", "good", "comments", "dropped", "points", "chars", "commas", "linked")

    def __init__(self, tag: str, parent: "Node | None"):
        self.tag, self.parent = tag, parent
        self.items: list = []          # child nodes and strings, in page order
        self.hints = 0                 # good words minus bad words
        self.bad = self.good = False   # class or id has such a word
        self.comments = False          # class or id has only words for comments
        self.dropped = False
        self.points = 0.0
        self.chars = 0                 # of text below
        self.commas = 0
        self.linked = 0                # of it, inside links


def _read_attributes(node: Node, text: str) -> None:
    in_article = node.tag in ("article", "main", "body", "html")
    for m in _ATTRIBUTE.finditer(text):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
        if name in ("class", "id"):
            words = _HINT.findall(value.lower())
            bad = sum(w in BAD_WORDS for w in words)
            node.hints += sum(w in GOOD_WORDS for w in words) - bad
            node.bad |= bool(bad) and not in_article
            node.comments |= bool(words) and COMMENT_WORDS.issuperset(words)
            node.good |= any(w in GOOD_WORDS for w in words)
        elif name == "role":
            node.dropped |= value.lower() in BAD_ROLES
        elif name == "style":
            node.dropped |= bool(_HIDDEN.search(value))
        elif name == "hidden":
            node.dropped = True
        elif name == "aria-hidden":
            node.dropped |= value.lower() == "true"


def read_tree(html: str) -> Node:
    root = Node("#root", None)
    node = root
    depth_of: dict[str, int] = {}      # open elements by name

    def pop() -> None:
        nonlocal node
        depth_of[node.tag] -= 1
        node = node.parent

    def close_to(names: set, stop: set) -> None:
        """Close the nearest open element of ``names``, unless one of ``stop`` lies nearer."""
        if not any(depth_of.get(n) for n in names):
            return
        up = node
        while up is not root and up.tag not in names:
            if up.tag in stop:
                return
            up = up.parent
        if up is not root:
            while node is not up:
                pop()
            pop()

    def add_text(text: str) -> None:
        if text:
            node.items.append(unescape(text))

    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            add_text(html[at:])
            break
        if html.startswith("<!--", lt):
            add_text(html[at:lt])
            end = html.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        follow = html[lt + 1:lt + 2]
        if follow in ("!", "?"):
            add_text(html[at:lt])
            end = html.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        if not (follow.isalpha() and follow.isascii()) and not (follow == "/" and html[lt + 2:lt + 3].isalpha()):
            add_text(html[at:lt + 1])      # a lone "<" is text
            at = lt + 1
            continue
        m = _TAG.match(html, lt)
        if m:
            closing, tag, rest, after = m[1], m[2].lower(), m[3], m.end()
        else:                              # a quote that never ends, or a tag cut off by the page's end
            end = html.find(">", lt)
            if end < 0:
                add_text(html[at:lt])
                break
            closing = "/" if follow == "/" else ""
            tag = re.match(r"[^\s/>]*", html[lt + 1 + len(closing):end])[0].lower()
            rest, after = "", end + 1
        add_text(html[at:lt])
        at = after
        if closing:
            if depth_of.get(tag):
                close_to({tag}, BLOCK - {tag} - {"p", "li", "dt", "dd", "td", "th", "tr"} if tag not in BLOCK else set())
            continue
        if tag in BLOCK and depth_of.get("p"):
            close_to({"p"}, CONTAINERS)
        if tag in CLOSED_BY:
            while True:
                before = node
                close_to(CLOSED_BY[tag], SCOPE[tag])
                if node is before:
                    break
        child = Node(tag, node)
        child.dropped = tag in ASIDE or (tag == "header" and not (depth_of.get("article") or depth_of.get("main")))
        if rest:
            _read_attributes(child, rest)
        node.items.append(child)
        if tag in VOID:
            continue
        if tag in RAW and not rest.endswith("/"):
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            if end is None:
                break
            close = html.find(">", end.end())
            at = n if close < 0 else close + 1
            continue
        if not (rest.endswith("/") and tag in ("svg", "path", "g")):
            depth_of[tag] = depth_of.get(tag, 0) + 1
            node = child
    return root


def _walk(root: Node):
    """Nodes that are not set aside, children after parents."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += [c for c in reversed(node.items) if isinstance(c, Node) and not c.dropped]


def set_aside(root: Node) -> None:
    """Set subtrees aside by their hint words: those with a bad word and no good
    one that hold no article or main and less than ``ASIDE_SHARE`` of the page's
    unlinked paragraph text; comments, which may outgrow their article, if they
    hold less than all of it. Others keep their words as a penalty."""
    order = list(_walk(root))
    linked, within = {id(root): False}, {id(root): False}
    for node in order:
        if node.parent is not None:
            linked[id(node)] = linked[id(node.parent)] or node.tag == "a"
            within[id(node)] = within[id(node.parent)] or node.tag in PARAGRAPH
    text: dict[int, int] = {}
    holds: set[int] = set()
    for node in reversed(order):
        own = 0
        if not linked[id(node)] and (within[id(node)] or node.tag in ("div", "section", "article", "main", "body")):
            own = sum(len(s.strip()) for s in node.items if isinstance(s, str))
        text[id(node)] = text.get(id(node), 0) + own
        if node.parent is not None:
            up = id(node.parent)
            text[up] = text.get(up, 0) + text[id(node)]
            if node.tag in ("article", "main") or id(node) in holds:
                holds.add(up)
    for node in order:
        share = 1 if node.comments else ASIDE_SHARE
        if node.bad and not node.good and id(node) not in holds and text[id(node)] < share * max(text[id(root)], 1):
            node.dropped = True


def score_tree(root: Node) -> list[Node]:
    """Pass the paragraphs' points up; the nodes that got any, in page order."""
    order = list(_walk(root))
    direct: dict[int, tuple[int, int]] = {}
    for node in reversed(order):
        strings = [s for s in node.items if isinstance(s, str) and s.strip()]
        own = sum(len(s.strip()) for s in strings), sum(s.count(",") for s in strings)
        if strings:
            direct[id(node)] = own
        node.chars += own[0]
        node.commas += own[1]
        if node.tag == "a":
            node.linked = node.chars
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.commas += node.commas
            node.parent.linked += node.linked
    scored: set[int] = set()
    for node in order:
        if node.tag in PARAGRAPH and node.chars:
            chars, commas, target = node.chars, node.commas, node.parent
        elif node.tag in ("div", "section", "article", "main", "body") and id(node) in direct:
            chars, commas = direct[id(node)]
            target = node
        else:
            continue
        points = (1 + commas + min(chars / 100, 3)) * (1 - node.linked / node.chars)
        for share in range(1, ANCESTORS + 1):
            if target is None or target.tag == "#root":
                break
            target.points += points / share
            scored.add(id(target))
            target = target.parent
    found = [n for n in order if id(n) in scored]
    for n in found:
        n.points += 25 * (n.tag in ("article", "main")) + 5 * max(min(n.hints, 2), -2)
        n.points *= 1 - n.linked / max(n.chars, 1)
    return found


def chosen_nodes(root: Node) -> list[Node]:
    set_aside(root)
    found = [n for n in score_tree(root) if n.tag in CONTAINERS]
    if not found:
        return [root]
    best = max(found, key=lambda n: n.points)
    if best.parent is None:
        return [best]
    out, before = [], True
    for item in best.parent.items:
        if item is best:
            out.append(best)
            before = False
        elif isinstance(item, Node) and not item.dropped and item.chars:
            density = item.linked / item.chars
            long_paragraph = item.tag == "p" and (item.chars > 80 and density < 0.25)
            if (item.points >= max(10.0, 0.2 * best.points) and density < 0.5) or long_paragraph \
                    or (before and item.tag in HEADING and density < 0.5):
                out.append(item)
    return out


def _blocks(node: Node) -> list[str]:
    """The text blocks under a node, in page order."""
    out: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        block = " ".join("".join(buffer).split())
        if block:
            out.append(block)
        buffer.clear()

    stack: list = [node]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            buffer.append(item)
        elif not item.dropped or item is node:
            if item.tag == "br":
                buffer.append(" ")
                continue
            if item.tag in BLOCK:
                flush()
                stack.append(None)
            stack += reversed(item.items)
    flush()
    return out


def main_text(html: str) -> str:
    return "\n\n".join(b for node in chosen_nodes(read_tree(html)) for b in _blocks(node))


def html_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``."""
    extract = rows_udf(lambda: lambda texts: [(t, len(t)) for t in map(main_text, texts)], "text string, n_chars long")
    return (pages.select("page_id", "url", extract(text_of("html")).alias("x"))
            .select("page_id", "url", "x.text", "x.n_chars"))
