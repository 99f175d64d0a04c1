"""Main text of web pages by composite text density: link-adjusted characters per
tag for every node of the document tree, summed over children; the subtree with
the largest sum is taken, widened along its body path, and with it every subtree of
the body that is as dense as the sparsest node of that path."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesonlab.llm.common import table

# Elements and names of the HTML standard and of common page furniture.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template"}
BLOCK = set("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header
 hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption""".split())
DROPPED = RAW | set("head nav footer aside form button select option input svg canvas object audio video dialog menu iframe template".split())
#: Start tags that close an open paragraph, and elements an implied end tag doesn't cross.
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SCOPE = set("html body article section main div td th table li ul ol dd dl blockquote aside nav header footer form button figure".split())
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Names of page furniture; a class or id made of these alone, or of these and the neutral
# words after them, is furniture. In any other name they make the element lighter.
FURNITURE = set("""ad ads advert adverts advertisement banner sponsor sponsored promo sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead footer
 cookie cookies consent gdpr privacy notice popup modal newsletter subscribe subscription signup share sharing social related recommended widget toolbar pagination pager copyright legal
 hidden disclaimer paywall""".split())
NEUTRAL = set("""site page global main top bottom left right side box bar block wrapper wrap container list links link area section slot unit inner outer content group item items row
 col panel button buttons icon icons primary secondary posts articles stories overlay message text""".split())
#: Names of readers' comments: alone, or before or after one other word.
COMMENTS = set("comment comments commentlist discussion disqus reply replies respond responses feedback".split())
LIGHTER = 0.4
#: A marked part beside the article needs this share of its characters.
TEASER = 0.2
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "alert", "alertdialog", "dialog", "toolbar"}

_TAG = re.compile(r"""<!--|<!\[CDATA\[|<[!?]|</?([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|</?([a-zA-Z][^\s/>]*)([^>]*)>""")
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


class Node:
    __slots__ = ("tag", "parent", "parts", "dropped", "main", "chars", "tags", "link_chars", "link_tags", "density", "total", "light", "at", "end")

    def __init__(self, tag, parent, dropped=False, main=False, light=False):
        self.tag, self.parent, self.dropped, self.main, self.light = tag, parent, dropped, main, light
        self.parts: list = []  # strings and nodes in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.at = self.end = 0  # place in page order, and that of the first node after its subtree


def _named(names: str) -> tuple[bool, bool]:
    """(furniture, named like it in part) by the words of a class or id."""
    part = False
    for name in names.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if not words:
            continue
        found = [w in FURNITURE for w in words]
        if any(w in COMMENTS for w in words) and len(words) <= 3:
            return True, True
        if any(found) and all(f or w in NEUTRAL for w, f in zip(words, found)):
            return True, True
        part = part or any(found)
    return False, part


def _furniture(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool, bool]:
    """(page furniture, marked as main content, lighter) by the element's tag and attributes."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return True, False, False
    mark = tag in ("article", "main")
    if not attrs.strip() or tag in ("body", "html"):
        return False, mark, False
    found = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
    role = found.get("role", "").lower()
    prop = found.get("itemprop", "").lower()
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return True, False, False
    if role == "main" or "articlebody" in prop:
        return False, True, False
    named, part = _named(found.get("class", "") + " " + found.get("id", ""))
    if role in ROLES or role == "comment" or "comment" in prop or found.get("itemtype", "").lower().endswith("/comment"):
        return True, False, False
    if named and (not mark or any(w in COMMENTS for w in re.findall("[a-z]+", (found.get("class", "") + " " + found.get("id", "")).lower()))):
        return True, False, False
    return False, mark, part or named


def parse(page: str) -> Node:
    """The tree of a page as browsers would build it, near enough for text:
    implied end tags, unclosed elements, raw-text elements, comments."""
    root = node = Node("#root", None)
    at = articles = 0
    opened: dict[str, int] = {}  # elements of each tag among the open ones

    def shut() -> Node:
        nonlocal articles
        articles -= node.main
        opened[node.tag] -= 1
        return node.parent
    while at < len(page):
        m = _TAG.search(page, at)
        if not m:
            node.parts.append(page[at:])
            break
        if m.start() > at:
            node.parts.append(page[at:m.start()])
        token = m.group()
        tag = (m.group(1) or m.group(3) or "").lower()
        if not tag:
            stop = {"<!--": "-->", "<![CDATA[": "]]>"}.get(token, ">")
            end = page.find(stop, m.end())
            at = len(page) if end < 0 else end + len(stop)
            continue
        at = m.end()
        if token[1] == "/":
            seek = node if opened.get(tag) else root
            while seek is not root and seek.tag != tag:
                if tag not in BLOCK and seek.tag in SCOPE:  # a stray inline end tag ends nothing
                    seek = root
                    break
                seek = seek.parent
            if seek is not root:
                while node is not seek:
                    node = shut()
                node = shut()
            continue
        if tag in CLOSES_P or tag in IMPLIED:
            ends = IMPLIED.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
            seek, last = node if any(opened.get(e) for e in ends) else root, None
            while seek is not root:
                if seek.tag in ends:
                    last = seek
                elif seek.tag in SCOPE and not (seek.tag in ("td", "th") and tag == "tr"):
                    break
                seek = seek.parent
            if last is not None:
                while node is not last:
                    node = shut()
                node = shut()
        attrs = m.group(2) or m.group(4) or ""
        dropped, main, light = _furniture(tag, attrs, articles > 0)
        child = Node(tag, node, dropped, main, light)
        node.parts.append(child)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            if end is None:
                break
            close = page.find(">", end.start())
            at = len(page) if close < 0 else close + 1
        elif tag not in VOID and not attrs.endswith("/"):
            node = child
            articles += main
            opened[tag] = opened.get(tag, 0) + 1
    return root


def _measure(root: Node) -> list[Node]:
    """Counts of kept nodes in page order, then composite density and sums, bottom up."""
    order, stack = [], [(root, False)]
    while stack:
        node, in_link = stack.pop()
        order.append(node)
        in_link = in_link or node.tag == "a"
        chars = sum(len("".join(x.split())) for x in node.parts if isinstance(x, str))
        node.chars = chars
        node.link_chars = chars if in_link else 0
        for x in reversed(node.parts):
            if isinstance(x, Node) and not x.dropped:
                stack.append((x, in_link))
    for k, node in enumerate(order):
        node.at = node.end = k
    for node in reversed(order):
        node.end = max(node.end, node.at + 1)
        if node.parent is not None and node is not root:
            node.parent.end = max(node.parent.end, node.end)
        for x in node.parts:
            if isinstance(x, Node) and not x.dropped:
                node.chars += x.chars
                node.link_chars += x.link_chars
                node.tags += x.tags + 1
                node.link_tags += x.link_tags + (x.tag == "a")
    body = max(root.chars, 1)
    ratio = root.link_chars / body
    for node in order:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(c * lc / max(c - node.link_chars, 1) + ratio * c + math.e)
        node.density = c / t * math.log(max(c * t / (lc * lt), 1.0) + 1e-9) / math.log(max(base, 1.0 + 1e-9)) if c else 0.0
        node.density *= LIGHTER if node.light else 1.0
    for node in reversed(order):
        if node.parent is not None and node is not root:
            node.parent.total += node.density
    return order


def _chosen(order: list[Node]) -> list[Node]:
    """In page order, the node whose children's densities sum highest, widened to its
    last ancestor below the body that isn't mostly links, and the outermost other blocks
    at least as dense as the sparsest node on its path, the body included. If the page
    marks its main content, the choice is moved to the mark around it or in it, and the
    others are the other marks."""
    best = max(order, key=lambda n: (n.total, -n.tags))
    path = []
    node = best
    while node is not None and node.tag not in ("body", "html", "#root"):
        path.append(node)
        node = node.parent
    threshold = min((n.density for n in [*path, *([node] if node is not None else [])]), default=0.0)
    for above in path:
        if above.chars > best.chars and above.link_chars <= 0.5 * above.chars:
            best = above
    body, marked = node, None
    node = best
    while node is not None:
        marked = node if node.main else marked
        node = node.parent
    if marked is None and any(n.main and n.chars for n in order):
        inside = [n for n in order if n.main and n.chars and _within(n, best)]
        marked = max(inside, key=lambda n: n.chars, default=None)
        if marked is not None and best.tag not in ("body", "html", "#root") and 2 * marked.chars < best.chars:
            marked = None  # the mark is a small part of a dense subtree: a teaser
    if marked is None and best.tag in ("body", "html", "#root"):
        return [best]
    own, out, covered = marked or best, [], set()
    least = TEASER * own.chars if marked is not None else 0  # a small mark beside the article is a teaser
    for node in order:  # parents come before their children
        if node.parent in covered:
            covered.add(node)
        elif node is own or (node.chars > least and node.density >= threshold and node.link_chars <= 0.5 * node.chars
                             and (node.main if marked is not None else node.tag in BLOCK and node is not body and _within(node, body)) and not _within(own, node)):
            covered.add(node)
            out.append(node)
    return out


def _within(node: Node, top: Node) -> bool:
    return top.at <= node.at < top.end


def _blocks(node: Node) -> Iterator[str]:
    """Texts of the blocks below a node, in page order."""
    out: list[str] = []
    stack: list = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif x is None:
            if text := " ".join(unescape("".join(out)).split()):
                yield text
            out = []
        elif x.tag == "br":
            out.append(" ")
        elif not x.dropped:
            inner = list(reversed(x.parts))
            stack.extend([None, *inner, None] if x.tag in BLOCK or x is node else inner)


def main_text(page: str | None) -> str:
    """Blocks of the main text joined by line breaks; empty if there are none."""
    if not page:
        return ""
    order = _measure(parse(page))
    return "\n".join(text for node in _chosen(order) for text in _blocks(node))


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page (empty for a null, empty or
    text-less page). One narrow pass; a column named ``out_col`` is replaced."""
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(main_text, na_action=None)
    keep = [F.col(f"`{c}`") for c in pages.columns if c != out_col]
    return pages.select(*keep, F.pandas_udf(texts, "string")(F.col(f"`{html_col}`")).alias(out_col))


def op9_html(spark, sf_dir: str) -> DataFrame:
    """Main text of every page of ``pages``."""
    out = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
