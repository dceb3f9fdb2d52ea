"""Main text of web pages by tree scoring.

A forgiving reader builds the page's tree of containers and its blocks (runs of text between block
tags). Parts that are never article text are left out by tag, role and name. Every paragraph gives
points for its length and commas to its container, fewer to each further ancestor; a container's
points are discounted by its link density. The best container is kept, widened to the article or
main element around it, with those of its siblings that read like text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctweave.llm import common

# --- fixed values: names of HTML elements, roles, and common names of page parts ---
RAW = "script style noscript template textarea title iframe svg math xmp object canvas".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("head nav footer aside form button select menu dialog audio video label fieldset".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
LEAVES = HEADINGS | {"p", "pre", "li", "dt", "dd", "td", "th", "caption", "figcaption", "blockquote"}
ROLES = set(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar "
    "toolbar tablist".split()
)
NEVER = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs comment comments disqus respond reply replies "
    "cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login "
    "pagination pager toolbar masthead footer skip copyright".split()
)
RARELY = set(
    "header banner side notice notices notification alert promo promotion related recommended "
    "recommendations share sharing social widget widgets tags discussion feedback outbrain taboola "
    "topbar bottombar toc search form top bottom".split()
)
TEXTUAL = set("article content main body post entry story text page".split())
# --- end of fixed values ---

#: What stands in a tag behind its name. No step is ever taken back, and no tag reaches over the
#: beginning of the next, so that unclosed tags and quotes cost no more than their length.
_REST = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b" + _REST + r">.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>" + _REST + r")>"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Closed by the opening of another of its own kind, up to the element that holds them.
_ITEMS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


#: Elements that would lie deeper become siblings, so that a block has a bounded way to the root.
DEEPEST = 512


class _Node:
    __slots__ = ("tag", "parent", "skip", "points", "chars", "links", "children", "depth", "within")

    def __init__(self, tag: str, parent: _Node | None, skip: bool):
        self.tag, self.parent, self.skip = tag, parent, skip
        self.points = 0.0
        self.chars = self.links = 0
        self.children: list[_Node] = []
        self.depth = parent.depth + 1 if parent else 0
        self.within = bool(parent and (parent.within or parent.tag in ("article", "main")))
        if parent:
            parent.children.append(self)


def _skipped(tag: str, rest: str, parent: _Node) -> bool:
    if parent.skip or tag in SKIPPED or (
        tag == "header" and not (parent.within or parent.tag in ("article", "main"))
    ):
        return True
    if "=" not in rest and "hidden" not in rest:
        return False
    if tag in ("html", "body", "main"):
        return False
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(rest)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    if found.get("role", "").lower() in ROLES:
        return True
    names = {w.lower() for w in _WORD.findall(f"{found.get('class', '')} {found.get('id', '')}")}
    if tag not in BLOCKS and tag not in ("span", "ins"):
        return False
    if tag in LEAVES or tag == "article":  # a paragraph is not a header for being called "top"
        return bool(names & NEVER)
    return bool(names & NEVER) or bool(names & RARELY and not names & TEXTUAL)


def _read(html: str) -> tuple[_Node, list[tuple[_Node, str, int]]]:
    """The tree of block elements, and the blocks: container, text, letters in links."""
    root = here = _Node("#", None, False)
    inline: list[str] = []  # open inline elements that count (links), and skipped ones
    blocks: list[tuple[_Node, str, int]] = []
    parts: list[str] = []
    linked, in_link, hidden, place = 0, 0, [], 0

    def end() -> None:
        nonlocal linked, in_link
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                blocks.append((here, text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not here.skip and not hidden:
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    def close_to(node: _Node) -> None:
        nonlocal here, in_link
        here = node
        in_link = 0
        hidden.clear()

    for m in _TOKEN.finditer(html):
        say(html[place : m.start()])
        place = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["close"]:
            if tag in BLOCKS or tag in SKIPPED:
                at = here
                while at.parent and at.tag != tag:
                    at = at.parent
                if at.parent:
                    end()
                    close_to(at.parent)
            elif tag == "a":
                in_link = max(0, in_link - 1)
            elif hidden and hidden[-1] == tag:
                hidden.pop()
            continue
        if tag == "br" or tag == "wbr":
            say(" " if tag == "br" else "")
        elif tag in BLOCKS or tag in SKIPPED:
            end()
            if tag == "hr":
                continue
            closes, until = _ITEMS.get(tag, (frozenset(), frozenset()))
            at, found = here, None
            while at.parent and at.tag not in until:
                if at.tag in closes or (at.tag == "p" and found is None):
                    found = at.parent
                    if at.tag == "p" and not closes:
                        break
                elif not closes:
                    break
                at = at.parent
            close_to(found or here)
            over = here.parent if here.depth >= DEEPEST else here
            here = _Node(tag, over, _skipped(tag, m["rest"], over))
        elif tag in VOID or m["rest"].endswith("/"):
            continue
        elif tag == "a":
            in_link = 1
        elif hidden or _skipped(tag, m["rest"], here) and not here.skip:
            hidden.append(tag)
    say(html[place:])
    end()
    return root, blocks


def main_text(html: str | None) -> str:
    """The article's blocks, one to a line; empty if there are none."""
    if not html:
        return ""
    root, blocks = _read(html)
    if not blocks:
        return ""
    for node, text, links in blocks:
        # a paragraph's points go to its container; half as many to the next, a third beyond
        points = 1 + text.count(",") + text.count("、") + text.count("，") + min(len(text) / 100, 3)
        if len(text) < 25 or node.tag in HEADINGS:
            points = 0.0
        points *= 1 - links / len(text)
        at = node.parent if node.tag in LEAVES and node.parent else node
        share = 1
        up = at
        while up:
            up.points += points / share
            share += 1
            up = up.parent
        up = node
        while up:
            up.chars += len(text)
            up.links += links
            up = up.parent
    best, most = root, -1.0
    todo = [root]
    while todo:
        node = todo.pop()
        todo.extend(n for n in reversed(node.children) if not n.skip)
        if node.tag not in LEAVES and node.chars:
            worth = node.points * (1 - node.links / node.chars)
            if worth > most or (worth == most and node.depth > best.depth):
                best, most = node, worth
    up = best
    while up:
        if up.tag in ("article", "main"):
            best = up
            if up.tag == "article":
                break
        up = up.parent
    kept = {id(best)}
    if best.parent and best.tag not in ("body", "html", "main"):
        for node in best.parent.children:
            if node.skip or not node.chars:
                continue
            density = node.links / node.chars
            worth = node.points * (1 - density)
            if node.tag in LEAVES:
                good = density < 0.25
            elif best.tag == "article":
                good = node.tag == "article" and worth >= 0.2 * most
            else:
                good = density < 0.25 and worth >= min(10, 0.2 * most)
            if good:
                kept.add(id(node))
    lines = []
    for node, text, links in blocks:
        up = node
        while up and id(up) not in kept:
            up = up.parent
        list_of_links = node.tag in ("li", "td", "dd", "dt", "div", "ul") and links > 0.8 * len(text)
        if up and not list_of_links or node is best:
            lines.append(text)
    return "\n".join(lines)


def extract(html: Column) -> Column:
    """The main text of whole pages. Null, empty and textless pages give an empty text."""

    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([main_text(p) for p in pages.to_pylist()], pa.string())

    return F.arrow_udf(texts, "string")(html)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page of ``pages`` with its main text."""
    pages = common.table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", extract(F.col("html")).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
