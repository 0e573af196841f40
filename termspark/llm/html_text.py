"""Main text of web pages by tree scoring.

A page is read into a tree that is tolerant of unclosed and misplaced tags. Every paragraph earns points
for its length and its commas and passes them to its ancestors, less the farther up; an element's points
are discounted by the share of its text that stands in links. The best container is kept, with those
siblings that have enough points of their own, widened to the article or main element around it; without
one, headings and short blocks beside and between them stay too. Parts that are menus, headers, footers, sidebars, notices, adverts, forms, scripts or comments, by element,
role, class or id, never count and are left out. What stays is returned block by block in page order.

Work on one page is linear in its size, but for the fixed number of ancestors that get points.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspark.llm.common import map_rows, struct

# --- fixed values: element names of HTML by their part in a page ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre"
    " section summary table tbody td tfoot th thead title tr ul".split()
)
# an open element of the second kind ends where one of the first begins
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "tbody", "thead"},
    "tfoot": {"tr", "td", "th", "tbody", "thead"}, "body": {"head"},
}
# such elements keep what is inside them from ending what is outside
SCOPES = frozenset("table ul ol dl select html body article section div td th".split())
LEFT_OUT = frozenset(
    "script style noscript template iframe svg canvas object embed head title nav aside footer form button select"
    " textarea input menu dialog audio video map xmp noembed noframes".split()
)
PARAGRAPHS = frozenset("p pre td blockquote dd li div section article main".split())
# words of a class, id or role that name what is not the article
UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion"
    " nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager"
    " sidebar sidebars aside complementary widget widgets rail"
    " header masthead topbar footer contentinfo bottom copyright"
    " cookie cookies consent notice notices alert gdpr popup modal overlay newsletter subscribe subscription signup"
    " login search form share sharing social related recommended"
    " comment comments commentlist disqus respond replies reply discussion hidden".split()
)
# of these, words that an article uses for its own parts as well
GENERIC = frozenset(
    "header masthead bottom form search discussion related recommended share sharing social alert notice notices"
    " banner banners promo promotion overlay widget widgets rail login signup subscribe subscription copyright"
    " respond reply replies comment comments aside menu menus navigation hidden".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# elements that belong to the text next to them
BESIDE_TEXT = HEADINGS | frozenset("p pre ul ol dl blockquote table figure hgroup".split())
# words for what readers wrote, and words that such names have beside them
COMMENT_WORDS = frozenset("comment comments commentlist disqus".split())
COMMENT_BESIDE = frozenset(
    "user users reader readers visitor visitors section list area thread threads box wrapper wrap container block feed"
    " item items body content text tree children count meta author form holder inner form template main the all".split()
)
COMMENT_TAGS = frozenset("div section ul ol li dl table details article aside footer".split())
# words of a name that says that the element is part of the text
CONTENT_WORDS = frozenset("article articles entry post story content result results text".split())
# words that say that something else is beside an element, not what it is
BESIDE = frozenset("has with without no".split())
# --- end of fixed values ---

# points per this many characters, and at most so many for length
CHARS_PER_POINT = 100
MOST_LENGTH_POINTS = 3
# ancestors that get points: the parent all, its parent half, then a third of that, a sixth, ...
SHARES = (1.0, 1 / 2, 1 / 6, 1 / 9, 1 / 12)
# a sibling stays with this share of the best element's points
SIBLING_SHARE = 0.2
# an element with a doubtful name is left out with this share of its text in links
DOUBTFUL_DENSITY = 0.5
# an element with a name of other words too stays with this share of the page's text outside links
TEXT_SHARE = 0.75
# a list or division of at least so many links, with this share of its text in them, is a menu
MENU_LINKS, MENU_DENSITY = 3, 0.6

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
# a name from the start of the attributes on, and its value as a whole
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?")
_NAMES = frozenset("class id role hidden aria-hidden".split())
_PART = re.compile(r"[a-z]+")


# how sure a name is: not at all, if the element is mostly links, unless the element holds the page's text, wholly
STAYS, BY_LINKS, BY_SHARE, GOES = range(4)


def _unwanted(tag: str, attributes: str, inside_article: bool) -> int:
    """How sure it is that an element is left out with all it contains.

    Names of reader comments decide anywhere. Outside an article, other names of listed words alone decide,
    and names with other words unless the element holds the text; a word for the text leaves it to the links.
    Inside an article, and on headings and paragraphs, a name has to consist of listed words, not all of
    them generic; another name with a listed word is left to the links. A heading's id says nothing.
    """
    if tag in LEFT_OUT or tag == "header" and not inside_article:
        return GOES
    if not attributes or tag in ("html", "body", "main"):
        return STAYS
    sure = STAYS
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name not in _NAMES:
            continue
        if name == "hidden" or name == "aria-hidden" and value == "true":
            if tag != "article":
                return GOES
        if name in ("hidden", "aria-hidden") or name == "id" and tag in HEADINGS:
            continue
        for word in value.split():
            parts = set(_PART.findall(word))
            if UNWANTED.isdisjoint(parts) or not BESIDE.isdisjoint(parts):
                continue
            if tag in COMMENT_TAGS and COMMENT_WORDS & parts and parts <= COMMENT_WORDS | COMMENT_BESIDE | UNWANTED:
                return GOES
            if tag == "article":
                continue
            whole, outside = parts <= UNWANTED, not (inside_article or tag in HEADINGS or tag == "p")
            # a link by itself is all link
            if whole and (outside or not parts <= GENERIC or tag == "a"):
                return GOES
            if outside and tag not in BLOCK:
                return GOES
            sure = max(sure, BY_SHARE if outside and not CONTENT_WORDS & parts else BY_LINKS)
    return sure


class Page:
    """A page's elements, by number, and its blocks of text."""

    def __init__(self, html: str):
        self.tags, self.parents, self.out = ["#root"], [-1], [False]
        # elements whose names don't decide alone, and what does
        self.doubtful: list[tuple[int, int]] = []
        # (element, text, characters in links, number of links)
        self.blocks: list[tuple[int, str, int, int]] = []
        self._parse(html)

    def _open(self, tag: str, parent: int, out: bool) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.out.append(out)
        return len(self.tags) - 1

    def _parse(self, html: str) -> None:
        at, n = 0, len(html)
        # open elements, and for each the block element that text belongs to inside it
        stack, owners = [0], [0]
        # how many of each name are open; of links, articles, and inline elements that are left out
        opened: Counter[str] = Counter()
        text: list[str] = []
        link_chars = links = articles = silent = 0

        def flush() -> None:
            nonlocal link_chars, links
            if text:
                joined = " ".join(unescape("".join(text)).split())
                if joined and not self.out[owners[-1]]:
                    self.blocks.append((owners[-1], joined, link_chars, links))
                text.clear()
            link_chars = links = 0

        def close(depth: int) -> None:
            """End the elements of the stack from ``depth`` on."""
            nonlocal articles, silent
            if owners[-1] != owners[depth - 1]:
                flush()
            for element in stack[depth:]:
                tag = self.tags[element]
                opened[tag] -= 1
                articles -= tag in ("article", "main")
                silent -= self.out[element] and tag not in BLOCK
            del stack[depth:], owners[depth:]

        def add(piece: str) -> None:
            nonlocal link_chars
            if not silent:
                text.append(piece)
                link_chars += len(piece) if opened["a"] > 0 else 0

        while at < n:
            found = _TOKEN.search(html, at)
            if found is None:
                add(html[at:])
                break
            if found.start() > at:
                add(html[at : found.start()])
            at = found.end()
            closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                if opened[tag] > 0:
                    for depth in range(len(stack) - 1, 0, -1):
                        if self.tags[stack[depth]] == tag:
                            close(depth)
                            break
                        if tag in ("p", "li") and self.tags[stack[depth]] in SCOPES:
                            break
                continue
            ends = ENDS.get(tag, set()) | ({"p"} if tag in BLOCK else set())
            if left := sum(opened[e] for e in ends):
                cut = None
                for depth in range(len(stack) - 1, 0, -1):
                    name = self.tags[stack[depth]]
                    if name in ends:
                        cut, left = depth, left - 1
                    if not left or name not in ends and name in SCOPES:
                        break
                if cut is not None:
                    close(cut)
            if tag == "br":
                text.append(" ")
            elif tag in BLOCK:
                flush()
            if tag in VOID:
                continue
            if tag in RAW:
                # its content is text up to its own end tag
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else n
                continue
            if attributes.endswith("/") and tag not in BLOCK and tag != "a":
                continue
            parent = stack[-1]
            sure = _unwanted(tag, attributes, articles > 0)
            out = self.out[parent] or sure == GOES
            element = self._open(tag, parent, out)
            if sure in (BY_LINKS, BY_SHARE):
                self.doubtful.append((element, sure))
            stack.append(element)
            owners.append(element if tag in BLOCK else owners[-1])
            opened[tag] += 1
            links += tag == "a" and not silent
            articles += tag in ("article", "main")
            silent += out and tag not in BLOCK
        flush()

    def _sums(self) -> tuple[list[int], list[int], list[int]]:
        """Characters, characters in links, and links of every element with all it contains."""
        size = len(self.tags)
        chars, in_links, links = [0] * size, [0] * size, [0] * size
        for element, text, link_chars, count in self.blocks:
            chars[element] += len(text)
            in_links[element] += min(link_chars, len(text))
            links[element] += count
        for element in range(size - 1, 0, -1):
            parent = self.parents[element]
            chars[parent] += chars[element]
            in_links[parent] += in_links[element]
            links[parent] += links[element]
        return chars, in_links, links

    def main_text(self) -> str:
        """The blocks of the best container and its kept siblings, one to a line."""
        chars, in_links, links = self._sums()
        if any(sure == BY_SHARE for _, sure in self.doubtful):
            # where the text is: in the articles, or else in what holds nearly all characters outside links
            articles = [0] * len(self.tags)
            for element in range(len(self.tags) - 1, 0, -1):
                if self.tags[element] in ("article", "main") and not self.out[element] and chars[element]:
                    articles[element] = 1
                articles[self.parents[element]] |= articles[element]
        for element, sure in self.doubtful:
            self.out[element] |= bool(links[element]) and in_links[element] >= DOUBTFUL_DENSITY * chars[element]
            if sure == BY_SHARE and not articles[element]:
                share = (chars[element] - in_links[element]) / max(1, chars[0] - in_links[0])
                self.out[element] |= bool(articles[0]) or share < TEXT_SHARE
        if self.doubtful:
            # a parent is settled before its children
            for element in range(1, len(self.tags)):
                self.out[element] |= self.out[self.parents[element]]
            self.blocks = [b for b in self.blocks if not self.out[b[0]]]
            chars, in_links, links = self._sums()
        points = [0.0] * len(self.tags)
        for element, text, link_chars, _ in self.blocks:
            if self.tags[element] in PARAGRAPHS or element == 0 or self.tags[element] == "body":
                density = min(link_chars, len(text)) / len(text)
                earned = 1 + text.count(",") + min(len(text) / CHARS_PER_POINT, MOST_LENGTH_POINTS)
                up = self.parents[element] if self.tags[element] in ("p", "li", "td", "dd", "pre") else element
                for share in SHARES:
                    if up < 0:
                        break
                    points[up] += share * earned * (1 - density)
                    up = self.parents[up]
        scores = [p * (1 - i / c) if c else 0.0 for p, c, i in zip(points, chars, in_links)]
        best = max(range(len(scores)), key=lambda e: (scores[e], -e))
        if not scores[best]:
            best = 0
        kept = {best}
        around = best
        while around > 0 and self.tags[around] not in ("article", "main"):
            around = self.parents[around]
        if around > 0:
            kept = {around}
            best = around
        siblings = [e for e in range(1, len(self.tags)) if best and self.parents[e] == self.parents[best]]
        for element in siblings:
            if element != best and (
                scores[element] >= SIBLING_SHARE * scores[best] > 0
                or (self.tags[element] == "p" and chars[element] > 80 and 4 * in_links[element] < chars[element])
            ):
                kept.add(element)
        if best and around <= 0:
            kept |= self._beside(siblings, kept, chars, in_links)
        # elements are numbered in page order, so a parent is settled before its children
        size = len(self.tags)
        inside, menu = [False] * size, [False] * size
        for element in range(size):
            parent = self.parents[element]
            inside[element] = (element in kept or parent >= 0 and inside[parent]) and not self.out[element]
            menu[element] = (
                self.tags[element] in ("ul", "ol", "dl", "div", "section", "table")
                and links[element] >= MENU_LINKS
                and in_links[element] >= MENU_DENSITY * chars[element]
            )
        # loose text between kept siblings belongs to them
        own = [i for i, b in enumerate(self.blocks) if inside[b[0]]] if best and around <= 0 else []
        loose = range(own[0], own[-1] + 1) if own else range(0)
        self._spare_embedded(inside, menu)
        for element in range(1, size):
            menu[element] |= menu[self.parents[element]]
        return "\n".join(
            text
            for i, (element, text, _, _) in enumerate(self.blocks)
            if (inside[element] or i in loose and element == self.parents[best]) and not menu[element]
        )

    def _beside(self, siblings: list[int], kept: set[int], chars: list[int], in_links: list[int]) -> set[int]:
        """Siblings of the text: all but links between kept ones, headings and short blocks next to them."""
        headed = [0] * len(self.tags)
        for element, text, *_ in self.blocks:
            headed[element] += len(text) if self.tags[element] in HEADINGS else 0
        for element in range(len(self.tags) - 1, 0, -1):
            headed[self.parents[element]] += headed[element]
        shown = [e for e in siblings if not self.out[e] and chars[e]]
        at = [i for i, e in enumerate(shown) if e in kept]
        if not at:
            return set()
        found = {e for e in shown[at[0] : at[-1]] if 2 * in_links[e] < chars[e]}
        for run in (reversed(shown[: at[0]]), shown[at[-1] + 1 :]):
            for e in run:
                # a division of headings alone is a heading
                if not (self.tags[e] in BESIDE_TEXT or headed[e] == chars[e]) or 4 * in_links[e] >= chars[e]:
                    break
                found.add(e)
        return found

    def _spare_embedded(self, inside: list[bool], menu: list[bool]) -> None:
        """Unmark link-dense elements between paragraphs of the text, or under a heading after one."""
        size, n = len(self.tags), len(self.blocks)
        first, last, dense = [n] * size, [-1] * size, menu[:]
        for i, (element, *_) in enumerate(self.blocks):
            first[element], last[element] = min(first[element], i), i
        for element in range(size - 1, 0, -1):
            parent = self.parents[element]
            first[parent], last[parent] = min(first[parent], first[element]), max(last[parent], last[element])
        for element in range(1, size):
            dense[element] |= dense[self.parents[element]]
        plain = [
            i
            for i, (element, text, link_chars, _) in enumerate(self.blocks)
            if inside[element] and not dense[element] and self.tags[element] not in HEADINGS and 2 * link_chars < len(text)
        ]
        for element in range(size):
            if menu[element] and inside[element] and plain and plain[0] < first[element] < n:
                headed = self.tags[self.blocks[first[element] - 1][0]] in HEADINGS
                menu[element] = not (headed or plain[-1] > last[element])


def extract(html: str | None) -> str:
    """The main text of one page; empty for NULL, or where no text is left."""
    return Page(html).main_text() if html else ""


def extract_pages(pages: DataFrame, keep: list[str]) -> DataFrame:
    """``text``, ``n_chars`` (code points) and ``_row`` of the columns in ``keep``, for every row of ``pages(html)``.

    A NULL html gives an empty text, repeated rows stay, very long pages are read whole. No rows: no rows.
    """

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            texts = [extract(h) for h in batch["html"].to_pylist()]
            return {"text": texts, "n_chars": [len(t) for t in texts]}

        return work

    return map_rows(pages, {"html": "string"}, struct("text string, n_chars bigint"), start, keep)


def page_report(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for ``pages(page_id, url, html)``."""
    found = extract_pages(pages, ["page_id", "url"])
    return found.select(F.col("_row.page_id").alias("page_id"), F.col("_row.url").alias("url"), "text", "n_chars")
