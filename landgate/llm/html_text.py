"""The main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. Lines of menus, headers, footers, sidebars, notices,
adverts, forms, scripts and comments, known by their elements' names, roles and classes, are left out. Classes
and ids count as wholes; of a generic word in them, such as widget or related, links decide: in an article such
an element of several lines goes if most of its characters are in links and few are not, elsewhere the windows tell.
If the page marks its article, so are the lines outside, unless the windows find over twice as much text there
(then teasers are marked, not the article); else words inside links do not count for a line's
length, nor does a line of punctuation alone.
Lengths are summed over sliding windows of lines. The text surges where the sums rise from nothing to go over
a threshold before they fall back (over nothing, if no sum does and in a marked article), and dives where they
fall back to nothing. Every line from the first to the last one with a length between the two points is
the text, also short lines and lines of links; a page may have several such stretches. So a page without a
marked article loses whole windows of links, and stretches of short lines that such windows part from the text.

Defined results: null or empty html, and pages without such lines, give the empty string; unclosed elements
end with the page, but an unclosed element to be left out ends at the next block; character references are
decoded as HTML does, also without a semicolon; equal rows get equal results; nothing is cut; an empty table
gives no rows. A page of any length and however broken its tags takes time linear in its length: where a quote in a
tag is open to the page's end, quotes in tags mean nothing from there on.
"""

from __future__ import annotations

import functools
import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from landgate.llm.batches import measured
from landgate.llm.tables import table

WINDOW = 3
#: Characters outside links that a window holds somewhere in the text of a page without a marked article.
SURGE = 120
ARTICLE = frozenset(("article", "main"))
#: So many times the text of the marked articles outside them, in stretches found by windows, and the marks are
#: those of teasers: the windows decide on the page.
OUTWEIGHS = 2
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option "
    "p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is no text at all, up to their end tag.
RAW = frozenset("script style noscript template svg math iframe object textarea select".split())
LEFT_OUT = frozenset("head nav footer aside form menu dialog button label title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Whole tokens of a class, or whole ids, that mark what is no article; "_" counts as "-".
CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsbygoogle ad-banner ad-block ad-box "
    "ad-container ad-label ad-slot ad-space ad-unit ad-wrapper ads-container banner-ad google-ad google-ads "
    "sponsor sponsors sponsored sponsored-content promo popup modal modal-dialog "
    "sidebar side-bar left-sidebar right-sidebar sidebar-left sidebar-right sidebar-widget widget-area "
    "nav navbar nav-bar nav-menu nav-links navigation main-nav main-navigation site-nav site-navigation "
    "page-navigation post-navigation menu submenu main-menu side-menu breadcrumb breadcrumbs pagination pager "
    "footer page-footer site-footer site-header masthead topbar top-bar "
    "cookie cookies cookie-banner cookie-bar cookie-consent cookie-law cookie-message cookie-notice "
    "cookie-popup consent-banner gdpr gdpr-banner "
    "comments comments-area comments-section comment-section comment-list comment-form comment-body "
    "comment-respond comment comment-item comment-content comment-text comment-wrapper comment-thread commentlist "
    "reader-comments user-comments replies respond disqus disqus-thread reply-form "
    "social-icons social-links social-media social-share share-bar share-buttons share-links sharing "
    "sharing-buttons newsletter newsletter-form newsletter-signup subscribe-form signup-form login-form "
    "search-bar search-box search-form skip-link related-articles related-links related-posts".split()
)
#: Ids of sections in an article that are no names of its own sections.
SECTION_IDS = frozenset(("comments", "disqus-thread"))
#: Words in a class or id that mark what is no article only if it is a list of links.
WORDS = CLASSES | frozenset(
    "banner promotion side aside widget related recommended toc notice notices consent alert disclaimer "
    "comment discussion reply replies respond share social subscribe subscription signup login form search "
    "skip copyright legal".split()
)
CONTAINERS = frozenset("article div dl ol section table ul".split())
TOKEN = re.compile(r"<!--|<!\[CDATA\[|<(/?)([a-zA-Z][^\s/>]*)|<[!?]")
#: In a tag: its end, or where a quoted value begins.
IN_TAG = re.compile(r">|=\s*([\"'])")
END_TAG = re.compile(r"</([a-zA-Z][^\s/>]*)\s*>")
#: A name and its value, if any; values are passed over with their names, so words in them are no names.
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SMALL = {c: c + 32 for c in range(65, 91)}
JUDGED = frozenset(("class", "id", "role", "hidden"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class Tags:
    """The tags of a page from any place on, in time linear in the page however broken they are."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.quotes = True

    @functools.cached_property
    def ends(self) -> dict[str, int]:
        """Where the last end tag of every name starts."""
        return {m[1].lower(): m.start() for m in END_TAG.finditer(self.page)}

    @functools.cached_property
    def small(self) -> str:
        """The page with small letters, every sign at its place."""
        small = self.page.lower()
        return small if len(small) == len(self.page) else self.page.translate(SMALL)

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, whether it is an end tag, name, attributes); comments and the like have no name."""
        page = self.page
        found = TOKEN.search(page, at)
        if found is None:
            return None
        start = found.start()
        if found[0] in ("<!--", "<![CDATA["):
            end = page.find("-->" if found[0] == "<!--" else "]]>", found.end())
            return start, end + 3 if end >= 0 else len(page), False, "", ""
        if start > self.last:
            return None
        if not found[2]:
            return start, page.index(">", start) + 1, False, "", ""
        if page[found.end()] == ">":
            return start, found.end() + 1, found[1] == "/", found[2].lower(), ""
        end = self._end(found.end())
        if end < 0:  # a quote is open to the end of the page: from here on, quotes mean nothing
            self.quotes = False
            end = self._end(found.end())
        return start, end, found[1] == "/", found[2].lower(), page[found.end() : end - 1]

    def _end(self, at: int) -> int:
        page = self.page
        while self.quotes:
            found = IN_TAG.search(page, at)
            if found is None:
                return -1
            if found[1] is None:
                return found.end()
            at = page.find(found[1], found.end()) + 1
            if not at:
                return -1
        return page.find(">", at) + 1 or len(page) + 1

    def raw_end(self, name: str, at: int) -> int:
        """Where the content of an element of no text ends, its end tag included; -1 if nothing ends it."""
        while (at := self.small.find(f"</{name}", at)) >= 0:
            at += len(name) + 2
            if not self.small[at : at + 1].isalnum():
                return self.page.find(">", at) + 1 or len(self.page)
        return -1


def judged(attributes: str) -> list[tuple[str, str]]:
    """(name, value) of the attributes by which an element is judged."""
    if not attributes:
        return []
    found = ((kind.lower(), "".join(values).lower()) for kind, *values in ATTRIBUTE.findall(attributes))
    return [(kind, value) for kind, value in found if kind in JUDGED]


def names(name: str, attributes: str, in_article: bool) -> str:
    """The classes and ids by which an element is judged; those of headings and sections may be mere anchors."""
    found = []
    for kind, value in judged(attributes):
        value = value.replace("_", "-")
        anchor = kind == "id" and in_article and (name in HEADINGS or name == "section" and value not in SECTION_IDS)
        if kind in ("class", "id") and not anchor:
            found.append(value)
    return " ".join(found)


def left_out(name: str, attributes: str, in_article: bool) -> bool:
    if name in LEFT_OUT or (name == "header" and not in_article):
        return True
    if any(kind == "hidden" or kind == "role" and value in ROLES for kind, value in judged(attributes)):
        return True
    if name in ("html", "body", "main") or name == "article" and not in_article:
        return False
    return not CLASSES.isdisjoint(names(name, attributes, in_article).split())


def may_be_links(name: str, attributes: str) -> bool:
    """Whether links decide on an element inside an article."""
    return bool(attributes) and not WORDS.isdisjoint(re.split(r"[\s\-]+", names(name, attributes, True)))


def plain(parts: list[str]) -> str:
    text = "".join(parts)
    return " ".join((html.unescape(text) if "&" in text else text).split())


def lines_of(page: str) -> list[tuple[str, str, bool]]:
    """(text, text outside links, inside the article) of every block that is not left out."""
    lines: list[tuple[str, str, bool]] = []
    parts: list[str] = []
    free: list[str] = []
    out: list[str] = []  # names of the open elements that are left out, innermost last
    article = link = 0
    #: Of open containers: None, or the lines, characters and characters outside links before them.
    opened: dict[str, list[tuple[int, int, int] | None]] = {name: [] for name in CONTAINERS}
    held = held_free = 0

    def end_line():
        nonlocal held, held_free
        if parts:
            text = plain(parts)
            if text:
                lines.append((text, text if len(free) == len(parts) else plain(free), article > 0))
                held += len(text)
                held_free += len(lines[-1][1])
            parts.clear()
            free.clear()

    at, n, tags, no_end = 0, len(page), Tags(page), set()
    while at < n:
        tag = tags.next(at)
        upto = tag[0] if tag else n
        if upto > at and not out:
            text = page[at:upto]
            parts.append(text)
            if not link:
                free.append(text)
        if not tag:
            break
        _, at, closing, name, attributes = tag
        if not name:
            continue
        if name in RAW:
            if not closing and name not in no_end:
                end = tags.raw_end(name, at)
                if end < 0:
                    no_end.add(name)
                at = max(at, end)
            continue
        if name == "br":
            if not out:
                parts.append(" ")
                free.append(" ")
            continue
        if name in VOID and name != "hr":
            continue
        if name in BLOCKS and not out:
            end_line()
        if out:
            if closing:
                if out[-1] == name:
                    out.pop()
            elif name == out[-1]:
                out.append(name)
            continue
        if closing:
            before = opened[name].pop() if opened.get(name) else None
            if before:
                n_lines, own, own_free = len(lines) - before[0], held - before[1], held_free - before[2]
                if n_lines > 1 and own_free < SURGE and 2 * own_free < own:
                    del lines[before[0] :]
                    _, held, held_free = before
            if name in ARTICLE:
                article = max(0, article - 1)
            elif name == "a":
                link = 0
            continue
        if left_out(name, attributes, article > 0):
            if tags.ends.get(name, -1) >= at:
                out.append(name)
            elif name in BLOCKS:
                following = tags.next(at)
                while following and following[3] not in BLOCKS:
                    following = tags.next(following[1])
                at = following[0] if following else n
            continue
        if name in CONTAINERS:
            links = article > 0 and may_be_links(name, attributes)
            opened[name].append((len(lines), held, held_free) if links else None)
        if name in ARTICLE:
            article += 1
        elif name == "a":
            link = 1
    end_line()
    return lines


def stretches(lengths: list[int], threshold: int) -> list[tuple[int, int]]:
    """(first, last) line of every stretch from a surge to the dive whose windows reach ``threshold``."""
    half = WINDOW // 2
    n = len(lengths)
    found: list[tuple[int, int]] = []
    first = last = None
    peak = 0
    for i in range(n + 1):
        own = sum(lengths[max(0, i - half) : i + half + 1]) if i < n else 0
        if own:
            peak = max(peak, own)
            if lengths[i]:
                first, last = i if first is None else first, i
            continue
        if peak >= threshold:
            found.append((first, last))
        first, peak = None, 0
    return found


def unmarked(lines: list[tuple[str, str, bool]]) -> list[tuple[int, int]]:
    """The stretches of a page by its windows alone."""
    lengths = [len(free) if any(map(str.isalnum, free)) else 0 for _, free, _ in lines]
    if not any(lengths):
        lengths = [len(free) for _, free, _ in lines]
    return stretches(lengths, SURGE) or stretches(lengths, 1)


def main_text(page: str | None) -> str:
    lines = lines_of(page or "")
    inside = [line for line in lines if line[2]]
    if inside:
        outside = [("" if marked else text, "" if marked else free, False) for text, free, marked in lines]
        beside = sum(len(outside[i][1]) for first, last in unmarked(outside) for i in range(first, last + 1))
        if beside <= OUTWEIGHS * sum(len(free) for _, free, _ in inside):
            lines = inside
            found = stretches([len(text) for text, _, _ in lines], 1)
            return "\n".join(text for first, last in found for text, _, _ in lines[first : last + 1])
    return "\n".join(text for first, last in unmarked(lines) for text, _, _ in lines[first : last + 1])


def measure(column: pa.Array) -> dict:
    texts = [main_text(page) for page in column.to_pylist()]
    return {"text": texts, "n_chars": [len(text) for text in texts]}


def extracted(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), column: str = "html") -> DataFrame:
    """``keep`` and (text, n_chars) of every page."""
    return measured(pages, measure, "text string, n_chars long", column, keep)


def op3_line_blocks(spark, sf_dir):
    return extracted(table(spark, sf_dir, "pages"))


QUERIES = {"op3_line_blocks": (op3_line_blocks, None)}
