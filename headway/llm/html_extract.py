"""Main text of web pages, with the templates of their sites removed.

1. Every page is read into elements. Each element's subtree (tag, class and id, texts, children)
   has a hash. (host, content, hash) rows are made distinct in Spark and (host, hash) pairs counted,
   each after partial results in the tasks. A page's content is what it marks as its article, else
   all of it, so copies of a page or of an article count once. A subtree on at least ``share`` of a
   host's distinct pages, and on ``least`` of them, is part of the site's template.
2. The templates of its host go to every page, at most (elements of a page) / share of them, and
   their subtrees are deleted. Up to BROADCAST hashes in all, they go to all executors and pages
   are not shuffled; beyond, both meet by host, where Spark splits a host with many pages.
   Articles (article, main), what is around them, inline elements and cells without blocks stay,
   however often they recur. So do single paragraphs, headings, items and cells in an article: in
   there, only whole groups (a div, section, list, table) are taken for the site's.
3. What elements, roles, classes and ids call a menu, header, footer, sidebar, notice, advert,
   form, script, style or comments is deleted too. Classes and ids count as whole names. They say
   nothing about html, body and articles, nor about what holds an article unless one is left
   elsewhere; nor, in an article, about its headings and headers. If the page marks its article (article, main),
   the text is what is left in there, else what is left in the body.

Text is cut into blocks at block elements and line breaks; white space in a block becomes one
space; blocks are joined by a line feed. Markup may be broken: elements that are not closed end
with the one around them, closing tags without an opening one are ignored.

Null html is empty; null urls count as one host. Repeated pages count as one page, and each gets its
text. A page without text gives an empty one. Result columns replace columns of the same name.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm._common import importable, settled, without
from headway.llm.url_filter import host_of

SHARE, LEAST = 0.3, 5
#: Hashes in all templates (8 bytes each) up to which they are sent to every executor; beyond, pages and templates meet by host.
BROADCAST = 1_000_000
#: Fixed values of HTML: elements by what they are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
NOT_TEXT = frozenset("head script style noscript template iframe svg canvas object nav aside footer form button select textarea input dialog menu audio video".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NOT_TEXT_NAMES = frozenset((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs header masthead "
    "footer sidebar aside widget notice notices cookie cookies consent banner alert popup modal newsletter subscribe signup login form search "
    "share sharing social comment comments reply replies disqus related").split())
#: Parts of a text that are the article's own even if other pages have the same.
PIECES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption figcaption blockquote pre".split())
#: The same in names of several words, with one '-' for any run of '-' and '_'.
NOT_TEXT_COMPOUNDS = frozenset((
    "site-header main-header global-header page-masthead site-footer page-footer main-footer global-footer footer-widgets footer-links footer-nav footer-menu "
    "site-nav site-navigation main-nav main-navigation main-menu site-menu primary-nav primary-navigation primary-menu secondary-nav secondary-menu top-nav "
    "top-menu top-bar side-nav side-menu mobile-nav mobile-menu nav-bar nav-menu nav-links post-navigation posts-navigation page-navigation header-nav header-menu "
    "breadcrumb-trail breadcrumb-nav breadcrumbs-nav side-bar left-sidebar right-sidebar sidebar-left sidebar-right main-sidebar primary-sidebar sidebar-primary "
    "sidebar-secondary sidebar-widget sidebar-area widget-area widget-container ad-slot ad-container ad-wrapper ad-box ad-banner ad-block ad-unit ad-label ad-space "
    "ads-container ads-wrapper ads-banner banner-ad banner-ads google-ad google-ads top-ad side-ad sidebar-ad bottom-ad advert-container advertisement-container "
    "sponsored-content sponsored-links sponsored-post promo-box promo-banner cookie-banner cookie-bar cookie-notice cookie-consent cookie-popup cookie-message "
    "cookies-banner cookies-notice consent-banner site-notice alert-banner pop-up popup-overlay modal-dialog modal-content modal-overlay newsletter-signup "
    "newsletter-form newsletter-box email-signup signup-form signup-box sign-up subscribe-form subscribe-box subscription-form login-form login-box search-form "
    "search-box search-bar search-widget share-bar share-box share-buttons share-links sharing-buttons social-bar social-buttons social-icons social-links "
    "social-media social-share social-sharing comment-area comment-form comment-list comment-respond comment-section comments-area comments-list comments-section "
    "user-comments reply-form disqus-thread related-articles related-content related-links related-news related-pages related-posts related-stories").split())
#: Names by which an article says that it is a reader's.
READERS_NAMES = frozenset("comment comments reply replies comment-body comment-item comment-wrapper user-comment user-comments reader-comment reader-comments".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a head holds; anything else ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
ARTICLE, ARTICLE_ROLES = frozenset(("article", "main")), frozenset(("article", "main"))
#: Elements that end an open paragraph, and those that end an open element of the same kind.
ENDS_PARAGRAPH = frozenset((
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr li main menu nav ol p pre section summary table td th tr ul").split())
CLOSED_BY = {
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")), "th": frozenset(("td", "th")), "option": frozenset(("option",)),
}
HOLDERS = frozenset("ul ol dl table tbody thead tfoot select article section div body main nav aside footer header".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")


class Element:
    __slots__ = ("tag", "names", "role", "parts", "hash", "holds")

    def __init__(self, tag: str, attributes: str):
        self.tag, self.names, self.role = tag, "", ""
        self.parts: list = []  # texts and elements in page order
        self.hash = 0
        self.holds = False  # whether an article is in it
        if "=" in attributes:
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
            self.names = f"{found.get('class', '')} {found.get('id', '')}".lower()
            self.role = found.get("role", "").lower()

    def is_article(self) -> bool:
        return self.tag in ARTICLE or self.role in ARTICLE_ROLES


def read(page: str) -> Element:
    """The page's elements as a tree."""
    root = Element("", "")
    stack, at = [root], 0
    while at < len(page):
        token = TOKEN.search(page, at)
        if token is None:
            if stack[-1].tag == "head" and not page[at:].isspace():
                stack.pop()
            stack[-1].parts.append(page[at:])
            break
        if token.start() > at:
            if stack[-1].tag == "head" and not page[at:token.start()].isspace():
                stack.pop()
            stack[-1].parts.append(page[at:token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if stack[depth].tag in HOLDERS and tag not in HOLDERS:
                    break  # a stray closing tag does not end what is around it
            continue
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            stack.pop()
        elif tag == "body":
            # Also with something left open in the head.
            for depth in range(1, min(len(stack), 3)):
                if stack[depth].tag == "head":
                    del stack[depth:]
                    break
        if tag in ENDS_PARAGRAPH or tag in CLOSED_BY:
            _close_before(stack, tag)
        element = Element(tag, token[3])
        stack[-1].parts.append(element)
        if element.is_article():
            for around in reversed(stack):
                if around.holds:
                    break
                around.holds = True
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            stop = end.start() if end else len(page)
            element.parts.append(page[at:stop])
            at = end.end() if end else stop
        elif tag not in VOID and not token[3].endswith("/"):
            stack.append(element)
    return root


def _close_before(stack: list[Element], tag: str) -> None:
    """Ends a paragraph, and list items, cells and the like, before an element that can't be inside."""
    ends = CLOSED_BY.get(tag, frozenset())
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in ends or (stack[depth].tag == "p" and tag in ENDS_PARAGRAPH):
            del stack[depth:]
            return
        if stack[depth].tag not in INLINE:
            return


def hashes(root: Element) -> list[int]:
    """Hashes of the subtrees with text, each once. Without recursion, as pages may be deeply nested."""
    order, todo = [], [root]
    while todo:
        element = todo.pop()
        order.append(element)
        todo.extend(p for p in element.parts if type(p) is Element)
    found = set()
    for element in reversed(order):
        digest, filled = xxhash.xxh3_64(f"{element.tag}\0{element.names}".encode("utf-8", "replace")), False
        for part in element.parts:
            if type(part) is Element:
                if part.hash:
                    filled = True
                    digest.update(part.hash.to_bytes(8, "little"))
            elif text := " ".join(part.split()):
                filled = True
                digest.update(text.encode("utf-8", "replace"))
        if filled:
            element.hash = digest.intdigest() or 1
            if element.tag not in ("", "html", "body"):
                found.add(element.hash)
    return list(found)


def content(root: Element) -> int:
    """Hash of what tells a page from its copies, after ``hashes``: its articles, else all of it."""
    digest, todo = xxhash.xxh3_64(), [root]
    while todo:
        element = todo.pop()
        if not element.is_article():
            todo.extend(p for p in reversed(element.parts) if type(p) is Element and (p.holds or p.is_article()))
        elif element.hash:
            digest.update(element.hash.to_bytes(8, "little"))
    return digest.intdigest() if digest.intdigest() != xxhash.xxh3_64_intdigest(b"") else root.hash


def _of_template(element: Element, in_article: bool, template: frozenset[int]) -> bool:
    if element.hash not in template or element.holds or element.tag in INLINE or element.is_article():
        return False
    if in_article:
        return element.tag not in PIECES
    return element.tag not in ("td", "th") or any(type(p) is Element and p.tag not in INLINE for p in element.parts)


def _boilerplate(element: Element, in_article: bool, others: bool) -> bool:
    """Whether it is none of the page's text; ``others``: whether articles are left when those in named elements go."""
    if element.tag in NOT_TEXT or element.role in NOT_TEXT_ROLES or (element.tag == "header" and not in_article):
        return True
    if not element.names.strip() or element.tag in ("html", "body") or element.is_article() or (element.holds and not others):
        return False
    if in_article and element.tag in HEADINGS:
        return False
    names = element.names.split()
    if in_article:
        names = [name for name in names if name != "header"]
    return any(name in NOT_TEXT_NAMES or ("-" in name or "_" in name) and re.sub(r"[-_]+", "-", name).strip("-") in NOT_TEXT_COMPOUNDS for name in names)


def _readers(element: Element) -> bool:
    """Whether it is an article that is named as a reader's comment."""
    return element.is_article() and element.tag != "main" and any(re.sub("[-_]+", "-", name).strip("-") in READERS_NAMES for name in element.names.split())


def _has_own(root: Element) -> bool:
    """Whether there is an article that isn't a reader's; then readers' articles in it or beside it aren't the page's text."""
    todo = [root]
    while todo:
        element = todo.pop()
        if element.is_article() and element.tag != "main" and not _readers(element):
            return True
        todo.extend(p for p in element.parts if type(p) is Element and (p.holds or p.is_article()) and not _readers(p))
    return False


def _stays(root: Element) -> bool:
    """Whether an article is left if what holds one goes by its names, too."""
    todo = [root]
    while todo:
        element = todo.pop()
        if element.is_article():
            return True
        todo.extend(p for p in element.parts if type(p) is Element and (p.holds or p.is_article()) and not _boilerplate(p, False, True))
    return False


def main_text(root: Element, template: frozenset[int]) -> str:
    """Text of what is neither boilerplate nor in the site's template."""
    blocks: list[tuple[bool, str]] = []
    open_parts: list[str] = []
    marked, others = False, root.holds and _stays(root)
    own = root.holds and _has_own(root)

    def end(inside: bool) -> None:
        if text := " ".join(entities.unescape("".join(open_parts)).split()):
            blocks.append((inside, text))
        open_parts.clear()

    todo: list = [(root, False, False)]  # (element or text, in an article, whether it ends a block)
    while todo:
        part, inside, ends = todo.pop()
        if ends:
            end(inside)
            continue
        if type(part) is str:
            open_parts.append(part)
            continue
        if _of_template(part, inside, template) or _boilerplate(part, inside, others) or (own and _readers(part)):
            end(inside)
            continue
        article = part.is_article()
        marked = marked or article
        if part.tag not in INLINE:
            end(inside)
            todo.append((None, inside or article, True))
        todo.extend((p, inside or article, False) for p in reversed(part.parts))
    end(False)
    return "\n".join(text for inside, text in blocks if inside or not marked)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, contents, found = [], [], []
        for host, page in zip(batch["host"].to_pylist(), batch["html"].to_pylist()):
            root = read(page)
            # 0 counts the page itself.
            own = [0, *hashes(root)]
            hosts += [host] * len(own)
            contents += [content(root)] * len(own)
            found += own
        numbers = {name: pa.array([h - (1 << 63) for h in of], pa.int64()) for name, of in (("content", contents), ("subtree", found))}
        yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), **numbers})


def templates(pages: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(of, subtrees) of hosts with subtrees that are on many of their distinct pages; ``pages``: host, html."""
    once = pages.mapInArrow(_subtrees, "host string, content long, subtree long").distinct()
    # What tells the rows of pages is an aggregate, so that no filter goes below and both sides read one exchange.
    itself = F.max(F.col("subtree") == -(1 << 63)).alias("itself")
    counted = once.groupBy("host", "subtree").agg(F.count("*").alias("n"), itself)
    # Subtrees on fewer than ``least`` pages are gone before hosts meet their number of pages.
    totals = counted.where("itself").select(F.col("host").alias("of"), F.col("n").alias("pages"))
    often = counted.where(~F.col("itself") & (F.col("n") >= least))
    both = often.join(totals, F.col("host") == F.col("of")).where(F.col("n") >= share * F.col("pages"))
    return both.groupBy("of").agg(F.collect_list("subtree").alias("subtrees"))


def extract(pages: DataFrame, url: str = "url", html: str = "html", text: str = "text", share: float = SHARE, least: int = LEAST) -> DataFrame:
    """All columns but the html, and the text."""
    importable()
    rows = without(pages, [text, "_host", "_html"]).withColumns({"_host": host_of(url), "_html": F.coalesce(F.col(html), F.lit(""))})
    # Settled, so that its size is known, and so that a host with many pages can be split over tasks if it is joined.
    known = settled(templates(rows.select(F.col("_host").alias("host"), F.col("_html").alias("html")), share, least))
    if (known.agg(F.sum(F.size("subtrees") + 4)).first()[0] or 0) <= BROADCAST:
        known = F.broadcast(known)
    joined = rows.join(known, F.col("_host") == F.col("of"), "left")

    @F.pandas_udf("string")
    def extracted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for bodies, subtrees in batches:
            out = []
            for body, known in zip(bodies, subtrees):
                root = read(body)
                if known is not None and len(known):
                    hashes(root)
                out.append(main_text(root, frozenset(int(h) + (1 << 63) for h in known) if known is not None else frozenset()))
            yield pd.Series(out, dtype=object)

    return joined.withColumn(text, extracted("_html", "subtrees")).drop("_host", "_html", "of", "subtrees", html)
