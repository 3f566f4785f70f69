"""Main text of web pages, with removal of the site templates that recur on a host.

A tolerant parser makes a flat list of a page's texts and of the starts and ends of its
elements, so that any depth of nesting is read in one walk.  The subtrees of each page's
block elements are hashed from the inside out, and Spark counts the distinct pages of the
host that have each hash; subtrees that recur on many pages of the host are deleted, and
so are elements whose tag, role, class or id marks them as no part of the article.

What stays: everything in a ``main`` that holds an ``article``, and articles outside of it;
without articles the ``main``; without it the page.  Of the header of an article or main
its headings and paragraphs stay.  A class or id marks an element by whole names such as
``ad`` or ``comment-list``, all of whose words are those of ``DROP_NAMES`` and ``PLACES``:
``related-work`` marks nothing.  Within an article, paragraphs, headings, lists, tables and
the like are dropped only for a name of ``SURE_NAMES``.

Defined cases: a null html gives an empty text; a null url is a host of its own; pages
with equal text (of what tags and names leave) count once towards the recurrence, so that
a copied article is no template; a tag whose quote isn't closed ends at the next ``>``;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cartulary.llm.shared import bounded_batches, stash

#: A subtree is of the template when at least ``LEAST_PAGES`` distinct pages of the host have it, and outside of articles
#: ``LEAST_SHARE`` of all or ``MANY_PAGES`` (the latter only for ``LONG`` characters or more), within them ``ARTICLE_SHARE``.
LEAST_PAGES, LEAST_SHARE, ARTICLE_SHARE, MANY_PAGES, LONG = 8, 0.25, 0.5, 1000, 20

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?:[!?]|/(?![A-Za-z]))[^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?>[^>\"'=]+|=\s*(?:\"[^\"]*\"|'[^']*')|[\"'=])*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
MARKS = re.compile(r"class|id|role|hidden|style", re.I)
# Names of the HTML standard and usual class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
SPACED = frozenset("br td th option".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
DROP = frozenset(
    "script style noscript template iframe object embed svg canvas annotation annotation-xml head title nav aside form button select "
    "textarea input menu dialog footer audio video map noembed noframes datalist".split()
)
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist status".split())
DROP_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead banner ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "signup share sharing social related recommended comments comment disqus replies respond login pagination pager toolbar widget "
    "skip copyright header adsbox advertorial teaser outbrain taboola".split()
)
SURE_NAMES = frozenset(
    "ad ads adsbox advert adverts advertisement advertising advertorial sponsored promo cookie cookies consent newsletter subscribe share "
    "sharing comments comment disqus outbrain taboola pagination breadcrumb breadcrumbs copyright".split()
)
PLACES = frozenset(
    "site page main top bottom left right middle primary secondary global container wrapper wrap box area block section inner outer "
    "list item items bar links link buttons button icons thread form reader user users posts articles post article entry content slot "
    "unit google text message policy panel row col column body".split()
)
OWN = HEADING | frozenset("p blockquote pre table thead tbody tfoot tr td th li dl dt dd figure figcaption".split())
HEADER_KEEPS = HEADING | frozenset("p blockquote li figcaption dd".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
CLOSES_P = BLOCK - {"html", "body", "caption", "tbody", "tfoot", "thead", "tr", "legend"}


class Page:
    """``items`` in page order: a text, k for the start of element k, ~k for its end."""

    __slots__ = ("items", "tags", "attrs")

    def __init__(self) -> None:
        self.items: list[str | int] = []
        self.tags: list[str] = []
        self.attrs: list[str] = []

    def ends(self) -> list[int]:
        """Place of each element's end in ``items``."""
        out = [0] * len(self.tags)
        for at, x in enumerate(self.items):
            if not isinstance(x, str) and x < 0:
                out[~x] = at
        return out


@functools.lru_cache(maxsize=4096)
def marks(attrs: str) -> tuple[tuple[str, ...], str, bool]:
    """Names of class and id, role, and whether the element is hidden."""
    names, role, hidden = [], "", False
    if MARKS.search(attrs):
        for m in ATTRIBUTE.finditer(attrs):
            k, v = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if k in ("class", "id"):
                names += v.split()
            elif k == "role":
                role = v.strip()
            elif k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and "display:none" in v.replace(" ", "")):
                hidden = True
    return tuple(sorted(set(names))), role, hidden


def parse(text: str) -> Page:
    """A page from any text; unclosed and misnested elements are closed where HTML would."""
    page = Page()
    items, tags = page.items, page.tags
    stack: list[int] = []  # open elements
    places: dict[str, list[int]] = defaultdict(list)  # by tag their places in the stack
    blocks: list[int] = []  # places of open blocks

    def close(place: int) -> None:
        while len(stack) > place:
            k = stack.pop()
            places[tags[k]].pop()
            if tags[k] in BLOCK:
                blocks.pop()
            items.append(~k)

    def last(names: tuple[str, ...]) -> int:
        return max((places[t][-1] for t in names if places.get(t)), default=-1)

    at, n = 0, len(text)
    while at < n:
        m = TOKEN.search(text, at)
        if m is None:
            items.append(text[at:])
            break
        if m.start() > at:
            items.append(text[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            # an inline end tag closes no block
            if places.get(tag) and (tag in BLOCK or not blocks or blocks[-1] < places[tag][-1]):
                close(places[tag][-1])
            continue
        if tag in CLOSED_BY:
            bound = last(SCOPE[tag])
            for t in CLOSED_BY[tag]:
                if last((t,)) > bound:
                    close(places[t][-1])
        elif tag in CLOSES_P and places.get("p") and blocks[-1] == places["p"][-1]:
            close(blocks[-1])
        k = len(tags)
        tags.append(tag)
        page.attrs.append(m[3])
        items.append(k)
        if tag in VOID or (m[3].endswith("/") and tag not in BLOCK and tag not in RAW):
            items.append(~k)
            continue
        if tag in RAW:
            items.append(~k)
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(text, at)
            if end is None:
                break  # the rest of the page is raw text
            at = text.find(">", end.start()) + 1 or n
            continue
        places[tag].append(len(stack))
        if tag in BLOCK:
            blocks.append(len(stack))
        stack.append(k)
    close(0)
    return page


def _marked(names: tuple[str, ...], words: frozenset[str]) -> bool:
    """Whether a name consists of ``words`` and words of places, with at least one of ``words``."""
    for name in names:
        parts = [w for w in re.split(r"[^a-z]+", name) if w]
        if any(w in words for w in parts) and all(w in words or w in PLACES for w in parts):
            return True
    return False


def _dropped(tag: str, attrs: str, inside: bool) -> bool:
    """Whether an element is no part of an article; ``inside`` one or a main."""
    if tag in DROP or (tag == "header" and not inside):
        return True
    if not attrs:
        return False
    names, role, hidden = marks(attrs)
    if hidden or role in DROP_ROLES:
        return True
    if not names or tag in ("html", "body", "main") or tag in HEADING or role == "main":
        return False
    if tag in ("article", "header") or (inside and tag in OWN):
        return _marked(names, SURE_NAMES)
    return _marked(names, DROP_NAMES - {"header"} if inside else DROP_NAMES)


def _is_main(page: Page, k: int) -> bool:
    return page.tags[k] == "main" or (bool(page.attrs[k]) and marks(page.attrs[k])[1] == "main")


def clean(page: Page) -> None:
    """Take out of ``items`` what no article has."""
    items, tags, ends = page.items, page.tags, page.ends()
    kept: list[str | int] = []
    inside, header, held = 0, -1, 0  # open articles and mains; their open header; its open parts that stay
    at = 0
    while at < len(items):
        x = items[at]
        at += 1
        if isinstance(x, str):
            if header < 0 or held:
                kept.append(x)
            continue
        k = x if x >= 0 else ~x
        tag, step = tags[k], 1 if x >= 0 else -1
        if x >= 0 and _dropped(tag, page.attrs[k], inside > 0):
            at = ends[k] + 1
            continue
        if tag == "article" or _is_main(page, k):
            inside += step
        if k == header:
            header = -1
        elif header >= 0:
            held += step * (tag in HEADER_KEEPS)
        elif tag == "header":
            header, held = k, 0
        kept.append(x)
    page.items = kept


def _plain(text: str) -> str:
    if "&" in text:
        text = entities.unescape(text)
    return text.replace("\x00", "�")


def text_of(page: Page, first: int = 0, end: int | None = None) -> str:
    """Blocks of a range of ``items``, white space in each turned into one space, joined by two newlines."""
    blocks, run, tags = [], [], page.tags
    for x in page.items[first:end]:
        if isinstance(x, str):
            run.append(_plain(x))
            continue
        tag = tags[x if x >= 0 else ~x]
        if tag in SPACED:
            run.append(" ")
        elif tag in BLOCK and run:
            blocks.append(" ".join("".join(run).split()))
            run = []
    blocks.append(" ".join("".join(run).split()))
    return "\n\n".join(b for b in blocks if b)


def subtree_hashes(page: Page) -> dict[int, int]:
    """Hash of each block element that has text, from its tag, names, texts and the hashes of its blocks.

    The two last bits tell whether it stands in an article and whether it has ``LONG`` characters."""
    out: dict[int, int] = {}
    tags, attrs = page.tags, page.attrs
    open_: list[tuple[int, list[str], list[str], list[int]]] = [(-1, [], [], [0])]
    articles = 0
    for x in page.items:
        _, parts, run, size = open_[-1]
        if isinstance(x, str):
            run.append(_plain(x))
            continue
        k = x if x >= 0 else ~x
        tag = tags[k]
        if tag in SPACED:
            run.append(" ")
        if tag not in BLOCK:
            continue
        if run and (t := " ".join("".join(run).split())):
            parts.append("t" + t)
            size[0] += len(t)
        run.clear()
        if x >= 0:
            articles += tag == "article"
            open_.append((k, [], [], [0]))
            continue
        articles -= tag == "article"
        open_.pop()
        if parts and tag not in ("html", "body"):
            names = " ".join(marks(attrs[k])[0]) if attrs[k] else ""
            h = xxhash.xxh3_64_intdigest("\x00".join((tag, names, *parts)).encode("utf-8", "surrogatepass"))
            out[k] = ((h & ~3) | (articles > 0) | (size[0] >= LONG) << 1) - (1 << 63)
            parts = [f"h{h}"]
        above = open_[-1]
        above[1].extend(parts)
        above[3][0] += size[0]
    return out


def page_hashes(text: str | None) -> tuple[int, set[int]]:
    """Hash of the text that is left of a page, and hashes of its block elements."""
    page = parse(text or "")
    clean(page)
    sig = xxhash.xxh3_64_intdigest(text_of(page).encode("utf-8", "surrogatepass")) - (1 << 63)
    return sig, set(subtree_hashes(page).values())


def delete(page: Page, template: frozenset[int]) -> None:
    hashes, ends = subtree_hashes(page), page.ends()
    kept, at = [], 0
    while at < len(page.items):
        x = page.items[at]
        at += 1
        if not isinstance(x, str) and x >= 0 and hashes.get(x) in template:
            at = ends[x] + 1
            continue
        kept.append(x)
    page.items = kept


def _outermost(page: Page, ends: list[int], test, first: int = 0, end: int | None = None) -> list[tuple[int, int]]:
    """Ranges of the elements that pass and have text, none within another."""
    found, at = [], first
    end = len(page.items) if end is None else end
    while at < end:
        x = page.items[at]
        if not isinstance(x, str) and x >= 0 and test(x):
            found.append((at, ends[x] + 1))
            at = ends[x]
        at += 1
    return [r for r in found if text_of(page, *r)]


def main_text(text: str | None, template: frozenset[int] = frozenset()) -> str:
    """The article's text."""
    if not text:
        return ""
    page = parse(text)
    clean(page)
    if template:
        delete(page, template)
    ends = page.ends()
    is_article, is_main = lambda k: page.tags[k] == "article", functools.partial(_is_main, page)
    if _outermost(page, ends, is_article):
        some = _outermost(page, ends, lambda k: is_article(k) or is_main(k))
        some = [r for r in some if _outermost(page, ends, is_article, *r)]
    else:
        some = _outermost(page, ends, is_main) or [(0, len(page.items))]
    return "\n\n".join(text_of(page, *r) for r in some)


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for h, page in zip(b.column("host").to_pylist(), b.column("html")):
            sig, nodes = page_hashes(page.as_py())
            rows += [(h, sig, k) for k in nodes]
            rows.append((h, sig, None))
        columns = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["host", "sig", "node"])


def templates(pages: DataFrame, least: int = LEAST_PAGES, share: float = LEAST_SHARE) -> DataFrame:
    """(host, nodes): hashes of the subtrees that recur across the host's distinct pages."""
    bounded_batches(pages)
    seen = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(_hashes, "host string, sig long, node long").distinct()
    counted = stash(seen.groupBy("host", "node").agg(F.count("*").alias("n")).where(F.col("node").isNull() | (F.col("n") >= least)), "subtrees")
    total = counted.where("node is null").select("host", F.col("n").alias("total"))
    in_article, long_ = F.col("node").bitwiseAND(1) != 0, F.col("node").bitwiseAND(2) != 0
    needed = F.when(in_article, ARTICLE_SHARE * F.col("total")).when(long_, F.least(share * F.col("total"), F.lit(float(MANY_PAGES)))).otherwise(share * F.col("total"))
    often = counted.where("node is not null").join(total, "host").where(F.col("n") >= needed)
    return often.groupBy("host").agg(F.array_sort(F.collect_list("node")).alias("nodes"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        kept: dict[tuple, frozenset] = {}
        texts = []
        for page, nodes in zip(b.column("html"), b.column("nodes")):
            key = tuple(nodes.as_py() or ())
            texts.append(main_text(page.as_py(), kept.setdefault(key, frozenset(key))))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, least: int = LEAST_PAGES, share: float = LEAST_SHARE) -> DataFrame:
    """Per page row: page_id, url, text, n_chars."""
    found = stash(templates(pages, least, share), "templates")
    mine = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host(F.col("url")).alias("host"))
    return mine.join(found, "host", "left").select("page_id", "url", "html", "nodes").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
