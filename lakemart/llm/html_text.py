"""Main text of web pages: the maximum-scoring run of a page's tokens.

A page is read as a sequence of tags and blocks of words. Words score positive
where articles have their words and negative elsewhere, tags score negative;
the weights are log odds counted on labelled pages (pages that mark their own
article) over a prior. One linear scan finds the contiguous region of the
highest sum; its blocks, without the boilerplate standing in it, are the text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import text_or_empty, use_package_on_workers

#: Labelled pages counted for the weights, and their length, at most.
SAMPLE_PAGES = 400
SAMPLE_PAGE_CHARS = 1 << 16

# Element names as HTML has them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements whose tags part regions more strongly than others'.
SECTION = frozenset("html body main article section header footer nav aside".split())
#: Elements that are never part of an article.
APART = frozenset(
    "nav footer aside form dialog menu head button select option datalist label fieldset "
    "audio video canvas object map".split())
#: Words in class, id or role that mark what is not the article.
APART_WORDS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner sponsor sponsored promo promoted "
    "promotion nav navbar navigation menu menubar topbar breadcrumb breadcrumbs sidebar sidebars aside "
    "complementary header masthead footer foot colophon contentinfo cookie cookies consent gdpr notice "
    "notices notification alert alertdialog warning popup modal overlay dialog newsletter subscribe "
    "subscription signup login share sharing social comment comments commentlist disqus reply replies "
    "respond responses discussion related recommended recommendations widget widgets toolbar search "
    "searchbox form pagination pager copyright legal disclaimer paywall skip".split())
#: Of these, the words that name an article's sections as well; like a value
#: with one of ``ARTICLE_WORDS``, they lower a block's score and delete nothing.
TOPIC_WORDS = frozenset(
    "discussion related recommended recommendations search form legal disclaimer notice notices notification "
    "alert warning social sharing share response responses respond".split())
ARTICLE_WORDS = frozenset("article post entry story content main body".split())
#: First words of a value that says what else the page has ("no-sidebar").
_SAYS = frozenset("no not has with without".split())
#: How far a block is from being the article's.
CLEAR, DOUBTFUL, LISTED, NEVER = range(4)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)", re.S)
_MARKS = re.compile(r"(?:^|[\s\"'/])(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Block:
    """Words between two block borders: their text so far, the innermost block
    element, whether it stands apart from an article or may do so, and its words
    in links."""

    __slots__ = ("element", "apart", "doubtful", "parts", "linked", "marked")

    def __init__(self, element: str, standing: int, marked: bool):
        self.element, self.marked = element, marked
        self.apart, self.doubtful = standing >= LISTED, standing == DOUBTFUL
        self.parts: list[str] = []
        self.linked = 0

    def text(self) -> str:
        return " ".join(entities.unescape("".join(self.parts)).split())


def _standing(name: str, attrs: str, inside_article: bool) -> int:
    """What an element's own name and marks say of its blocks."""
    if name in APART or name == "header" and not inside_article:
        return NEVER
    if name in HEADING or name in ("html", "body", "main") or not attrs:
        return CLEAR
    values = [[w.lower() for w in _NAME_WORDS.findall(value)]
              for mark in _MARKS.findall(attrs) for value in mark.strip("\"'").split()]
    values = [set(v) for v in values if v and v[0] not in _SAYS]
    article = any(v & ARTICLE_WORDS for v in values)
    found = set().union(*values) & APART_WORDS
    if not found or article and found == {"header"}:
        return CLEAR
    return DOUBTFUL if article or found <= TOPIC_WORDS else LISTED


def tokens_of(page: str) -> Iterator[str | Block]:
    """The page as tags (their names, closing ones with a slash) and blocks."""
    stack: list[tuple[str, int]] = []         # open block elements, their standing or what they are within
    articles = links = 0
    block: Block | None = None
    at = 0
    n = len(page)

    def state() -> Block:
        element, standing = stack[-1] if stack else ("body", CLEAR)
        return Block(element, standing, articles > 0)

    def text(piece: str) -> None:
        nonlocal block
        if block is None:
            if not piece.strip():
                return
            block = state()
        block.parts.append(piece)
        if links:
            block.linked += len(piece.split())

    while at < n:
        found = _TOKEN.search(page, at)
        if found is None:
            text(page[at:])
            break
        if found.start() > at:
            text(page[at:found.start()])
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue                          # comment, doctype, processing instruction
        closing = (found["close"] or found["close2"]) == "/"
        if name in RAW:
            if not closing and not (found["attrs"] or "").endswith("/"):
                end = _RAW_END[name].search(page, at)
                at = end.start() if end else n
            continue
        if name == "br":
            text(" ")
            continue
        if name == "a":
            links = 0 if closing else 1
            continue
        if name not in BLOCK and name not in APART:
            continue
        if block is not None:
            yield block
            block = None
        yield f"/{name}" if closing else name
        if name in VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    articles -= sum(e in ("article", "main") for e, _ in stack[k:])
                    del stack[k:]
                    break
            continue
        while stack and stack[-1][0] in ("p", *HEADING) or stack and stack[-1][0] == name == "li":
            stack.pop()                       # a block ends an open paragraph or heading, an item an item
        own = _standing(name, found["attrs"] or "", articles > 0)
        within = stack[-1][1] if stack else CLEAR
        if within < NEVER and (name == "main" or name == "article" and own < LISTED and not articles):
            within = CLEAR                    # wrappers of the article are not what their marks say
        stack.append((name, max(own, within)))
        articles += name in ("article", "main")
    if block is not None:
        yield block


def kind_of(block: Block, words: int) -> str:
    """What a block's words are weighed by."""
    if block.apart:
        return "apart"
    if words and block.linked >= words:
        return f"{block.element}:linked"
    return "doubtful" if block.doubtful else block.element


#: Prior counts (inside, outside an article) of word kinds.
_PRIOR = {"apart": (1, 200), "linked": (5, 10), "doubtful": (30, 20), "other": (60, 20)}


def count_page(page: str, counts: Counter) -> None:
    """Add a labelled page's tags and words, inside and outside its article."""
    inside = False
    for token in tokens_of(page):
        if isinstance(token, str):
            if token in ("/article", "/main"):
                inside = False
            counts["tag", token, inside] += 1         # the article's own tags are its border
            if token in ("article", "main"):
                inside = True
        else:
            words = len(token.text().split())
            counts["word", kind_of(token, words), token.marked] += words


def weights_from(counts: Counter) -> dict[tuple[str, str], float]:
    """Log odds of tags (at most a little negative) and of word kinds."""
    total = {(what, inside): sum(n for (w, _, i), n in counts.items() if w == what and i == inside)
             for what in ("tag", "word") for inside in (True, False)}
    out: dict[tuple[str, str], float] = {}
    for what, name in {(w, k) for w, k, _ in counts}:
        within, beyond = counts[what, name, True], counts[what, name, False]
        if what == "tag":
            odds = math.log((within + 1) / (total["tag", True] + 1)) - \
                math.log((beyond + 1) / (total["tag", False] + 1))
            out["tag", name] = min(-0.1, max(-4.0 if name.lstrip("/") in SECTION else -0.5, odds))
        else:
            a, b = _prior(name)
            out["word", name] = _clip(math.log((within + a) / (beyond + b)))
    return out


def _prior(kind: str) -> tuple[int, int]:
    return _PRIOR[kind if kind in ("apart", "doubtful") else "linked" if kind.endswith(":linked") else "other"]


def _clip(odds: float) -> float:
    return max(-1.5, min(3.0, odds))


def extract(page: str, weights: dict[tuple[str, str], float]) -> str:
    """The blocks of the best region, joined by an empty line."""
    best = total = 0.0
    start, region, items = 0, (0, 0), []
    for token in tokens_of(page):
        if isinstance(token, str):
            total += weights.get(("tag", token), -0.5)
        else:
            text = token.text()
            words = len(text.split())
            kind = kind_of(token, words)
            weight = weights.get(("word", kind))
            if weight is None:
                a, b = _prior(kind)
                weight = _clip(math.log(a / b))
            total += weight * words
            if words:
                items.append((text, token.apart))
        if total <= 0:
            total, start = 0.0, len(items)
        elif total > best:
            best, region = total, (start, len(items))
    return "\n\n".join(t for t, apart in items[slice(*region)] if not apart)


def labelled_weights(pages: DataFrame, html_col: str = "html",
                     most: int = SAMPLE_PAGES) -> dict[tuple[str, str], float]:
    """Weights counted on at most ``most`` pages, each at most
    ``SAMPLE_PAGE_CHARS`` long, that mark their article themselves; the pages
    with the smallest hashes are taken. Without such pages the prior holds."""
    own = pages.select(text_or_empty(html_col).alias("html")) \
        .filter(F.length("html") <= SAMPLE_PAGE_CHARS).filter(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    # hashes first: the sort moves eight bytes a page
    hashes = own.select(F.xxhash64("html").alias("of")).distinct().orderBy("of").limit(most)
    counts: Counter = Counter()
    for row in own.withColumn("of", F.xxhash64("html")).join(F.broadcast(hashes), "of") \
            .groupBy("of").agg(F.min("html").alias("html")).collect():
        count_page(row["html"], counts)
    return weights_from(counts)


def main_text(pages: DataFrame, weights: dict[tuple[str, str], float], *, id_col: str = "page_id",
              url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows ``(id, url, text, n_chars long)``, one per row of ``pages``; text is
    empty where no region scores above zero, n_chars counts its code points.

    Null pages count as empty; null ids and urls and repeated rows are kept;
    other columns are not read; an empty table gives an empty result. Equal
    sums go to the region that ends first.
    """
    use_package_on_workers(pages.sparkSession)
    rows = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"),
                        text_or_empty(html_col).alias("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                texts = [extract(h.as_py(), weights) for h in batch.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType),
                           T.StructField("url", rows.schema["url"].dataType),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return rows.mapInArrow(read, schema).withColumnsRenamed({"id": id_col, "url": url_col})
