"""Main text of web pages: markup where it speaks, a suffix array of each host's pages where it does not.

Blocks inside an article or main element are text, but for menus, forms, adverts, comments and the like in it;
repeats inside articles are never removed. The blocks of all pages outside articles are judged with their host. The
suffixes of the token streams of its distinct pages (furniture, which is evidence only, then these blocks) are sorted,
range by range over all tasks, and neighbours' common prefixes counted: an interval of suffixes that have `least` tokens
or more in common, on `LEAST_PAGES` distinct pages and `LEAST_SHARE` of the host's, is boilerplate, and its tokens
go. A passage that a few pages share, or an article at two addresses, stays. Beside an article, what is left
is text where the host has `LEAST_PAGES` pages to judge by, and `least` tokens of it stand together.

Suffixes are compared by their first `least` tokens, then by page. A longer repeat is found whole by the suffixes that
begin inside it: each of its stretches of `least` tokens is on the pages that it is on. A shorter suffix can hold no repeat.
Equal suffixes of a page are one row before the sort, and those of many pages may lie in several ranges, whose counts
are added; so a footer of a host with a third of all pages is no burden.

Null html counts as empty and gives an empty text; null urls are one host. Repeated rows are one page:
equal pages of a host, at any address, are one and no evidence of boilerplate. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import html as codec
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import RangeHash, flat_bytes, slices, spread_text, stored, word_bounds
from kinfold.plans.sizing import fits

LEAST_TOKENS = 6
#: Distinct pages of a host that hold a run of boilerplate, and their share of all its distinct pages.
LEAST_PAGES = 3
LEAST_SHARE = 0.2

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_ENDS = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "title", "xmp", "noscript", "template", "iframe")}
#: Elements whose content follows XML: any element in them may close itself.
_FOREIGN = ("svg", "math")
#: Elements in them that stand apart from the text before.
_LABELS = frozenset("text title desc annotation".split())
_NOISE_TAGS = frozenset("nav footer aside form menu dialog button select head object".split())
#: Whole classes, ids or roles that mark what is not the article.
_NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments disqus reply replies"
    " share sharing social related recommended newsletter subscribe subscription signup login search popup modal overlay toolbar widget"
    " contentinfo complementary ad-slot ad-container ad-banner ad-unit banner-ad cookie-banner cookie-notice cookie-consent cookie-bar"
    " share-buttons share-bar share-links social-share social-links social-media related-posts related-articles related-links"
    " comment-list comments-area comment-form comment-section newsletter-signup newsletter-form site-nav site-footer main-nav"
    " nav-menu main-menu page-footer search-form teaser teasers sidebar-left sidebar-right left-sidebar right-sidebar".split()
)
#: Those that mark it outside articles only; inside they stand on titles, warnings and margins of the text.
_OUTER_NAMES = frozenset("header masthead side notice notices alert site-header page-header".split())
_CONTAINERS = frozenset(
    "nav footer aside form menu dialog button select head object header article main section div ul ol dl table body figure details fieldset".split()
)
_BLOCKS = _CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption thead tbody tfoot blockquote pre hr address figcaption summary legend option html center".split()
)


#: Names of what readers wrote; an article of that name is theirs wherever it stands.
_READER_NAMES = frozenset("comment comments disqus reply replies comment-list comments-area comment-section".split())


class _Pieces:
    """Tags, text and comments of a page from left to right, in time proportional to its length.

    A tag ends at the first ``>`` outside quotes. If quotes leave none in the whole page, the tag ends at the first
    one, and from there on quotes are not looked at: they do not pair up in this page.
    """

    def __init__(self, source: str):
        self.source, self.last, self.quoted = source, source.rfind(">"), True

    def _tag_end(self, at: int) -> int:
        where = at
        while self.quoted:
            found = _ENDS.search(self.source, where)
            if found is None:
                self.quoted = False
            elif found[0] == ">":
                return found.end()
            else:
                close = self.source.find(found[0], found.end())
                if close < 0:
                    self.quoted = False
                where = close + 1
        return self.source.index(">", at) + 1

    def next(self, at: int) -> tuple[int, str, str, str]:
        """Where the piece at `at` ends, its text (if it is text), or its name and what follows the name."""
        source = self.source
        if source[at] != "<":
            end = source.find("<", at)
            end = len(source) if end < 0 else end
            return end, source[at:end], "", ""
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            return (len(source) if end < 0 else end + 3), "", "", ""
        if at > self.last:
            # No tag ends any more: what looks like the beginning of one is dropped with the rest of it.
            tag = _TAG.match(source, at)
            end = source.find("<", at + 1)
            end = len(source) if end < 0 else end
            return (end, "", "", "") if tag or source[at + 1 : at + 2] in ("!", "?") else (at + 1, "<", "", "")
        if source[at + 1 : at + 2] in ("!", "?"):
            return source.index(">", at) + 1, "", "", ""
        tag = _TAG.match(source, at)
        if tag is None:
            return at + 1, "<", "", ""
        end = self._tag_end(tag.end())
        return end, "", tag[1] + tag[2].lower(), source[tag.end() : end - 1]


@dataclass
class Page:
    """Blocks of a page, in order: those of the article, those of the page's furniture, and the others.

    `article_at` and `open_at` tell the places of blocks among all of the page.
    """

    article: list[str] = field(default_factory=list)
    furniture: list[str] = field(default_factory=list)
    open: list[str] = field(default_factory=list)
    article_at: list[int] = field(default_factory=list)
    open_at: list[int] = field(default_factory=list)
    has_article: bool = False


def _names(attributes: str) -> list[str]:
    values = [a or b or c for n, a, b, c in _ATTRIBUTE.findall(attributes) if n.lower() in ("class", "id", "role")]
    return " ".join(values).lower().replace("_", "-").split()


def _is_noise(attributes: str, inside: int) -> bool:
    names = _names(attributes)
    return not _NOISE_NAMES.isdisjoint(names) or (not inside and not _OUTER_NAMES.isdisjoint(names))


def read_page(source: str) -> Page:
    """The blocks of a page.

    An article inside an element that only its class, id or role marks as noise counts if the page has no
    other; beside one it is furniture, as among related pages or comments.
    """
    page, stack, run = Page(), [], []
    wrapped: list[str] = []  # blocks of articles inside marked elements
    wrapped_at: list[int] = []
    has_wrapped = False
    # Open noise elements, by tag and by name; open article or main elements outside noise, and inside named noise only.
    noise = named = inside = within = 0
    outer = 0  # named noise around the outermost article within
    foreign = 0  # open svg and math elements

    def flush() -> None:
        if run:
            # Once for all of a block, so that white space written as a reference counts too.
            words = " ".join(codec.unescape("".join(run)).split())
            run.clear()
            if words:
                if noise or named > outer:
                    page.furniture.append(words)
                else:
                    place = len(page.furniture) + len(wrapped) + len(page.article) + len(page.open)
                    (wrapped_at if within else page.article_at if inside else page.open_at).append(place)
                    (wrapped if within else page.article if inside else page.open).append(words)

    at, end, pieces = 0, len(source), _Pieces(source)
    opened: Counter[str] = Counter()  # containers on the stack, by tag
    unclosed: set[str] = set()  # raw elements that no end tag follows any more
    while at < end:
        at, text, tag, rest = pieces.next(at)
        if text:
            run.append(text)
        if not tag:
            continue
        closing = tag[0] == "/"
        tag = tag.lstrip("/")

        def closed(tag: str, at: int) -> int:
            """Where the element ends that was opened before `at`; -1 if never."""
            found = None if tag in unclosed else _RAW[tag].search(source, at)
            if found is None:
                unclosed.add(tag)
            return found.end() if found else -1

        if tag in _FOREIGN:
            if closing:
                foreign = max(foreign - 1, 0)
            elif not rest.endswith("/"):
                foreign += 1
            continue
        if foreign and tag in _LABELS:
            run.append(" ")
            if closing or tag != "title":
                continue
        if tag in _RAW and not closing:
            if foreign and (rest.endswith("/") or (tag == "title" and closed(tag, at) < 0)):
                continue
            stop = closed(tag, at)
            at = end if stop < 0 else stop
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag not in _BLOCKS:
            continue
        flush()
        if tag not in _CONTAINERS:
            continue
        if not closing:
            main = tag in ("article", "main")
            tagged = tag in _NOISE_TAGS or (tag == "header" and not inside and not within)
            if main:
                # An article inside another is judged by its names as other elements are; one of readers always.
                nested = tag == "article" and bool(inside or within)
                marked = bool(rest) and (_is_noise(rest, 1) if nested else not _READER_NAMES.isdisjoint(_names(rest)))
            else:
                marked = tag != "body" and bool(rest) and _is_noise(rest, inside + within)
            if rest.endswith("/") and not main:
                continue
            own = main and not marked and not noise and not named
            wrap = main and not marked and not noise and not inside and bool(named) and (not within or named == outer)
            stack.append((tag, tagged, marked, own, wrap))
            opened[tag] += 1
            if wrap and not within:
                outer = named
            noise, named, inside, within = noise + tagged, named + marked, inside + own, within + wrap
            page.has_article, has_wrapped = page.has_article or own, has_wrapped or wrap
        elif opened[tag]:
            while True:  # elements left open inside end with it
                name, tagged, marked, own, wrap = stack.pop()
                opened[name] -= 1
                noise, named, inside, within = noise - tagged, named - marked, inside - own, within - wrap
                if not within:
                    outer = 0
                if name == tag:
                    break
    flush()
    if has_wrapped and not page.has_article:
        page.article, page.article_at, page.has_article = wrapped, wrapped_at, True
    else:
        page.furniture += wrapped
    return page


def _streams(blocks: list[str]) -> list[bytes]:
    return [b.encode() for b in blocks]


def _leading_tokens(streams: list[list[bytes]], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first `least` tokens, hashed, of every suffix of the streams of pages that has as many; its page and first token."""
    joined = [b" ".join(s) for s in streams]
    raw, at = flat_bytes(pa.array(joined, pa.large_binary()))
    begin, end, first = word_bounds(raw, at)
    if len(begin) < least:
        return np.zeros((0, least), ">u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
    tokens = (RangeHash(raw)(begin, end) >> np.uint64(32)).astype(">u4")
    start = np.flatnonzero(np.arange(len(begin)) + least <= np.repeat(first[1:], np.diff(first)))
    page = np.searchsorted(first, start, "right") - 1
    return np.lib.stride_tricks.sliding_window_view(tokens, least)[start], page, start - first[page]


def _suffixes(pages: DataFrame, least: int) -> DataFrame:
    """Suffixes of the token streams of pages: host, page, suffix (its leading tokens), start among the open blocks, judged."""

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            read = [read_page(x) for x in batch.column("html").to_pylist()]
            leading, page, start = _leading_tokens([_streams(p.furniture + p.open) for p in read], least)
            # Furniture is evidence only; suffixes of the open blocks follow it in the stream.
            first_open = np.array([len(" ".join(p.furniture).split()) for p in read], np.int64)
            judged = np.array([bool(p.open) for p in read], bool)
            own = batch.select(["host", "page"]).take(pa.array(page))
            at = np.arange(len(page) + 1, dtype=np.int32) * (4 * least)
            packed = pa.Array.from_buffers(pa.binary(), len(page), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(leading))])
            yield pa.RecordBatch.from_arrays(
                [own.column("host"), own.column("page"), packed, pa.array(start - first_open[page]), pa.array(judged[page])],
                ["host", "page", "suffix", "start", "judged"],
            )

    schema = "host string, page bigint, suffix binary, start bigint, judged boolean"
    return pages.select("host", "page", "html").mapInArrow(suffixes, schema)


def _intervals(rows: DataFrame, least: int) -> DataFrame:
    """host, suffix, n (distinct pages), judged of the intervals of each host's suffix array with `least` tokens in common."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw, _ = flat_bytes(batch.column("suffix"))
            tokens = raw.view(">u4").reshape(-1, least)
            host = batch.column("host").dictionary_encode(null_encoding="encode").indices.to_numpy()
            common = np.cumprod(tokens[1:] == tokens[:-1], axis=1).sum(axis=1)
            begin = np.flatnonzero(np.append(True, (common < least) | (host[1:] != host[:-1])))
            n = np.diff(np.append(begin, batch.num_rows))
            judged = np.logical_or.reduceat(batch.column("judged").to_numpy(zero_copy_only=False), begin)
            # The first and the last may go on in other batches; the others are complete.
            some = n >= LEAST_PAGES
            some[[0, -1]] = True
            own = batch.select(["host", "suffix"]).take(pa.array(begin[some]))
            yield pa.RecordBatch.from_arrays(
                [own.column("host"), own.column("suffix"), pa.array(n[some]), pa.array(judged[some])], ["host", "suffix", "n", "judged"]
            )

    once = rows.groupBy("host", "suffix", "page").agg(F.max("judged").alias("judged"))
    ordered = once.repartitionByRange("host", "suffix", "page").sortWithinPartitions("host", "suffix", "page")
    found = ordered.mapInArrow(compare, "host string, suffix binary, n bigint, judged boolean")
    return found.groupBy("host", "suffix").agg(F.sum("n").alias("n"), F.max("judged").alias("judged"))


def covered_runs(pages: DataFrame, least: int, sizes: DataFrame) -> DataFrame:
    """Per page that its host can judge, where repeats of `least` tokens begin that enough pages of the host have. `sizes`: of_host, n_pages."""
    rows = stored(_suffixes(pages, least), "page-suffixes")
    sizes = F.broadcast(sizes) if fits(sizes) else sizes
    of_host = F.col("host").eqNullSafe(F.col("of_host"))
    shared = _intervals(rows, least).filter((F.col("n") >= LEAST_PAGES) & F.col("judged")).join(sizes, of_host)
    shared = stored(shared.filter(F.col("n") >= LEAST_SHARE * F.col("n_pages")).select("of_host", "suffix"), "boilerplate")
    open_rows = rows.filter("judged")
    found = open_rows.join(F.broadcast(shared) if fits(shared) else shared, "suffix").filter(of_host)
    known = open_rows.select("host", "page").distinct().join(sizes, of_host).filter(F.col("n_pages") >= LEAST_PAGES)
    known = known.select("page", F.lit(None).cast("bigint").alias("start"))
    return found.select("page", "start").unionByName(known).groupBy("page").agg(F.collect_set("start").alias("starts"))


def _uncovered(blocks: list[str], starts: list[int], least: int) -> list[list[list[str]]]:
    """Of each block the stretches of tokens that no repeat covers. A repeat may begin in furniture before the blocks."""
    words = [b.split(" ") for b in blocks]
    gone = np.zeros(sum(map(len, words)) + 1, bool)
    for s in starts:
        gone[max(s, 0) : max(s + least, 0)] = True
    out, at = [], 0
    for some in words:
        runs: list[list[str]] = []
        for k, w in enumerate(some):
            if not gone[at + k]:
                if not k or gone[at + k - 1]:
                    runs.append([])
                runs[-1].append(w)
        at += len(some)
        out.append(runs)
    return out


def _text(page: Page, starts: list[int] | None, least: int) -> list[str]:
    """The blocks of the main text. `starts` of repeats among the open blocks; None if the host can't judge them."""
    if page.has_article:
        placed = list(zip(page.article_at, page.article))
        if starts is not None:
            long = [[w for r in runs if len(r) >= least for w in r] for runs in _uncovered(page.open, starts, least)]
            placed += [(at, " ".join(some)) for at, some in zip(page.open_at, long) if some]
        return [block for _, block in sorted(placed)]
    if not starts:
        return page.open
    kept = [" ".join(w for r in runs for w in r) for runs in _uncovered(page.open, starts, least)]
    return [block for block in kept if block]


def main_text(docs: DataFrame, *, id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_TOKENS) -> DataFrame:
    """A row per page: page_id, url, text (blocks joined by two line feeds), n_chars."""
    source = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    address = F.col(f"`{url}`").cast("string")
    host = F.lower(F.regexp_extract(address, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    pages = docs.select(F.col(f"`{id}`").cast("bigint").alias("page_id"), address.alias("url"), host.alias("host"), F.xxhash64(host, source).alias("page"), source.alias("html"))
    sizes = pages.select(F.col("host").alias("of_host"), "page").distinct().groupBy("of_host").agg(F.count(F.lit(1)).alias("n_pages"))
    sizes = stored(sizes, "host-pages")
    pages = spread_text(pages)
    starts = stored(covered_runs(pages, least, sizes), "covered")
    starts = F.broadcast(starts) if fits(starts) else starts

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = []
            for body, begun in zip(batch.column("html").to_pylist(), batch.column("starts").to_pylist()):
                texts.append("\n\n".join(_text(read_page(body), begun, least)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.join(starts, "page", "left").select("page_id", "url", "html", "starts").mapInArrow(
        extract, "page_id bigint, url string, text string, n_chars bigint"
    )
