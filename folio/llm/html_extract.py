"""HTML extraction (4): nearest-URL page differencing.

1. A page is read into its text blocks in order.  Blocks in menus, headers,
   footers, sidebars, notices, adverts, forms, comments and the like (by tag,
   role, or whole class or id) are marked as such, but a class or id never marks
   what holds the page's main or only article element; character references are decoded and
   white space inside a block becomes one space.
2. Pages of a host are sorted by URL path, and each is paired with the page
   of the neighbouring path that is nearer by edit distance.
3. The blocks of a pair are aligned by their longest common subsequence: what
   both pages have is the site's, not the page's, and is deleted.
4. Blocks inside the page's own ``main`` or ``article`` element are its text
   whatever other pages say (articles quote each other), so the differencing
   decides for the blocks of pages that have no such element; there, a page
   whose blocks all stand in its neighbour is a copy of it and keeps them.

Sorting is by range over the distinct paths, so that a host with a third of
all pages is spread over tasks; neighbours across two tasks' border come from
each task's first and last path.

Defined results: null and empty pages have the empty text; a null URL, one
without a host, or a host's only path has no neighbour; pages of one URL share
a neighbour; repeated rows give repeated results.  Markup that ends too early
ends all open elements.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm.words import as_bytes
from folio.session import scratch_path

# Elements by their part in a page, from the HTML standard.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
    section summary table tbody td tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title iframe noframes noscript xmp template".split())
JUNK_TAGS = frozenset("""aside button canvas dialog footer form head input label map menu nav object optgroup option select
    svg audio video""".split())
JUNK_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation
    search status toolbar""".split())
JUNK_WORDS = frozenset("""ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent
    cookie cookies disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter notice overlay pagination
    pager paywall popup promo promotion related reply replies search share sharing sidebar signup skip social sponsor
    sponsored subscribe toolbar topbar widget""".split())
# Compounds of these words that mark junk; others (search-algorithms, form-factor) do not.
JUNK_NAMES = JUNK_WORDS | frozenset("""ad-banner ad-container ad-slot ad-unit ad-wrapper banner-ad comment-form comment-list
    comments-area comments-list comments-section cookie-banner cookie-bar cookie-consent cookie-notice footer-links footer-nav
    login-form main-menu main-nav main-navigation menu-bar nav-bar nav-menu newsletter-form newsletter-signup page-footer
    page-navigation post-ad post-navigation related-articles related-links related-posts search-bar search-box
    search-form share-bar share-buttons share-links side-bar sidebar-left sidebar-right signup-form site-footer
    site-menu site-nav site-navigation skip-link skip-links social-icons social-links social-share top-bar
    widget-area""".split())
# Elements whose id is an anchor for links to them.
_ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 p".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'<>]++|"[^"]*"|'[^']*')*+)>"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)([^<>]*)(?:>|\Z)""", re.S)
_MARKS = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?""", re.I)

JUNK, LOOSE, MAIN = 0, 1, 2

BLOCKS_TYPE = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("at", T.IntegerType()),
                                        T.StructField("main", T.BooleanType())]))


class Block(NamedTuple):
    text: str
    kind: int


def _is_junk(tag: str, attributes: str, in_article: bool) -> bool:
    """By tag, role or visibility."""
    if tag in JUNK_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for name, value in _MARKS.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name == "role" and value in JUNK_ROLES:
            return True
    return False


def _is_named_junk(tag: str, attributes: str, in_article: bool) -> bool:
    """By a whole class or id (but for a number at its end)."""
    if not attributes or tag in ("html", "body", "main"):
        return False
    for name, value in _MARKS.findall(attributes):
        name = name.lower()
        if name == "class" or (name == "id" and tag not in _ANCHORED):
            for word in value.strip("\"'").lower().split():
                word = re.sub(r"(?:-\d+)+$", "", re.sub(r"[-_]+", "-", word))
                if word in JUNK_NAMES or (not in_article and tag not in _ANCHORED
                                          and word in ("header", "site-header", "page-header")):
                    return True
    return False


def read_blocks(page: str) -> list[Block]:
    """The page's text blocks: junk, within main or article, or loose."""
    found, hidden = _read(page, ("main",))
    if hidden and not any((b[2] or b[3]) and not b[1] for b in found):
        found, _ = _read(page, ("main", "article"))
    # the main element if there is one, else the articles
    place = 2 if any(b[2] and not b[1] for b in found) else 3
    return [Block(b[0], JUNK if b[1] else MAIN if b[place] else LOOSE) for b in found]


def _read(page: str, shown: tuple[str, ...]) -> tuple[list[tuple[str, bool, bool, bool]], bool]:
    """(text, junk, in main, in article) of the blocks, and whether a class or id hides an article.

    A class or id does not mark an element of, or around one of, the tags ``shown``.
    """
    found: list[tuple[str, bool, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []
    hidden = False
    pieces: list[str] = []
    junk = main = article = 0

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                found.append((text, junk > 0, main > 0, article > 0))

    def pop_to(tag: str) -> None:
        nonlocal junk, main, article
        while stack:
            open_, was_junk, was_named = stack.pop()
            junk -= was_junk + was_named
            main -= open_ == "main"
            article -= open_ == "article"
            if open_ == tag:
                return

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            pieces.append(html.unescape(page[at:stop]))
        if m is None:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in BLOCK_TAGS:
                flush()
            if any(open_ == tag for open_, *_ in reversed(stack)):
                pop_to(tag)
            continue
        if tag == "br":
            pieces.append(" ")
        if tag in RAW_TAGS:
            close = re.compile(f"</{tag}", re.I).search(page, at)
            after = page.find(">", close.start()) if close else -1
            at = after + 1 if after >= 0 else end
            continue
        if tag in BLOCK_TAGS:
            flush()
            if any(open_ == "p" for open_, *_ in stack[-8:]):
                pop_to("p")
        if tag in VOID_TAGS:
            continue
        attributes, inside = m[3] or m[6] or "", article > 0 or main > 0
        is_junk = _is_junk(tag, attributes, inside)
        named = not is_junk and _is_named_junk(tag, attributes, inside)
        if tag in shown:
            named = False
            junk -= sum(was_named for _, _, was_named in stack)
            stack = [(open_, was_junk, False) for open_, was_junk, _ in stack]
        hidden |= tag == "article" and (named or any(was_named for _, _, was_named in stack))
        stack.append((tag, is_junk, named))
        junk += is_junk + named
        main += tag == "main"
        article += tag == "article"
    flush()
    return found, hidden


def common_lines(mine: list[int], theirs: list[int]) -> list[int]:
    """The positions in ``mine`` of a longest common subsequence with ``theirs``."""
    low = 0
    while low < min(len(mine), len(theirs)) and mine[low] == theirs[low]:
        low += 1
    high = 0
    while high < min(len(mine), len(theirs)) - low and mine[-1 - high] == theirs[-1 - high]:
        high += 1
    places: dict[int, list[int]] = {}
    for j in range(len(theirs) - high - 1, low - 1, -1):
        places.setdefault(theirs[j], []).append(j)
    ends: list[int] = []
    chains: list[tuple[int, object]] = []
    for i in range(low, len(mine) - high):
        for j in places.get(mine[i], ()):  # from the last to the first
            k = bisect_left(ends, j)
            chain = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(chain)
            else:
                ends[k], chains[k] = j, chain
    middle = []
    link = chains[-1] if chains else None
    while link is not None:
        middle.append(link[0])
        link = link[1]
    return [*range(low), *reversed(middle), *range(len(mine) - high, len(mine))]


def _keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, a key of the whole row, host and path."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1))
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1)
    return pages.select("page_id", "url", F.xxhash64("page_id", "url", "html").alias("row_key"),
                        F.nullif(host, F.lit("")).alias("host"), path.alias("path"), "html")


def page_lines(pages: DataFrame) -> DataFrame:
    """(row_key, host, path, lines): the hashes of each page's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = []
            for page in as_bytes(b.column(3)):
                found = read_blocks((page or b"").decode("utf-8", "replace"))
                lines.append(np.array([xxhash.xxh3_64_intdigest(x.text.encode()) for x in found], dtype=np.uint64).tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(lines, pa.binary())],
                                             names=["row_key", "host", "path", "lines"])

    return (_keyed(pages).select("row_key", "host", "path", "html")
            .mapInArrow(run, "row_key long, host string, path string, lines binary"))


def nearest_paths(lines: DataFrame) -> DataFrame:
    """(host, path, partner): the row_key of a page of the nearest other path of the host."""
    spark = lines.sparkSession
    path = scratch_path(spark, "url-order")
    (lines.where("host IS NOT NULL").groupBy("host", "path").agg(F.min("row_key").alias("page"))
     .repartitionByRange("host", "path").withColumn("part", F.spark_partition_id()).write.parquet(path))
    ordered = spark.read.parquet(path)
    inside = Window.partitionBy("part").orderBy("host", "path")
    own = F.struct("host", "path", "page")
    # a row a task
    edges = ordered.groupBy("part").agg(F.min(own).alias("first"), F.max(own).alias("last"))
    parts = Window.orderBy("part")
    edges = edges.select("part", F.lag("last").over(parts).alias("last_before"), F.lead("first").over(parts).alias("first_after"))
    near = (ordered.withColumn("before", F.lag(own).over(inside)).withColumn("after", F.lead(own).over(inside))
            .join(edges, "part")
            .withColumn("before", F.coalesce("before", "last_before"))
            .withColumn("after", F.coalesce("after", "first_after")))
    before = F.when(F.col("before.host") == F.col("host"), F.levenshtein("path", "before.path"))
    after = F.when(F.col("after.host") == F.col("host"), F.levenshtein("path", "after.path"))
    partner = F.when(before.isNotNull() & (after.isNull() | (before <= after)), F.col("before.page")).when(
        after.isNotNull(), F.col("after.page"))
    return near.select("host", "path", partner.alias("partner")).where("partner IS NOT NULL")


def shared_lines(pages: DataFrame) -> DataFrame:
    """(row_key, shared): the numbers of each page's blocks that its neighbour has too, in order."""
    spark = pages.sparkSession
    path = scratch_path(spark, "page-lines")
    page_lines(pages).write.parquet(path)
    lines = spark.read.parquet(path)
    partners = nearest_paths(lines)
    one = lines.groupBy("row_key").agg(F.first("lines").alias("lines"), F.first("host").alias("host"),
                                       F.first("path").alias("path"))
    pairs = (one.join(partners, ["host", "path"])
             .join(one.select(F.col("row_key").alias("partner"), F.col("lines").alias("theirs")), "partner")
             .select("row_key", "lines", "theirs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shared = [common_lines(*(np.frombuffer(x.as_buffer(), dtype=np.uint64).tolist() for x in pair))
                      for pair in zip(b.column(1), b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared, pa.list_(pa.int32()))],
                                             names=["row_key", "shared"])

    return pairs.mapInArrow(run, "row_key long, shared array<int>")


def main_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, url, row_key, blocks) with the blocks that are not junk: text, number, and whether it is in main."""
    keyed = _keyed(pages).select("page_id", "url", "row_key", "html")
    kind = pa.list_(pa.struct([("text", pa.string()), ("at", pa.int32()), ("main", pa.bool_())]))
    schema = keyed.select("page_id", "url", "row_key").schema.add("blocks", BLOCKS_TYPE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blocks = []
            for page in as_bytes(b.column(3)):
                found = read_blocks((page or b"").decode("utf-8", "replace"))
                whole = any(x.kind == MAIN for x in found)
                blocks.append([{"text": x.text, "at": i, "main": whole} for i, x in enumerate(found)
                               if x.kind == (MAIN if whole else LOOSE)])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(blocks, kind)], names=schema.names)

    return keyed.mapInArrow(run, schema)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_shared): the main text, and how many of the page's blocks its neighbour shares."""
    joined = main_blocks(pages).join(shared_lines(pages), "row_key", "left")
    own = F.filter("blocks", lambda b: b["main"] | ~F.coalesce(F.array_contains("shared", b["at"]), F.lit(False)))
    blocks = F.when(F.size(own) > 0, own).otherwise(F.col("blocks"))
    return joined.select("page_id", "url", F.array_join(F.transform(blocks, lambda b: b["text"]), "\n").alias("text"),
                         F.coalesce(F.size("shared"), F.lit(0)).cast("long").alias("n_shared"))
