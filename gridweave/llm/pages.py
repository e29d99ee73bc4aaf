"""Main text of HTML pages: markup as evidence, and a suffix array over the token streams of a host.

A page is parsed once, in linear time, into blocks in page order, each of a zone:

* *dropped* by markup: navigation, the page's headers and footers, sidebars,
  forms, and elements whose class, id or role is a name for a menu, header,
  footer, sidebar, notice, advert or reader comments.  Scripts, styles, frames'
  and templates' raw content and comments are no text at all;
* *article*: what else stands in an ``article``; its own ``header`` holds its
  title and stays, as do quotations and links in its sentences, however they are called;
* *open*: the rest, of which markup says nothing, ``main`` outside an article included.

Token streams of a host's pages (their open blocks, and their dropped ones, end
to end) are entered into a suffix array that is sorted to the depth of ``RUN``
tokens: a suffix's entry is the hash of its host and first RUN tokens, and
entries meet by shuffle, so that an array of any size is spread over all tasks
and equal entries are combined before they are sent.  No order among different
entries is needed for that, so none is made: windows are hashed and grouped.  A
run that open blocks hold on ``LEAST`` distinct pages of the host and a ``SHARE`` of
them, or that two pages hold in dropped blocks, is repeated and covers its tokens;
an open block stays if it keeps a unique run, that is if at least half of its
tokens are uncovered, and a page that would lose all of its text keeps it (an
article at several addresses is no boilerplate).  This holds on every page, with an
article or without.  A block of an article stays whatever it repeats: articles share
passages and lines with each other and with adverts, and all of them are text.

A name counts if all of its words are known ones (``share-bar``, not
``share-price``), glued ones included (``sharebar``), letters, versions and the like
left out (``js-share-v2``).  Names of elements within a line do not count, but for
adverts that are no links; ids of headings are targets of links and do not count.
White space within a block is turned into single spaces, character references
are decoded, and blocks are joined by two line feeds.

Edge cases: null and empty pages have the empty text; unclosed elements end with
the page; a tag, comment or script that never closes is no text, nor is what
follows it; a null url is a host of its own name.  Pages are told apart by their
content, so repeated rows and copies count as one page for repetition and keep
their text, null and repeated ids included; extra columns are not read.  Memory
follows the longest page; runs are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import few, scratch

RUN = 8
LEAST, SHARE = 3, 0.1
DROPPED, OPEN, ARTICLE = 0, 1, 2
#: Marked rows up to which the marks are sent to all tasks.
BROADCAST_ROWS = 200_000
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_END = re.compile(r"=[ \t\r\n\f]*[\"']|>")
_CLOSING = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in ("script", "style", "noscript", "template", "iframe", "textarea", "title")}
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_SPACE = re.compile(r"[ \t\n\r\f\v\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Elements that end a block.
_BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that hold others and must be closed; the rest may be left open.
_HOLDERS = frozenset("article aside blockquote body details dialog div dl fieldset figure footer form head header html main menu nav ol section table ul".split())
#: Elements without content.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that a sibling of their kind closes.
_SIBLINGS = frozenset("li tr td th dd dt option".split())
_UNWANTED = frozenset("nav footer aside form menu head".split())
_ROLES = frozenset("navigation menu menubar contentinfo complementary search form".split())
# Names of what is no main text, and words that only tell where or how such a thing stands.
_NAMES = re.compile(r"ads?|advert|advertisement|advertising|adsense|banner|promo|promotion|sponsor|sponsored|sidebar|menu|nav|navbar|navigation|topnav|footer|header|masthead|cookies?|consent|gdpr|notices?|alert|popup|modal|newsletter|subscribe|subscription|signup|share|sharing|social|related|topbar|recommended|recommendations|comments?|commentlist|disqus|replies|respond|breadcrumbs?|pagination|pager|login|search|toolbar|copyright|disclaimer|paywall", re.I)
_PLACES = re.compile(r"bar|bars|box|block|section|container|wrapper|wrap|list|area|items?|links?|panel|widgets?|inner|outer|top|bottom|left|right|side|label|content|site|page|main|global|primary|secondary|form|buttons?|icons?|unit|slot|text|title|group|row|col|column|thread|reader|user|post|article|entry|blog|overlay|\d+", re.I)
_ADVERTS = re.compile(r"ads?|ads?by\w+|advert|advertisement|advertising|adsense|promo|promotion|sponsor|sponsored", re.I)
_AFFIXES = re.compile(r"[a-z]{1,2}|v\d+|web|app|mod|new|old", re.I)
_GLUED = re.compile(rf"(?:{_PLACES.pattern})*(?:{_NAMES.pattern}|adsby\w+)(?:{_NAMES.pattern}|{_PLACES.pattern})*", re.I)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def _named(name: str) -> bool:
    """Whether all words of a class or id (joined by hyphens, underscores or capitals) are known, one at least as a name."""
    words = _WORDS.findall(name)
    known = [bool(_NAMES.fullmatch(w)) or len(w) > 5 and bool(_GLUED.fullmatch(w)) for w in words]
    if any(known):
        return all(k or _PLACES.fullmatch(w) or _AFFIXES.fullmatch(w) for k, w in zip(known, words, strict=True))
    return len(words) == 2 and bool(_NAMES.fullmatch("".join(words)))


def _unwanted(tag: str, attributes: str, inside: bool) -> bool:
    if tag in _UNWANTED or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    within = tag not in _BLOCKS and tag not in _HOLDERS
    for m in _ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "role":
            if value.lower() in _ROLES or (value.lower() == "banner" and not inside):
                return True
        elif kind == "class" or tag not in ("h1", "h2", "h3", "h4", "h5", "h6"):
            for name in value.split():
                if within and (tag == "a" or not any(_ADVERTS.fullmatch(w) for w in _WORDS.findall(name))) or (inside and tag == "blockquote"):
                    continue
                # The header of an article is its own.
                if _named(name) and not (inside and name.lower().endswith("header")):
                    return True
    return False


def _closed(page: str, at: int) -> int:
    """Where the tag ends whose attributes begin at ``at``: its ``>`` outside quotes; -1 if it has none, -2 if a quote stays open."""
    while True:
        m = _END.search(page, at)
        if not m:
            return -1
        if m[0] == ">":
            return m.start()
        at = page.find(m[0][-1], m.end()) + 1
        if not at:
            return -2


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of every block, in page order.  The page is gone through once: a search that fails ends it or is not made again."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, dropped, inside an article or main, inside an article
    depth: dict[str, int] = {}
    wanted: list[str] = []
    dropped_: list[str] = []
    quotes = True
    at, size = 0, len(page)
    dropped = inside = article = False

    def flush() -> None:
        for parts, zone in ((dropped_, DROPPED), (wanted, ARTICLE if article else OPEN)):
            if parts:
                joined = "".join(parts)
                if "&" in joined:
                    joined = entities.unescape(joined)
                text = _SPACE.sub(" ", joined).strip(" ")
                if text:
                    out.append((zone, text))
                parts.clear()

    def pop() -> None:
        nonlocal dropped, inside, article
        depth[stack.pop()[0]] -= 1
        _, dropped, inside, article = stack[-1] if stack else ("", False, False, False)

    def keep(a: int, b: int) -> None:
        if b > a:
            (dropped_ if dropped else wanted).append(page[a:b])

    begun = 0
    while True:
        at = page.find("<", at)
        if at < 0:
            keep(begun, size)
            break
        m = _TAG.match(page, at)
        if not m:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                end = end + 2 if end >= 0 else -1
            elif page.startswith(("<!", "<?", "</"), at):
                end = page.find(">", at)
            else:
                at += 1
                continue
            keep(begun, at)
            if end < 0:
                break
            at = begun = end + 1
            continue
        keep(begun, at)
        end = _closed(page, m.end()) if quotes else page.find(">", m.end())
        if end == -2 or (quotes and end == -1):
            # From here on quotes are plain characters, which a search for ">" alone settles.
            quotes = False
            end = page.find(">", m.end())
        if end < 0:
            break
        closing, tag, attributes = m[1], m[2].lower(), page[m.end() : end]
        at = begun = end + 1
        if not closing and tag in _CLOSING:
            after = _CLOSING[tag].search(page, at)
            end = page.find(">", after.start()) if after else -1
            if end < 0:
                break
            at = begun = end + 1
            continue
        if tag in _BLOCKS:
            flush()
        elif tag == "br":
            (dropped_ if dropped else wanted).append(" ")
        if tag in _VOID:
            continue
        if closing:
            if depth.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if stack and (stack[-1][0] == "p" and tag in _BLOCKS or stack[-1][0] == tag and tag in _SIBLINGS):
            pop()
        # Other elements may be left open; they only count where they are unwanted.
        unwanted = dropped or _unwanted(tag, attributes, inside)
        if (tag in _HOLDERS or unwanted) and not attributes.endswith("/"):
            dropped, inside = unwanted, inside or (tag in ("article", "main") and not unwanted)
            article = article or (tag == "article" and not unwanted)
            stack.append((tag, dropped, inside, article))
            depth[tag] = depth.get(tag, 0) + 1
    flush()
    return out


def heads(tokens: np.ndarray, salt: np.ndarray, depth: int = RUN) -> np.ndarray:
    """Hash of the first ``depth`` tokens of every suffix that has so many."""
    n = len(tokens) - depth + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for k, p in enumerate(tv.powers(0xD6E8FEB86659FD93, depth)):
            total += tokens[k : k + n] * p
        return tv.mix(total ^ salt[:n])


def _host(url: str | None) -> str:
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _salts(urls: list) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(_host(u).encode(), digest_size=8).digest(), "little") for u in urls], np.uint64)


def _entries(pages: list[list[tuple[int, str]]], salts: np.ndarray) -> list[list[np.ndarray]]:
    """The entries of each page's dropped stream and of its open stream, in order."""
    texts = [t for page in pages for _, t in page]
    tokens, block, _ = tv.words(*reversed(tv.utf8(pa.array(texts, pa.large_string()))), lower=False)
    zone = np.array([z for page in pages for z, _ in page], np.int64)
    owner = np.repeat(np.arange(len(pages)), [len(page) for page in pages])
    streams = []
    for kind in (DROPPED, OPEN):
        chosen = np.flatnonzero(zone[block] == kind)
        of = owner[block[chosen]]
        found = heads(tokens[chosen], salts[of])
        whole = of[: len(found)] == of[len(of) - len(found) :]
        cut = np.searchsorted(of[: len(found)][whole], np.arange(len(pages) + 1))
        found = found[whole].view(np.int64)
        streams.append([found[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)])
    return streams


_PARSED = "page_id long, url string, host long, zones array<tinyint>, texts array<string>, dropped array<long>, open array<long>"
_TEXTS = "page_id long, url string, text string, n_chars long"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int8()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64()))

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        ids, urls, pages = zip(*rows, strict=True)
        salts = _salts(list(urls))
        dropped, open_ = _entries(list(pages), salts)
        columns = (ids, urls, salts.view(np.int64).tolist(), [[z for z, _ in p] for p in pages], [[t for _, t in p] for p in pages], [np.unique(x) for x in dropped], open_)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "url", "host", "zones", "texts", "dropped", "open"])

    for whole in batches:
        rows, size = [], 0
        for i, url, page in zip(whole.column(0), whole.column(1), whole.column(2), strict=True):
            page = page.as_py() or ""
            rows.append((i.as_py(), url.as_py(), blocks(page)))
            size += len(page)
            if size > tv.BLOCK_BYTES:
                yield sent(rows)
                rows, size = [], 0
        if rows:
            yield sent(rows)


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts from (page_id, url, zones, texts, marks): marks are where repeated runs of the open stream begin."""
    for batch in batches:
        found = []
        for zones, texts, marks in zip(*(batch.column(k).to_pylist() for k in range(2, 5)), strict=True):
            size = [len(t.split(" ")) if z == OPEN else 0 for z, t in zip(zones, texts, strict=True)]
            change = np.zeros(sum(size) + RUN, np.int64)
            starts = np.array(marks or [], np.int64)
            change[starts] += 1
            change[starts + RUN] -= 1
            covered = np.cumsum(change) > 0
            kept, at = [], 0
            for z, t, n in zip(zones, texts, size, strict=True):
                if z == ARTICLE or z == OPEN and 2 * int(covered[at : at + n].sum()) <= n:
                    kept.append(t)
                at += n
            found.append("\n\n".join(kept or [t for z, t in zip(zones, texts, strict=True) if z == OPEN]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(page_id, url, text, n_chars), one row for each row of df.

    Pages are parsed once and kept in the shared folder; entries of the array
    are shuffled, texts only if more than ``broadcast_rows`` pages are marked.
    """
    spark = df.sparkSession
    named = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    at = scratch(spark, "pages")
    open_text = F.transform(F.filter(F.arrays_zip("zones", "texts"), lambda b: b.zones == OPEN), lambda b: b.texts)
    # Numbered when written, so that a row has one number for all that follows.
    whole = named.mapInArrow(_parsed, _PARSED).select("*", F.monotonically_increasing_id().alias("row"), F.xxhash64("url", "zones", "texts").alias("page"), F.xxhash64(open_text).alias("content"))
    whole.write.option("compression", "zstd").parquet(f"{at}/parsed")
    parsed = spark.read.schema(whole.schema).parquet(f"{at}/parsed")

    # Pages of one content are one page; of these the first row stands for all.
    first = parsed.groupBy("host", "content").agg(F.min("row").alias("row"))
    pages = few(first.groupBy("host").agg(F.count("*").alias("pages")), broadcast_rows)
    some = parsed.select("host", "page", F.explode("dropped").alias("head"), F.lit(True).alias("markup"))
    more = parsed.join(first.select("row"), "row", "left_semi").select("host", F.lit(0).cast("long").alias("page"), F.explode(F.array_distinct("open")).alias("head"), F.lit(False).alias("markup"))
    ends = [f(F.when(F.col("markup"), F.col("page"))).alias(n) for n, f in (("d0", F.min), ("d1", F.max))]
    array = some.unionByName(more).groupBy("host", "head").agg(*ends, F.count_if(~F.col("markup")).alias("held"))
    enough = (F.col("held") >= LEAST) & (F.col("held") >= SHARE * F.col("pages"))
    repeated = array.where((F.col("d0") != F.col("d1")) | (F.col("held") >= LEAST)).join(pages, "host").where((F.col("d0") != F.col("d1")) | enough).select("head").distinct()
    starts = parsed.select("row", F.posexplode("open").alias("start", "head"))
    # A line of all pages of a host is one head with many starts: sent to all tasks while that is proven small.
    marked = starts.join(few(repeated, broadcast_rows), "head").groupBy("row").agg(F.collect_list("start").alias("marks"))
    marked.write.parquet(f"{at}/marked")
    marked = spark.read.schema(marked.schema).parquet(f"{at}/marked")
    if marked.count() <= broadcast_rows:
        marked = F.broadcast(marked)
    out = parsed.join(marked, "row", "left").select("page_id", "url", "zones", "texts", "marks").mapInArrow(_decided, _TEXTS)
    return out.withColumnRenamed("page_id", id_col).withColumnRenamed("url", url_col)
