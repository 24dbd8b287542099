"""Main text of web pages: page structure first, a suffix array per host for what structure does not tell.

A page is cut into blocks of text. Elements that are menus, headers, footers, sidebars, notices,
adverts, forms, comments or not text at all are left out with all they hold, by tag, role, and
the names of class and id. If the page marks its article (``article``, else ``main``), the blocks in
it are the text.

Every page is also read as a stream of words, and the streams of its host are searched
for long substrings shared by its pages: suffixes, cut to ``RUN`` words, are sorted by
Spark, and neighbours with equal ``RUN`` words on pages of different content are a repeat. On a page that
marks no article, words covered by one are boilerplate; the unique runs stay. A suffix is a hash, so host and position
cost a few bytes, and equal suffixes of a batch are combined before the shuffle: a host with a
third of all pages is spread over all tasks.

Copies of an article and passages that articles share are text, so in a marked article a repeat is boilerplate
only if it is on half of the host's pages with a marked article, ``HOST_PAGES`` at least, and then only as whole
blocks, of pages that have as many words besides; pages that have not are copies. Suffixes that
can be on half of the pages are found first: of the ``RUN`` words the half of smallest hash
stands for them, and a batch sends only what is on half of its own pages of the host. What is sent
thus grows with the hosts of a batch rather than with its words.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import Powers, Words, blocks, shingle_hashes, stage

#: Words that a repeated substring has at least.
RUN = 10
#: Pages of the host that a run is on at least to be boilerplate in a marked article.
HOST_PAGES = 4

# fixed values: element names and the words of class, id and role that mark what is not the article
SKIP_TAGS = frozenset("nav footer aside form script style noscript template iframe svg math button select textarea head title "
                      "menu dialog object canvas audio video map".split())
RAW_TAGS = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "template"))
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE_TAGS = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                        "samp small span strike strong sub sup time tt u var wbr".split())
SKIP_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar topbar masthead footer sidebar "
    "aside widget ad ads adsense advert adverts advertisement advertising banner promo promotion sponsor sponsored "
    "notice cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login form search "
    "share sharing social related recommended comment comments commentlist reply replies respond disqus".split())
HEADER_WORDS = frozenset(("header", "siteheader", "pageheader"))
#: Words that may stand beside those in one class name or id; any other word makes it a name of its own.
COMPANIONS = frozenset("site page main top bottom left right primary secondary global mobile desktop container wrapper box "
                       "block area bar inner outer list item items link links button buttons icons widgets".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
SKIP_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu",
                        "alertdialog", "menubar", "toolbar"))

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:_-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([A-Za-z_:][\w:.-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW_TAGS}
OTHER = re.compile(r"[^a-z0-9]+")


#: Elements whose end tag may be missing: the open ones that a start tag ends, and the ones it does not look beyond.
CELLS, PARTS = frozenset(("td", "th")), frozenset(("thead", "tbody", "tfoot"))
LISTS = frozenset("ul ol menu dl table td th article main section nav aside body select".split())
ENDED_BY = {"li": (frozenset(("li",)), LISTS), **dict.fromkeys(("dt", "dd"), (frozenset(("dt", "dd")), LISTS)),
            "option": (frozenset(("option",)), frozenset(("select", "datalist"))), "tr": (frozenset(("tr",)), frozenset(("table",))),
            **dict.fromkeys(CELLS, (CELLS, frozenset(("tr", "table")))), **dict.fromkeys(PARTS, (PARTS, frozenset(("table",))))}
TABLE_TAGS = frozenset(("table", "tr", "caption", "colgroup", *CELLS, *PARTS))
#: What a head may hold; any other start tag ends it.
HEAD_TAGS = frozenset("head title meta link base script style noscript template".split())


def nearest(open_tags: list[str], wanted: frozenset[str], beyond: frozenset[str]) -> int:
    """Place of the innermost open element among ``wanted``, not looking beyond some; -1 if there is none."""
    for i in range(len(open_tags) - 1, -1, -1):
        if open_tags[i] in wanted:
            return i
        if open_tags[i] in beyond:
            return -1
    return -1


def ended(open_tags: list[str], closing: bool, tag: str) -> int:
    """Place of the outermost element that a tag ends; their number if it ends none."""
    if closing:
        if tag not in open_tags:
            return len(open_tags)
        if tag in INLINE_TAGS:  # does not reach out of a block
            at = len(open_tags) - 1
            while at >= 0 and open_tags[at] != tag:
                at = at - 1 if open_tags[at] in INLINE_TAGS else -1
        else:
            at = nearest(open_tags, frozenset((tag,)), frozenset(("table",)) if tag in TABLE_TAGS else frozenset(("table", "td", "th", "caption"))
                         if tag not in ("body", "html") else frozenset())
        return at if at >= 0 else len(open_tags)
    if tag in INLINE_TAGS or tag in VOID_TAGS:
        return len(open_tags)
    found = []
    if "p" in open_tags:
        found.append(nearest(open_tags, frozenset(("p",)), TABLE_TAGS | {"button", "object"}))
    if tag in ENDED_BY:
        found.append(nearest(open_tags, *ENDED_BY[tag]))
    if tag not in HEAD_TAGS and "head" in open_tags:
        found.append(nearest(open_tags, frozenset(("head",)), frozenset(("body",))))
    return min([f for f in found if f >= 0], default=len(open_tags))


def telling(name: str, words: frozenset[str]) -> bool:
    """Whether a class name or id is one of the words, or begins or ends with one beside companions only."""
    parts = [w for w in OTHER.split(name) if w and not w.isdigit()]
    return bool(parts) and (parts[0] in words or parts[-1] in words) and all(w in words or w in COMPANIONS for w in parts)


def left_out(tag: str, attributes: str, in_article: bool) -> str | None:
    """Why an element is not part of an article: ``kind`` by its tag, role or names, ``hidden`` if it is not shown."""
    kind = tag in SKIP_TAGS or (tag == "header" and not in_article)
    if not attributes.strip() or tag in ("html", "body"):
        return "kind" if kind else None
    words = SKIP_WORDS if in_article or tag == "article" else SKIP_WORDS | HEADER_WORDS
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and HIDDEN.search(value)):
            return "hidden"
        if name in ("class", "id") and tag not in HEADINGS:
            kind = kind or any(telling(n, words) for n in (value.split() if name == "class" else [value]))
        elif name == "role":
            kind = kind or value in SKIP_ROLES
    return "kind" if kind else None


def read_blocks(page: str | None) -> tuple[list[str], bool]:
    """Blocks of text in page order, and whether they come from a marked article.

    An element that holds the page's ``main``, or an ``article`` where none stands elsewhere, is not left out for its kind.
    """
    page, holders = page or "", frozenset()
    while True:
        parts, marked, around = blocks_but(page, holders)
        if not around["main"] and (marked or not around["article"]):
            return parts, marked
        holders |= around["main"] or around["article"]


def blocks_but(page: str, holders: frozenset[int]) -> tuple[list[str], bool, dict[str, set[int]]]:
    """:func:`read_blocks` with the elements that begin at ``holders`` not left out, and where elements
    begin that were left out for their kind with an article or main inside."""
    around: dict[str, set[int]] = {"article": set(), "main": set()}
    began: int | None = None
    plain: list[str] = []
    marked: dict[str, list[str]] = {"article": [], "main": []}
    seen = {"article": False, "main": False}
    depth = {"article": 0, "main": 0}
    parts: list[str] = []
    open_tags: list[str] = []
    skipped: int | None = None  # place in open_tags of the element that is left out

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            plain.append(text)
            for k, d in depth.items():
                if d:
                    marked[k].append(text)

    at, end = 0, len(page)
    while at < end:
        m = MARKUP.search(page, at)
        if skipped is None:
            parts.append(page[at:m.start() if m else end])
        if m is None:
            break
        at = m.end()
        if m.group(2) is None:
            continue
        closing, tag, attributes = bool(m.group(1)), m.group(2).lower(), m.group(3)
        if skipped is not None:
            # inside an element that is left out, to its own end, an ancestor's, or the start of what ends it
            last = ended(open_tags, closing, tag)
            if last > skipped:
                del open_tags[last:]
                if closing:
                    continue
                if tag in around and began is not None:
                    around[tag].add(began)
                if tag in RAW_TAGS:
                    stop = RAW_END[tag].search(page, at)
                    at = stop.end() if stop else end
                elif tag not in VOID_TAGS and not attributes.endswith("/"):
                    open_tags.append(tag)
                continue
            own = last == skipped and closing
            del open_tags[skipped:]
            skipped = None
            if own:
                continue
        if tag not in INLINE_TAGS:
            flush()
        elif tag == "br":
            parts.append(" ")
        last = ended(open_tags, closing, tag)
        for t in open_tags[last:]:
            if t in depth:
                depth[t] -= 1
        del open_tags[last:]
        if closing:
            continue
        in_article = depth["article"] > 0 or depth["main"] > 0
        if tag in VOID_TAGS:
            continue
        why = left_out(tag, attributes, in_article)
        if why and not (why == "kind" and m.start() in holders):
            if tag in INLINE_TAGS:
                parts.append(" ")
            if tag in RAW_TAGS:
                stop = RAW_END[tag].search(page, at)
                at = stop.end() if stop else end
            elif not attributes.endswith("/"):
                skipped = len(open_tags)
                open_tags.append(tag)
                began = m.start() if why == "kind" and not in_article else None
            continue
        if tag in depth:
            depth[tag] += 1
            seen[tag] = True
        if not attributes.endswith("/") or tag in depth:
            open_tags.append(tag)
    flush()
    for k in ("article", "main"):
        if seen[k]:
            return marked[k], True, around
    return plain, False, around


def parse(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, node, host, html) with ``parts`` and ``marked`` instead of html."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [read_blocks(t) for t in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([g[0] for g in got], pa.list_(pa.string())),
                 pa.array([g[1] for g in got], pa.bool_())], names=["page_id", "url", "node", "host", "parts", "marked"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "node", "host", "html").mapInArrow(
        run, f"page_id {kind}, url string, node long, host string, parts array<string>, marked boolean")


def suffixes(streams: DataFrame) -> DataFrame:
    """``(host, key, low, high)`` of ``streams`` (host, content, text): per batch and suffix the least and
    greatest content digest of the pages it is on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            hosts, content = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found: dict[tuple[str, int], list[int]] = {}
            for lo, _, data, offsets in blocks(batch.column(2)):
                words = Words(data, offsets)
                for k, keys in enumerate(shingle_hashes(words, words.hashes(powers, lower=False), RUN)):
                    if words.first[k + 1] - words.first[k] < RUN:
                        continue
                    host, mine = hosts[lo + k], content[lo + k]
                    for key in np.unique(keys.view(np.int64)).tolist():
                        pair = found.setdefault((host, key), [mine, mine])
                        pair[0], pair[1] = min(pair[0], mine), max(pair[1], mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in found], pa.string()), pa.array([k for _, k in found], pa.int64()),
                 pa.array([p[0] for p in found.values()], pa.int64()), pa.array([p[1] for p in found.values()], pa.int64())],
                names=["host", "key", "low", "high"])

    return streams.mapInArrow(run, "host string, key long, low long, high long")


def _windows(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, keys, anchors) of the texts with ``RUN`` words or more: per window of ``RUN`` words its hash, and the
    smallest hash of half as many words in it, which windows of equal words share."""
    powers, half = Powers(), RUN // 2
    for lo, _, data, offsets in blocks(texts):
        words = Words(data, offsets)
        hashes = words.hashes(powers, lower=False)
        for k, (keys, parts) in enumerate(zip(shingle_hashes(words, hashes, RUN), shingle_hashes(words, hashes, half))):
            if words.first[k + 1] - words.first[k] >= RUN:
                least = np.lib.stride_tricks.sliding_window_view(parts.view(np.int64), RUN - half + 1).min(axis=1)
                yield lo + k, keys.view(np.int64), least


def frequent_anchors(streams: DataFrame) -> DataFrame:
    """``(host, pages, keys)`` of ``streams`` (host, text): anchors that half of a host's pages can hold, and its number of pages.

    An anchor on half of all pages is on half of the pages of some batch, so a batch leaves out the others. Its
    ``n`` pages may hold one left out ``(n + 1) // 2 - 1`` times, which is added to the counts sent.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = batch.column(0).to_pylist()
            found: dict[str, list[np.ndarray]] = {}
            pages: dict[str, int] = {}
            for host in hosts:
                pages[host] = pages.get(host, 0) + 1
            for row, _, anchors in _windows(batch.column(1)):
                found.setdefault(hosts[row], []).append(np.unique(anchors))
            for host, n in pages.items():
                keys, counts = np.unique(np.concatenate(found.get(host, [np.zeros(0, np.int64)])), return_counts=True)
                slack = (n + 1) // 2 - 1
                keys, counts = keys[counts > slack], counts[counts > slack]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * (len(keys) + 1), pa.string()), pa.array([None, *keys.tolist()], pa.int64()),
                     pa.array([n, *counts.tolist()], pa.int64()), pa.array([slack] * (len(keys) + 1), pa.int64())],
                    names=["host", "key", "n", "slack"])

    sums = streams.mapInArrow(run, "host string, key long, n long, slack long").groupBy("host", "key").agg(
        F.sum("n").alias("n"), F.sum("slack").alias("slack"))
    # rows without a key count the pages; they come to each host's anchors by a second sum
    whole = sums.where("key is null").selectExpr("host", "n as pages", "slack as whole")
    return (sums.where("key is not null").join(whole, "host")
            .where(f"n + whole - slack >= greatest({HOST_PAGES}, pages / 2)")
            .groupBy("host", "pages").agg(F.collect_set("key").alias("keys")))


def host_runs(pages: DataFrame) -> DataFrame:
    """``(host, runs)`` of ``pages`` (host, pages, keys, content, text): suffixes on half of the host's pages, by exact counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, wanted, content = batch.column(0).to_pylist(), batch.column(2), batch.column(3).to_pylist()
            found: dict[tuple[str, int], list[int]] = {}
            for row, keys, anchors in _windows(batch.column(4)):
                hit = np.isin(anchors, np.asarray(wanted[row].values))
                for key in np.unique(keys[hit]).tolist():
                    cell = found.setdefault((hosts[row], key), [0, content[row], content[row]])
                    cell[0], cell[1], cell[2] = cell[0] + 1, min(cell[1], content[row]), max(cell[2], content[row])
            of = dict(zip(hosts, batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in found], pa.string()), pa.array([of[h] for h, _ in found], pa.int64()),
                 pa.array([k for _, k in found], pa.int64()),
                 *[pa.array([c[i] for c in found.values()], pa.int64()) for i in range(3)]],
                names=["host", "pages", "key", "n", "low", "high"])

    counted = pages.mapInArrow(run, "host string, pages long, key long, n long, low long, high long")
    return (counted.groupBy("host", "pages", "key").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
            .where(f"n >= greatest({HOST_PAGES}, pages / 2) and low < high").groupBy("host").agg(F.collect_set("key").alias("runs")))


def without_runs(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)`` of ``pages`` (page_id, url, parts, runs): blocks that runs of the host cover left
    out, unless they hold more than half of the words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, runs = batch.column(2).to_pylist(), batch.column(3)
            for row, keys, _ in _windows(pa.array([" ".join(p) for p in lists], pa.large_string())):
                if runs[row].as_py() is None:
                    continue
                sizes = [len(p.encode("utf-8", "surrogatepass").split()) for p in lists[row]]
                edge = np.zeros(sum(sizes) + 1, dtype=np.int32)
                hit = np.flatnonzero(np.isin(keys, np.asarray(runs[row].values)))
                np.add.at(edge, hit, 1)
                np.add.at(edge, hit + RUN, -1)
                covered = np.cumsum(edge[:-1]) > 0
                ends = np.cumsum(sizes)
                whole = [bool(covered[end - n:end].all()) for n, end in zip(sizes, ends.tolist())]
                if 2 * covered.sum() <= len(covered):
                    lists[row] = [p for p, w in zip(lists[row], whole) if not w]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(["\n".join(p) for p in lists], pa.string())], names=["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(run, f"page_id {kind}, url string, text string")


def marked_text(read: DataFrame) -> DataFrame:
    """``(page_id, url, text)`` of the pages of ``read`` that mark their article, without what half of their host's pages repeat."""
    plain = read.select("page_id", "url", F.array_join("parts", "\n").alias("text"))
    stream = F.array_join("parts", " ")
    anchors = stage(frequent_anchors(read.select("host", stream.alias("text"))), "html-anchors")
    if anchors.isEmpty():
        return plain
    runs = stage(host_runs(read.select("host", F.xxhash64(stream).alias("content"), stream.alias("text")).join(anchors, "host")
                           .select("host", "pages", "keys", "content", "text")), "html-runs")
    if runs.isEmpty():
        return plain
    return without_runs(read.join(runs, "host", "left").select("page_id", "url", "parts", "runs"))


def unique_runs(pages: DataFrame) -> DataFrame:
    """``(node, text)`` of ``pages`` (node, parts, keys): words covered by a repeated suffix (``keys``) removed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            out = []
            for parts, keys in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if keys:
                    stream = " ".join(parts)
                    for _, _, data, offsets in blocks(pa.array([stream], pa.large_string())):
                        words = Words(data, offsets)
                        own = shingle_hashes(words, words.hashes(powers, lower=False), RUN)[0].view(np.int64)
                    edge = np.zeros(len(words.start) + 1, dtype=np.int32)
                    hit = np.flatnonzero(np.isin(own, np.array(keys, np.int64)))
                    np.add.at(edge, hit, 1)
                    np.add.at(edge, hit + RUN, -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    at, kept = 0, []
                    for part in parts:
                        n = len(part.encode("utf-8", "surrogatepass").split())
                        left = [w for w, s in zip(_ascii_words(part), stays[at:at + n]) if s]
                        at += n
                        if left:
                            kept.append(" ".join(left))
                    parts = kept
                out.append("\n".join(parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["node", "text"])

    return pages.mapInArrow(run, "node long, text string")


def _ascii_words(text: str) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text per page: ``(page_id, url, text)``, one row per input row; text is empty where there is none.

    NULL html is an empty page; a NULL url is a host of its own. Blocks are joined by a line
    feed; inside a block character references are decoded and white space is one space. Equal
    pages count as one page for the search. Other columns are not read. An empty table gives an
    empty result.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    node = F.xxhash64(F.col("page_id").cast("string"), "url", "html")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    read = stage(parse(rows.withColumns({"node": node, "host": host})), "html-blocks")
    marked = marked_text(read.where("marked"))
    unmarked = read.where("not marked")
    if unmarked.isEmpty():
        return marked

    open_ = unmarked.select("node", "host", "parts").dropDuplicates(["node"])
    stream = F.array_join("parts", " ")
    streams = open_.select("host", F.xxhash64(stream).alias("content"), stream.alias("text"))
    shared = (suffixes(streams).groupBy("host", "key").agg(F.min("low").alias("low"), F.max("high").alias("high"))
              .where("low < high").select("host", "key"))
    # the same suffixes per page: a page takes the place of the host
    own = suffixes(open_.select(F.col("node").cast("string").alias("host"), F.lit(0).cast("long").alias("content"),
                                stream.alias("text"))).select(F.col("host").cast("long").alias("node"), "key")
    hits = (own.join(open_.select("node", "host"), "node").join(shared, ["host", "key"])
            .groupBy("node").agg(F.collect_set("key").alias("keys")))
    opened = unique_runs(open_.select("node", "parts").join(hits, "node", "left").select("node", "parts", "keys"))
    return marked.unionByName(unmarked.select("page_id", "url", "node").join(opened, "node")
                              .select("page_id", "url", "text"))
