"""Main text of web pages: what markup does not settle, suffix arrays over a host's pages decide."""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopolis.llm.common import lean, materialize, pieces, remove, scratch
from thermopolis.llm.wordsuffixes import BLOCK, shared_suffixes

#: Words of a host's pages that one suffix array holds; a larger host gets several.
SHARD_WORDS = 2 << 20
PIECE = 4 << 20
#: With fewer pages of a host no passage is in the frames of over half of them and not in that of another.
FRAME_PAGES = 3
#: Places up to so many bytes are broadcast to the pages; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20

# Element and class names as pages use them.
#: Elements inside a block; all others end it. ``br`` is white space.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big blink br cite code data del dfn em font i img input ins kbd label mark nobr q rb rp rt rtc ruby"
    " s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
#: Elements whose content is text up to their end tag.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
#: Elements that never hold main text.
FRAME = frozenset(
    "aside audio button canvas datalist dialog footer form head header iframe map menu nav noembed noframes noscript object"
    " select style svg script template textarea title video".split()
)
#: An end tag does not reach elements beyond one of these.
SCOPE = frozenset("caption object table td template th".split())
#: A new element of these ends an open paragraph, and one of SIBLINGS its like.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation note search toolbar".split())
#: Parts of class names and ids of what is not the article.
NAMES = frozenset(
    "ad ads adsense advert advertisement adverts aside banner breadcrumb breadcrumbs comment commentlist comments consent cookie"
    " cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification"
    " pager pagination popup promo promoted recommended related replies reply respond search share sharing sidebar signup social"
    " sponsor sponsored sr subscribe subscription toolbar widget".split()
)
#: Next to these, "header" is the article's own, and a wrapper says what it holds.
OWN = frozenset("article content entry post story".split())
WRAPPER = frozenset("has no with without wrapper".split())

MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s\"'>/=]+)")
PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")
HOST = re.compile(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")

DROP, PLAIN, MAIN, ARTICLE = range(4)


def attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare, alone in ATTRIBUTE.findall(rest):
        found.setdefault((name or alone).lower(), html.unescape(double or single or bare))
    return found


def zone_of(name: str, rest: str, parent: int) -> int:
    """Which part of the page an element belongs to, by its name, attributes and the element around it."""
    if parent == DROP:
        return DROP
    if not rest and name not in FRAME and name not in ("article", "main"):
        return parent
    given = attributes(rest)
    role = given.get("role", "").lower()
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or "display:none" in given.get("style", "").replace(" ", "").lower():
        return DROP
    if role in ROLES or (name in FRAME and not (name == "header" and parent >= MAIN)):
        return DROP
    if name not in ("html", "body", "main"):
        for label in f"{given.get('class', '')} {given.get('id', '')}".split():
            parts = {p.lower() for p in PARTS.findall(label)}
            named = parts & NAMES
            if named and not parts & WRAPPER and not (named == {"header"} and (parts & OWN or parent >= MAIN)):
                return DROP
    if name == "article" or role == "article" or "articlebody" in given.get("itemprop", "").lower():
        return ARTICLE
    return max(parent, MAIN) if name == "main" or role == "main" else parent


def blocks_of(page: str, loose: list[list[str]] | None = None) -> list[tuple[int, str]]:
    """(zone, text) of each block of a page that is not dropped, in page order, without empty ones.

    Text is what stands between tags, with character references decoded and white space, no-break
    space too, as one space. Missing end tags are taken as browsers do; what follows an unclosed comment
    or tag is part of it. All text outside links is added to the list of its zone in ``loose``, that of DROP
    too but for scripts and the like, blocks set apart by white space.
    """
    found: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = [("", PLAIN)]
    open_: dict[str, int] = {}
    zone = PLAIN

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        for pieces_of_zone in loose or ():
            pieces_of_zone.append(" ")
        if text:
            found.append((zone, text))

    def pop(names: tuple[str, ...]) -> None:
        """Close the innermost open one of ``names`` with all inside it, unless out of scope; an inline
        element does not take a block with it."""
        if not any(open_.get(x) for x in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            inner = stack[depth][0]
            if inner in names:
                for name, _ in stack[depth:]:
                    open_[name] -= 1
                del stack[depth:]
                return
            if inner not in INLINE and (names[0] in INLINE or (inner in SCOPE and not SCOPE.intersection(names))):
                return

    at, end = 0, len(page)
    while at < end:
        tag = MARKUP.search(page, at)
        until = tag.start() if tag else end
        if until > at and (loose or stack[-1][1] != DROP):
            text, inside = page[at:until], stack[-1][1]
            text = html.unescape(text) if "&" in text else text
            if inside != DROP:
                parts.append(text)
                zone = inside
            if loose and not open_.get("a"):
                loose[inside].append(text)
        if tag is None:
            break
        at = tag.end()
        if tag["name"] is None:
            continue
        name = tag["name"].lower()
        if name == "br":
            parts.append(" ")
            if loose:
                loose[stack[-1][1]].append(" ")
            continue
        block = name not in INLINE
        if tag["end"]:
            if block:
                flush()
            pop((name,))
            continue
        if block:
            flush()
            if name not in FRAME or name in ("aside", "footer", "form", "header", "menu", "nav", "dialog"):
                pop(("p",))
            if name in SIBLINGS:
                pop(SIBLINGS[name])
        if name in VOID:
            continue
        if name in ("article", "main") and stack[-1][1] == DROP:
            # A missing end tag: no menu or page header holds the article.
            pop(("nav",))
            pop(("header",))
        inner = zone_of(name, tag["rest"], stack[-1][1])
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = close.start() if close else end
        stack.append((name, inner))
        open_[name] = open_.get(name, 0) + 1
    flush()
    return found


def host_of(url: str | None) -> str:
    match = HOST.match(url or "")
    return match[1].lower() if match else ""


def _parse(batches: Iterator[pa.RecordBatch], frames: bool = False) -> Iterator[pa.RecordBatch]:
    """From (id, url, html) to PARSED; ``frame`` is NULL without ``frames``."""
    block = pa.struct([("text", pa.string()), ("first", pa.int32()), ("n", pa.int32())])
    for batch in pieces(batches, 2, PIECE):
        rows = []
        for url, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            loose = [[], [], [], []] if frames else None
            blocks = blocks_of(page or "", loose)
            best = max((zone for zone, _ in blocks), default=PLAIN)
            texts = [text for zone, text in blocks if zone == best]
            sizes = [text.count(" ") + 1 for text in texts]
            listed, first = [], 0
            for text, n in zip(texts, sizes, strict=True):
                listed.append({"text": text, "first": first, "n": n})
                first += n
            kept = "open" if best == PLAIN else "marked"
            key = hashlib.blake2b("\n".join([kept, *texts]).encode(), digest_size=16).hexdigest()
            frame = " ".join("".join(x) for x in loose[:best]).split() if frames else []
            rows.append((host_of(url), key, best == PLAIN, first, listed, " ".join(frame) if frames else None, len(frame)))
        host, key, is_open, n_words, listed, frame, n_frame = zip(*rows, strict=True) if rows else ((),) * 7
        columns = [
            batch.column(0), batch.column(1), pa.array(host, pa.string()), pa.array(key, pa.string()),
            pa.array(is_open, pa.bool_()), pa.array(n_words, pa.int64()), pa.array(listed, pa.list_(block)),
            pa.array(frame, pa.string()), pa.array(n_frame, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["id", "url", "host", "key", "is_open", "n_words", "blocks", "frame", "n_frame"])


PARSED = (
    "url string, host string, key string, is_open boolean, n_words long,"
    " blocks array<struct<text: string, first: int, n: int>>, frame string, n_frame long"
)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (host, shard, shards, key, text, frame, pages), a host's shard together, to what its suffix array
    shows; texts and frames are apart in it.

    ``starts`` of a ``key``: where BLOCK words begin that the text of another page of the shard has as well.
    Of a host with several shards also a row for each different beginning of BLOCK words of a text: its
    digest, and page and place if only one page of the shard has it. ``passage``: BLOCK words in the frames
    of most pages of the shard. What most of a host's pages have, most pages of one of its shards have.
    """
    schema = pa.schema(
        [("host", pa.string()), ("key", pa.string()), ("starts", pa.list_(pa.int32())), ("digest", pa.binary()), ("start", pa.int32()),
         ("passage", pa.string())]
    )

    def search(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        number, scopes = {}, {}
        # Two streams a page, its text and its frame.
        streams = [stream for row in rows for stream in row[4:6]]
        parts = [np.array([number.setdefault(w, len(number)) for w in stream.split()], np.int32) for stream in streams]
        sizes = np.array([len(x) for x in parts], np.int64)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        shard = np.array([scopes.setdefault(r[:2], len(scopes)) for r in rows])
        scope = np.repeat((2 * shard[:, None] + (0, 1)).ravel(), sizes)
        page = np.repeat(np.arange(len(streams)), sizes)
        words = np.concatenate(parts)
        array, first, rank = shared_suffixes(words, np.repeat(bounds[1:], sizes), scope)
        # The least and greatest page of each group of suffixes with one beginning.
        least, most = np.full(len(array), len(streams)), np.full(len(array), -1)
        np.minimum.at(least, first, page[array])
        np.maximum.at(most, first, page[array])
        shared = np.zeros(len(words), bool)
        shared[array] = (least != most)[first]
        out = {name: [] for name in schema.names}

        def add(host, key=None, starts=None, digest=None, start=None, passage=None):
            for name, value in zip(schema.names, (host, key, starts, digest, start, passage), strict=True):
                out[name].append(value)

        def beginning(at) -> str:
            return " ".join(spelling[w] for w in words[at : at + BLOCK].tolist())

        spelling = list(number)
        in_shard = np.bincount(shard)
        framed = page[array] % 2 == 1
        pairs = np.unique(first[framed] * len(streams) + page[array[framed]])
        group, n_pages = np.unique(pairs // len(streams), return_counts=True)
        most_pages = 2 * n_pages > in_shard[shard[page[array[group]] // 2]]
        for at in array[group[most_pages]].tolist():
            row = rows[page[at] // 2]
            if row[6] >= FRAME_PAGES:
                add(row[0], passage=beginning(at))
        for i, (host, _, shards, key, _, _, in_host) in enumerate(rows):
            if in_host >= FRAME_PAGES and in_shard[shard[i]] == 1:
                # The only page of its shard.
                for passage in {beginning(at) for at in range(bounds[2 * i + 1], bounds[2 * i + 2] - BLOCK + 1)}:
                    add(host, passage=passage)
            low, high = bounds[2 * i], bounds[2 * i + 1]
            starts = np.flatnonzero(shared[low:high])
            if len(starts):
                add(host, key, starts.tolist())
            if shards == 1:
                continue
            for at in range(low, high - BLOCK + 1):
                # Of a beginning that several pages share the first one stands for all.
                group = rank[at] < len(array)
                if not (group and shared[at]) or array[rank[at]] == at:
                    digest = hashlib.blake2b(beginning(at).encode(), digest_size=16).digest()
                    add(host, None if shared[at] else key, None, digest, None if shared[at] else int(at - low))
            if len(out["host"]) > 50_000:
                yield pa.RecordBatch.from_pydict(out, schema)
                for column in out.values():
                    column.clear()
        yield pa.RecordBatch.from_pydict(out, schema)

    rows, words, last = [], 0, None
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            if words >= SHARD_WORDS and row[:2] != last:
                yield from search(rows)
                rows, words = [], 0
            rows.append(row)
            words, last = words + row[4].count(" ") + row[5].count(" ") + BLOCK, row[:2]
    if rows:
        yield from search(rows)


def host_pages(parsed: DataFrame) -> DataFrame:
    """(host, key, n_words, text, frame): a host's pages, those of one key once. All that markup leaves out is
    their ``frame``, links apart, as they repeat the titles of other pages; what it leaves open, if it can hold a
    passage, is their ``text``. Of equal texts with different frames the greatest frame stands for all."""
    is_open = F.expr(f"is_open and n_words >= {BLOCK}")
    pages = parsed.select(
        "host", "key",
        (F.when(is_open, F.col("n_words")).otherwise(0) + F.col("n_frame") + BLOCK).alias("n_words"),
        F.when(is_open, F.array_join(F.transform("blocks", lambda b: b.text), " ")).otherwise("").alias("text"),
        "frame",
    )
    return pages.groupBy("host", "key").agg(*(F.max(c).alias(c) for c in ("n_words", "text", "frame")))


def repeated(pages: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """What ``_repeats`` finds in the suffix arrays over ``host_pages``.

    A host's pages are dealt into shards of about ``shard_words`` words by their digest, each with a
    suffix array of its own. Beginnings that one shard does not repeat meet those of the host's other
    shards by a digest: one row for each page and beginning, and one for each beginning that a shard
    repeats, so a passage on all pages of a host is a row of each shard.
    """
    sizes = pages.groupBy("host").agg(F.ceil(F.sum("n_words") / shard_words).alias("shards"), F.count(F.lit(1)).alias("pages"))
    dealt = pages.join(sizes, "host").withColumn("shard", F.pmod(F.xxhash64("key"), F.col("shards")))
    dealt = dealt.repartition("host", "shard").sortWithinPartitions("host", "shard")
    dealt = dealt.select("host", "shard", "shards", "key", "text", "frame", "pages")
    schema = "host string, key string, starts array<int>, digest binary, start int, passage string"
    return dealt.mapInArrow(lean(_repeats), schema)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The id, url, main ``text`` and its code points ``n_chars`` of every row of ``pages``.

    Markup comes first. Elements for menus, headers, footers, asides, forms, scripts, hidden content
    and those whose class or id names adverts, notices, comments and the like are left out. Of what is
    left the ``article`` elements are the text, without any ``main``, without that all of it: then the
    page is open.

    Suffix arrays over the words of all pages of a host, of what markup leaves out and of what it leaves
    open, then find passages of BLOCK or more words, and a block of any page goes if at least half of its
    words lie in passages against it; blocks with their own words stay. On open pages these are the passages
    that a different open page shares. On all pages they are the host's frame: passages that markup leaves
    out, outside links, of over half of the host's different pages, while this one has them in its text alone. Against
    an article or main element they count if two different pages have them so, as articles may be
    announced elsewhere.

    An article stays whole however many articles and open pages share it. Blocks are separated by one
    newline, white space inside a block is one space, ``br`` too.

    Defined results: NULL, empty and text-less pages have an empty text; repeated rows come out once each
    and count as one page, as do pages with equal text; pages without a host in their url (NULL too) are
    pages of one host; a NULL id passes; other columns are ignored whatever their names.
    """
    spark = pages.sparkSession
    pages = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    kind = pages.schema["id"].dataType.simpleString()
    parsed = pages.mapInArrow(lean(partial(_parse, frames=True)), f"id {kind}, {PARSED}")
    starts = _starts(parsed, scratch(spark, "extract"))
    rows, words = starts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("starts")), F.lit(0))).first()
    if 200 * rows + 4 * words <= BROADCAST_BYTES:
        starts = F.broadcast(starts)
    parsed = pages.mapInArrow(lean(_parse), f"id {kind}, {PARSED}")
    joined = parsed.join(starts, ["host", "key"], "left").select("id", "url", "blocks", "starts")
    found = joined.mapInArrow(lean(_cut), f"id {kind}, url string, text string")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))


def _starts(parsed: DataFrame, folder: str) -> DataFrame:
    """(host, key, starts): every place of a page's text where BLOCK words begin that speak against it: those of
    an open page that stand on another, different open page of its host, and those of the host's frame."""
    spark = parsed.sparkSession
    try:
        host_pages(parsed).write.parquet(f"{folder}/pages")
        pages = spark.read.parquet(f"{folder}/pages")
        repeated(pages).write.parquet(f"{folder}/found")
        found = spark.read.parquet(f"{folder}/found")
        single = found.where("digest is not null")
        again = single.groupBy("host", "digest").agg(
            (F.count("key") < F.count(F.lit(1))).alias("marked"), F.min("key").alias("least"), F.max("key").alias("most")
        )
        again = again.where("marked or least <> most").select("host", "digest")
        across = single.where("key is not null").join(again, ["host", "digest"]).select("host", "key", F.array("start").alias("starts"))
        starts = found.where("starts is not null").select("host", "key", "starts").unionByName(across)
        passages = found.where("passage is not null").select("host", "passage").distinct()
        if not passages.isEmpty():
            starts = starts.unionByName(_framed(parsed, pages, passages, f"{folder}/hits"))
        return materialize(starts.groupBy("host", "key").agg(F.array_sort(F.flatten(F.collect_list("starts"))).alias("starts")))
    finally:
        remove(spark, folder)


def _framed(parsed: DataFrame, pages: DataFrame, passages: DataFrame, folder: str) -> DataFrame:
    """(host, key, starts): where the text of a page has one of ``passages`` (host, passage) that its frame has not
    and the frames of over half of the host's pages have; of pages that are not open, if two pages have it so."""
    total = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = _with_passages(pages.select("host", F.col("frame").alias("text")), passages)
    counts = counts.mapInArrow(lean(_count_passages), "host string, passage string, n long")
    frame = counts.groupBy("host", "passage").agg(F.sum("n").alias("n")).join(total, "host")
    frame = materialize(frame.where("2 * n > pages").select("host", "passage"))
    text = F.array_join(F.transform("blocks", lambda b: b.text), " ")
    hits = _with_passages(parsed.select("host", text.alias("text"), "key", "frame", "is_open"), frame)
    schema = "host string, key string, is_open boolean, passage string, starts array<int>"
    hits.mapInArrow(lean(_find_passages), schema).write.parquet(folder)
    hits = pages.sparkSession.read.parquet(folder)
    again = hits.groupBy("host", "passage").agg((F.min("key") < F.max("key")).alias("again"))
    hits = hits.groupBy("host", "key", "is_open", "passage").agg(F.min("starts").alias("starts"))
    return hits.join(again, ["host", "passage"]).where("is_open or again").select("host", "key", "starts")


def _with_passages(texts: DataFrame, passages: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose host has ``passages``, with these as an array."""
    n_bytes = passages.agg(F.coalesce(F.sum(F.length("passage")), F.lit(0))).first()[0]
    listed = passages.groupBy("host").agg(F.array_sort(F.collect_list("passage")).alias("passages"))
    return texts.join(F.broadcast(listed) if 4 * n_bytes <= BROADCAST_BYTES else listed, "host")


def places_of(text: str, passages: list[str]) -> dict[str, list[int]]:
    """Where each passage of BLOCK words that ``text`` has begins in it."""
    wanted, firsts, found = set(passages), {p.split(" ", 1)[0] for p in passages}, {}
    words = text.split()
    for at, word in enumerate(words):
        if word in firsts and (passage := " ".join(words[at : at + BLOCK])) in wanted:
            found.setdefault(passage, []).append(at)
    return found


def _count_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (host, text, passages) to (host, passage, n): how many texts of a batch have it."""
    for batch in batches:
        counts = Counter((host, p) for host, text, passages in zip(*(c.to_pylist() for c in batch.columns), strict=True) for p in places_of(text, passages))
        columns = [pa.array([h for h, _ in counts], pa.string()), pa.array([p for _, p in counts], pa.string()), pa.array(list(counts.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["host", "passage", "n"])


def _find_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (host, text, key, frame, is_open, passages) to the passages of a text that its frame has not."""
    schema = pa.schema(
        [("host", pa.string()), ("key", pa.string()), ("is_open", pa.bool_()), ("passage", pa.string()), ("starts", pa.list_(pa.int32()))]
    )
    for batch in batches:
        rows = []
        for host, text, key, frame, is_open, passages in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = places_of(text, passages)
            own = places_of(frame, passages) if found else {}
            rows += ((host, key, is_open, p, starts) for p, starts in found.items() if p not in own)
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in rows], schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, url, blocks, starts) to (id, url, text): blocks of which at least half is in a passage go."""
    for batch in batches:
        texts = []
        for blocks, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if starts and blocks:
                edges = np.zeros(blocks[-1]["first"] + blocks[-1]["n"] + 1, np.int64)
                np.add.at(edges, starts, 1)
                np.add.at(edges, np.array(starts) + BLOCK, -1)
                covered = np.concatenate(([0], np.cumsum(np.cumsum(edges) > 0)))
                blocks = [b for b in blocks if 2 * (covered[b["first"] + b["n"]] - covered[b["first"]]) < b["n"]]
            texts.append("\n".join(b["text"] for b in blocks))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])
