"""Main text of web pages: what the markup marks, less what the pages of a host repeat.

A page is read once, tag by tag, into blocks. A block inside an article or main element is main text,
a block inside a menu, footer, sidebar, advert, notice or comment section is not; tag names, roles and
the words of class and id tell. A form, or a container whose class only mentions such a word
("with-sidebar"), is weaker: an article or main element inside it is main text again. Blocks that no
element marks are open.

* Pages are written once, in buckets by (host, slice): a host above `SLICE_BYTES` of html is dealt into
  slices, smaller ones are one. Everything after reads these buckets in place; only run tables are shuffled.
* In each slice the token streams are concatenated and their suffixes sorted to a depth of `RUN` tokens by
  prefix doubling. Neighbours in that order that share RUN tokens form an interval, and the changes of page
  along it count the distinct pages of its run. Every longer repeat is a chain of such runs, so the depth
  loses nothing.
* What stands on a share of a host's pages stands on that share of the pages of one slice at least, so runs
  that are frequent in some slice are all candidates there are; a second look at the slices of large hosts
  counts each candidate on all pages. The result is exact, and no host is ever in one task.
* A run is boilerplate if it stands on at least `LEAST` distinct pages and on `SHARE` of the distinct
  pages of its host. Rarer repeats stay: articles are republished, and quoted. A run on fewer than `SURE`
  pages also stays where such runs cover most of the page's longest block.
* Covered blocks and covered stretches of RUN tokens go, in main text and in open blocks. The result is
  the main text, or main text and open blocks without those that are mostly links where a page marks
  none or little (under a third of the open words) or marks mostly links.

Pages with equal streams count as one page, or a mirrored page would remove itself.
"""

from __future__ import annotations

import html
import re
import zlib
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from recolens.llm.store import bucketed, written
from recolens.llm.tokens import Words, grams, mix, pieces, signed

#: Tokens of a repeated run.
RUN = 8
#: A boilerplate run stands on so many distinct pages, and on this share of the host's.
LEAST, SHARE = 3, 0.25
#: A run on so many pages is boilerplate even where it is most of a page.
SURE = 10
#: Bytes of html in a slice of a host, and so in a task's group.
SLICE_BYTES = 1 << 24

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas textarea xmp noembed noframes".split())
MAIN_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset("nav aside footer head button select dialog menu fieldset header".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar toolbar alert alertdialog dialog".split())
#: Words in class or id that mark what isn't main text.
OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs header masthead footer sidebar widget comment comments commentlist respond "
    "reply disqus cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup login share "
    "sharing social related recommended recommendations popup modal overlay pagination pager toolbar skip copyright "
    "disclaimer".split()
)

#: Of these, words of sections whose own articles are not the page's, wherever they stand in a class ...
CLOSED_WORDS = frozenset("comment comments commentlist respond reply disqus related recommended recommendations".split())
#: ... and those that name such a section if a class consists of them.
SECTION_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored nav navbar navigation menu breadcrumb "
    "breadcrumbs footer sidebar".split()
)
#: A class with one of these tells of the page, not of the element.
STATE_WORDS = frozenset("has with no without open closed enabled disabled".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")

MAIN, OTHER, OPEN = 1, 2, 0
#: Not main text, but for what is marked as such inside; WRAP may hold the whole page.
LOOSE, WRAP = 3, 4


def kind_of_class(value: str) -> tuple[int | None, set[str]]:
    """What a class or id says: OTHER, LOOSE, WRAP or None, and the words that say so."""
    kind, words = None, set()
    for name in value.split():
        own = set(_WORD.findall(name))
        bad = own & OTHER_WORDS
        if not bad:
            continue
        words |= bad
        if not own & STATE_WORDS and (bad & CLOSED_WORDS or (own <= OTHER_WORDS and bad & SECTION_WORDS)):
            return OTHER, bad
        if kind != LOOSE:
            kind = WRAP if own & STATE_WORDS else LOOSE
    return kind, words


def kind_of(tag: str, attributes: str, inside: int) -> int | None:
    """What an element says about its content; None if nothing."""
    if tag in OTHER_TAGS and not (tag == "header" and inside == MAIN):
        return OTHER
    kind = MAIN if tag in MAIN_TAGS else WRAP if tag == "form" else None
    if attributes.strip():
        explicit, loose = kind == MAIN, None
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return OTHER
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return OTHER
            if name == "role":
                if value in OTHER_ROLES:
                    return OTHER
                if value == "form":
                    kind = kind or WRAP
                elif value in ("main", "article"):
                    explicit = True
            elif name == "itemprop":
                if value == "articlebody":
                    explicit = True
            elif name in ("class", "id") and tag not in ("html", "body"):
                said, words = kind_of_class(value)
                # A headed part of an article, such as class="entry-header", still holds its title.
                if said is None or (inside == MAIN and tag not in MAIN_TAGS and words <= {"header"}):
                    continue
                if said == OTHER:
                    return OTHER
                loose = said if loose is None or said == LOOSE else loose
        kind = MAIN if explicit else loose or kind
    return kind


def blocks_of(page: str) -> list[tuple[int, str, int]]:
    """(kind, text, characters of it inside links) of the blocks of a page, in page order."""
    out: list[tuple[int, str, int]] = []
    stack: list[tuple[str, int]] = []  # elements that say something, with what holds inside them
    depth: dict[str, int] = {}
    held: list[str] = []
    linked, in_link, kind, at, end = 0, 0, OPEN, 0, len(page)

    def flush():
        nonlocal linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append((kind, text, min(linked, len(text))))
            held.clear()
        linked = 0

    def text(a: int, b: int):
        nonlocal linked
        if a < b:
            held.append(page[a:b])
            if in_link:
                linked += b - a

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            text(at, end)
            break
        text(at, m.start())
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                found = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = found.end() if found else end
            continue
        block = tag in BLOCK_TAGS
        if block:
            flush()
        if tag == "br":
            held.append(" ")
        elif tag == "a":
            in_link = 0 if closing else 1
        if tag in VOID:
            continue
        if closing:
            if depth.get(tag):
                # The innermost element of this name ends, and all it still holds.
                while True:
                    name, before = stack.pop()
                    depth[name] -= 1
                    if not block:
                        flush()
                    kind = before
                    if name == tag:
                        break
            continue
        if stack and stack[-1][0] == "p" and block:
            # A paragraph ends where the next block begins.
            name, kind = stack.pop()
            depth[name] -= 1
        said = kind_of(tag, attributes, kind)
        if said is not None or depth.get(tag) or tag in ("div", "section"):
            if not block and said is not None:
                flush()
            stack.append((tag, kind))
            depth[tag] = depth.get(tag, 0) + 1
            # Inside what is only loosely marked, main text may be marked again; elsewhere not.
            if said is not None and kind != OTHER:
                if said in (LOOSE, WRAP) and kind in (LOOSE, WRAP, MAIN):
                    said = LOOSE if kind == MAIN or said == LOOSE else kind
                kind = said
    flush()
    # A wrapper around a page that has nothing else says nothing.
    bare = not any(k in (MAIN, OPEN) for k, _, _ in out)
    own = {LOOSE: OTHER, WRAP: OPEN if bare else OTHER}
    return [(own.get(k, k), t, n) for k, t, n in out]


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def sorted_prefixes(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of a token sequence in order of their first `depth` tokens, and the ranks of all
    suffixes; equal ranks mean equal prefixes. Prefix doubling, the last step of any width."""
    _, rank = np.unique(tokens, return_inverse=True)
    width = 1
    while width < depth:
        step = min(width, depth - width)
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-step] = rank[step:] + 1 if step < len(rank) else 0
        _, rank = np.unique(rank.astype(np.int64) * (len(rank) + 2) + ahead, return_inverse=True)
        width += step
    return np.argsort(rank, kind="stable"), rank


def repeated_runs(streams: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Runs of RUN tokens that stand in at least `least` of the streams: their hashes, and in how many.

    Equal runs are neighbours in suffix order. Suffixes of one run keep the order of the streams, so each
    change of stream along an interval is one more stream."""
    none = np.zeros(0, np.int64)
    if not streams:
        return none, none
    tokens = np.concatenate(streams)
    stream = np.repeat(np.arange(len(streams)), [len(s) for s in streams])
    # A run may not reach into the next stream.
    whole = np.concatenate([np.arange(len(s)) <= len(s) - RUN for s in streams])
    order, _ = sorted_prefixes(tokens, RUN)
    order = order[whole[order]]
    if not len(order):
        return none, none
    shared = np.ones(len(order) - 1, bool)
    for k in range(RUN):
        here = tokens[order + k]
        shared &= here[1:] == here[:-1]
    head = np.concatenate([[True], ~shared])
    turn = head.copy()
    turn[1:] |= stream[order[1:]] != stream[order[:-1]]
    starts = np.flatnonzero(head)
    n = np.add.reduceat(turn.astype(np.int64), starts)
    keep = n >= least
    return run_hashes(tokens, order[starts[keep]]), n[keep]


def run_hashes(tokens: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hashes of the runs that start at `places`, as `grams` gives them."""
    return signed(grams(tokens, RUN))[places]


def packed(texts: list[str]) -> bytes:
    """Block texts, which hold no line feeds, as they are stored and shuffled."""
    return zlib.compress("\n".join(texts).encode("utf-8", "surrogatepass"))


def unpacked(body: pa.ChunkedArray) -> list[str]:
    return [zlib.decompress(b).decode("utf-8", "surrogatepass") for b in body.to_pylist()]


def streams_of(texts: list[str]) -> list[np.ndarray]:
    """Token streams of pages, given their block texts joined by line feeds."""
    out: list[np.ndarray] = []
    for part in pieces(pa.record_batch([pa.array(texts, pa.large_string())], ["text"]), 0):
        words = Words(part.column(0))
        out += [words.hash[a:b] for a, b in zip(words.first, words.first[1:])]
    return out


def stream_key(tokens: np.ndarray) -> int:
    """One number for a stream; equal streams are one page."""
    return int(signed(grams(tokens, len(tokens)))[0]) if 0 < len(tokens) <= 64 else int(
        signed(np.add.reduce(mix(tokens * np.uint64(2) + np.arange(len(tokens), dtype=np.uint64)), keepdims=True))[0]
    )


def longs(table: pa.Table, name: str) -> np.ndarray:
    """The values of a column that are not null."""
    return table.column(name).drop_null().to_numpy().astype(np.int64)


def with_side(parsed: DataFrame, columns: list[str], side: DataFrame, function, schema: str) -> DataFrame:
    """`function(pages, side rows)` for each (host, slice); the buckets of `parsed` are read in place."""
    return (
        parsed.select("host", "slice", *columns).groupBy("host", "slice")
        .cogroup(side.groupBy("host", "slice"))
        .applyInArrow(lambda pages, rows: function(pages, rows), schema)
    )


def boilerplate(parsed: DataFrame) -> DataFrame:
    """(host, slice, prefix, n): the boilerplate runs of each host and the pages they stand on, for each
    slice of the host."""

    def first_of(pages: pa.Table, rows: pa.Table) -> list[np.ndarray]:
        return streams_of(unpacked(pages.filter(pc.is_in(pages.column("id"), rows.column("id").combine_chunks())).column("body")))

    def frequent(pages, rows):
        streams = first_of(pages, rows)
        whole = pages.column("slices")[0].as_py() == 1
        prefix, n = repeated_runs(streams, max(SHARE * len(streams), LEAST if whole else 0))
        return pa.table({"host": np.full(len(n), pages.column("host")[0].as_py(), np.int64), "prefix": prefix, "n": n, "whole": np.full(len(n), whole)})

    def count(pages, rows):
        asked = np.sort(longs(rows, "prefix"))
        n = np.zeros(len(asked), np.int64)
        for s in first_of(pages, rows):
            own = np.unique(signed(grams(s, RUN)))
            at = np.minimum(np.searchsorted(asked, own), max(len(asked) - 1, 0))
            if len(asked):
                n[at[asked[at] == own]] += 1
        return pa.table({"host": np.full(len(n), pages.column("host")[0].as_py(), np.int64), "prefix": asked, "n": n})

    # Equal streams are one page, wherever its copies lie.
    first = written(
        parsed.groupBy("host", "stream").agg(F.min("id").alias("id"), F.min_by("slice", "id").alias("slice")).drop("stream"), "pages-first"
    )
    n_pages = first.groupBy("host").agg(F.count("*").alias("pages"))
    slices = parsed.select("host", "slice").distinct()
    local = written(
        with_side(parsed, ["slices", "id", "body"], first, frequent, "host long, prefix long, n long, whole boolean"), "pages-runs"
    )
    cut = parsed.where("slices > 1")
    asked = local.where(~F.col("whole")).select("host", "prefix").distinct().join(slices, "host")
    side = first.withColumn("prefix", F.lit(None).cast("long")).join(cut.select("host").distinct(), "host", "left_semi")
    counted = with_side(cut, ["id", "body"], side.unionByName(asked.withColumn("id", F.lit(None).cast("long"))), count, "host long, prefix long, n long")
    runs = (
        local.where("whole").select("host", "prefix", "n")
        .unionByName(counted.groupBy("host", "prefix").agg(F.sum("n").alias("n")))
        .join(n_pages, "host").where((F.col("n") >= LEAST) & (F.col("n") >= SHARE * F.col("pages")))
    )
    return runs.select("host", "prefix", "n").join(slices, "host")


def main_text(blocks: list[tuple[int, str, int]], covered: list[int] | None, weak: list[int] | None = None) -> str:
    return main_text_and_path(blocks, covered, weak)[0]


def main_text_and_path(blocks, covered, weak=None) -> tuple[str, str]:
    """The text, and whether "main" or "open" blocks gave it."""
    words = [text.split() for _, text, _ in blocks]
    starts = np.cumsum([0, *map(len, words)])

    def tokens_of(places):
        return {q for p in places or () for q in range(p, p + RUN)}

    gone, unsure = tokens_of(covered), tokens_of(weak)
    candidates = [b for b, (k, t, n) in enumerate(blocks) if k != OTHER and 2 * n <= len(t)]
    if unsure and candidates:
        b = max(candidates, key=lambda b: len(words[b]))
        own = range(int(starts[b]), int(starts[b + 1]))
        sure = tokens_of(set(covered or ()) - set(weak or ()))
        if 2 * sum(q in unsure for q in own) > len(own):
            gone -= set(own) - sure
    kept: list[list[str]] = []
    for b, w in enumerate(words):
        at, i, left = int(starts[b]), 0, []
        while i < len(w):
            j = i
            while j < len(w) and (at + j in gone) == (at + i in gone):
                j += 1
            # A run's edge may touch a block by chance: only whole blocks and whole runs are cut.
            if at + i not in gone or (j - i < RUN and j - i < len(w)):
                left += w[i:j]
            i = j
        kept.append(left)
    linked = [2 * n > len(t) for _, t, n in blocks]
    marked = [b for b, (k, _, _) in enumerate(blocks) if k == MAIN]
    free = [b for b, (k, _, _) in enumerate(blocks) if k == OPEN and not linked[b]]
    n_main = sum(len(kept[b]) for b in marked)
    n_plain = sum(len(kept[b]) for b in marked if not linked[b])
    n_open = sum(len(kept[b]) for b in free)
    use, path = marked, "main"
    if not n_main or (n_open and (3 * n_plain < n_open or 2 * n_plain < n_main)):
        use, path = sorted(free + [b for b in marked if not linked[b]]), "open"
    return "\n".join(" ".join(kept[b]) for b in use if kept[b]), path


def extract_pages(
    pages: DataFrame, page: str = "page_id", url: str = "url", html_text: str = "html", slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row: the main text, blocks joined by line feeds.

    Character references are decoded, white space inside a block (line breaks too) becomes one space.
    Null and empty pages, and pages without main text, give the empty string. Rows with the same words
    count as one page of their host. A null url has the empty host. An empty table gives an empty result,
    other columns are ignored. The whole page is read. `slice_bytes` bounds the html of a task's group
    (a longer page is a group of its own size) and doesn't change the result.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(page).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html_text).cast("string").alias("html")
    ).withColumn("id", F.monotonically_increasing_id())
    kind = dict(rows.dtypes)["page_id"]

    def names(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([host_of(u) for u in batch.column(0).to_pylist()], pa.string()), batch.column(1)], ["name", "bytes"])

    def parse(batches):
        for batch in batches:
            for part in pieces(batch, "html", 1 << 22):
                found = [blocks_of(h or "") for h in part.column("html").to_pylist()]
                texts = [[t for _, t, _ in p] for p in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"), part.column("url"), part.column("id"),
                        pa.array([host_of(u) for u in part.column("url").to_pylist()], pa.string()),
                        pa.array([stream_key(s) for s in streams_of(["\n".join(t) for t in texts])], pa.int64()),
                        pa.array([[k for k, _, _ in p] for p in found], pa.list_(pa.int8())),
                        pa.array([[n for _, _, n in p] for p in found], pa.list_(pa.int32())),
                        pa.array([packed(t) for t in texts], pa.binary()),
                    ],
                    ["page_id", "url", "id", "name", "stream", "kinds", "linked", "body"],
                )

    def answer(pages, rows):
        prefix, n = longs(rows, "prefix"), longs(rows, "n")
        by = np.argsort(prefix)
        prefix, n = prefix[by], n[by]
        texts: list[str] = []
        whole = unpacked(pages.column("body"))
        for kinds, linked, t, s in zip(pages.column("kinds"), pages.column("linked"), whole, streams_of(whole)):
            blocks = list(zip(kinds.as_py(), t.split("\n"), linked.as_py()))
            own = signed(grams(s, RUN))
            at = np.minimum(np.searchsorted(prefix, own), max(len(prefix) - 1, 0))
            hit = np.flatnonzero(prefix[at] == own) if len(prefix) else np.zeros(0, np.int64)
            texts.append(main_text(blocks, hit.tolist(), hit[n[at[hit]] < SURE].tolist() if len(hit) else []))
        return pa.table(
            [pages.column("page_id"), pages.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    hosts = written(
        rows.select("url", F.coalesce(F.octet_length("html"), F.lit(0)).cast("long").alias("bytes"))
        .mapInArrow(names, "name string, bytes long")
        .groupBy(F.xxhash64("name").alias("host")).agg(F.sum("bytes").alias("bytes")),
        "pages-hosts",
    )
    total = hosts.agg(F.sum("bytes")).first()[0] or 0
    # Hosts in more than one slice: at most total / slice_bytes rows, read from a table whose size the planner knows.
    cut = written(
        hosts.where(F.col("bytes") > slice_bytes).select("host", F.ceil(F.col("bytes") / slice_bytes).cast("int").alias("slices")),
        "pages-slices",
    )
    parsed = bucketed(
        rows.mapInArrow(
            parse,
            f"page_id {kind}, url string, id long, name string, stream long, kinds array<tinyint>, linked array<int>, body binary",
        )
        .withColumn("host", F.xxhash64("name")).drop("name").join(cut, "host", "left")
        .withColumn("slices", F.coalesce("slices", F.lit(1)))
        .withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")),
        "pages",
        ["host", "slice"],
        max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SLICE_BYTES)),
    )
    runs = written(boilerplate(parsed), "pages-boilerplate")
    return with_side(
        parsed, ["page_id", "url", "kinds", "linked", "body"], runs, answer, f"page_id {kind}, url string, text string, n_chars long"
    )
