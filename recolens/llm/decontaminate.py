"""Benchmark passages in documents, by SimHash over windows of the items' sizes.

Words are lower-cased, ASCII punctuation separates them. A window of as many words as an item is
compared with the items of that size through 64-bit SimHash fingerprints of their five-word shingles.
The fingerprints are looked up in a multi-index: 8 blocks of 8 bits; two fingerprints within 23 bits
agree to within 2 bits in at least one block, so looking up every block value within 2 bits finds all
items within the radius. Candidates are verified by the weighted Jaccard similarity of the shingles,
each weighted by how often it occurs.

Fingerprints are only taken where a window can reach the similarity at all: it needs a minimum of
shingles that some item has, and a running count of those finds the windows that have it.

The benchmark is a stated query set. It is read in blocks of bounded size, each of which is broadcast
and held against all documents.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recolens.llm.store import unused
from recolens.llm.tokens import Members, grams, pieces, plain_words

SHINGLE = 5
RADIUS = 23
BLOCKS, WITHIN = 8, 2  # RADIUS < BLOCKS * (WITHIN + 1)
#: Size of a broadcast block of items.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 4 << 20

FOUND = "doc_id long, item_id long, start_word long, n_words long, similarity double"
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_NEAR = _ONES[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= WITHIN


def bits(shingles: np.ndarray) -> np.ndarray:
    """64 columns of +1 and -1 for each shingle."""
    unpacked = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1)
    return unpacked.astype(np.int8) * 2 - 1


def fingerprints(totals: np.ndarray) -> np.ndarray:
    """(n, 8) bytes from (n, 64) sums of `bits`."""
    return np.packbits(totals > 0, axis=1)


class Items:
    """A block of benchmark items as shingles, fingerprints and the multi-index over them."""

    def __init__(self, ids: list[int], texts: list[str], percent: int):
        words = plain_words(pa.array(texts, pa.string()))
        self.percent = percent
        self.by_size: dict[int, list[int]] = defaultdict(list)
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        self.ids, self.counts, prints = ids, {}, {}
        everything = [np.zeros(0, np.uint64)]
        for k in range(len(ids)):
            own = words.hash[words.first[k] : words.first[k + 1]]
            if not len(own):
                continue
            if len(own) < SHINGLE:
                self.short[len(own)][int(grams(own, len(own))[0])].append(k)
                continue
            shingles = grams(own, SHINGLE)
            everything.append(shingles)
            self.counts[k] = Counter(shingles.tolist())
            prints[k] = fingerprints(bits(shingles).sum(axis=0, dtype=np.int64)[None])[0]
            self.by_size[len(shingles)].append(k)
        self.members = Members(np.concatenate(everything))
        self.short_members = {n: Members(np.array(list(x), np.uint64)) for n, x in self.short.items()}
        self.prints = {m: np.array([prints[k] for k in ks]) for m, ks in self.by_size.items()}
        # For each size and block: which items are within 2 bits of each of the 256 block values.
        self.index = {
            m: [_NEAR[:, p[:, b]] for b in range(BLOCKS)] for m, p in self.prints.items()
        }
        self.short = {n: dict(x) for n, x in self.short.items()}

    def least_hits(self, m: int) -> int:
        """Shingles that two windows of m shingles must share for the similarity."""
        return -(-2 * m * self.percent // (100 + self.percent))

    def within(self, m: int, prints: np.ndarray):
        """(window, item) positions of all fingerprints within the radius."""
        hit = self.index[m][0][prints[:, 0]]
        for b in range(1, BLOCKS):
            hit = hit | self.index[m][b][prints[:, b]]
        rows, cols = np.nonzero(hit)
        far = _ONES[prints[rows] ^ self.prints[m][cols]].sum(axis=1)
        keep = far <= RADIUS
        return rows[keep], cols[keep]

    def search(self, shingles: np.ndarray, hits: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """{item: (similarity, -start, words)}, the best window of one text for each item."""
        best: dict[int, tuple[float, int, int]] = {}
        have = np.zeros(len(shingles) + 1, np.int64)
        have[hits + 1] = 1
        np.cumsum(have, out=have)
        sums = None
        for m, ks in self.by_size.items():
            if m > len(shingles) or len(hits) < self.least_hits(m):
                continue
            starts = np.flatnonzero(have[m:] - have[:-m] >= self.least_hits(m))
            if not len(starts):
                continue
            if sums is None:
                sums = np.zeros((len(shingles) + 1, 64), np.int32)
                np.cumsum(bits(shingles), axis=0, dtype=np.int32, out=sums[1:])
            rows, cols = self.within(m, fingerprints(sums[starts + m] - sums[starts]))
            windows: dict[int, Counter] = {}
            for r, c in zip(rows.tolist(), cols.tolist()):
                at, k = int(starts[r]), ks[c]
                if r not in windows:
                    windows[r] = Counter(shingles[at : at + m].tolist())
                common = sum((windows[r] & self.counts[k]).values())
                if 100 * common >= self.percent * (2 * m - common):
                    found = (common / (2 * m - common), -at, m + SHINGLE - 1)
                    best[k] = max(best.get(k, found), found)
        return best


def item_blocks(benchmark: DataFrame, item: str, text: str):
    """Blocks of at most BLOCK_ITEMS items and about BLOCK_BYTES of text, in the order of the ids."""
    rows = benchmark.select(F.col(item).cast("long").alias("i"), F.col(text).cast("string").alias("t"))
    ids, texts, size = [], [], 0
    for i, t in rows.where("i is not null and t is not null").distinct().sort("i", "t").toLocalIterator():
        if ids and (len(ids) == BLOCK_ITEMS or size + len(t) > BLOCK_BYTES):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(t)
        size += len(t)
    if ids:
        yield ids, texts


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    percent: int = 80,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity): the best window of each document for each
    item it has a window for with 100 * similarity >= percent; ties go to the earliest window.

    Whole texts are searched. Items of fewer than five words are found as exact word sequences. Null
    or wordless documents and items have no match, nor has an empty table; rows without an id are not
    reported; repeated rows give one result. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def scan(sent):
        def run(batches):
            items = Items(*sent.value, percent)
            for batch in batches:
                out = []
                for part in pieces(batch, 1):
                    ids = part.column(0).to_pylist()
                    words = plain_words(part.column(1))
                    all_grams = grams(words.hash, SHINGLE)
                    hits = items.members.where(all_grams)
                    lo = np.searchsorted(hits, words.first[:-1])
                    hi = np.searchsorted(hits, np.maximum(words.first[1:] - SHINGLE + 1, 0))
                    for i in np.flatnonzero(hi > lo).tolist():
                        a, b = words.first[i], words.first[i + 1] - SHINGLE + 1
                        found = items.search(all_grams[a:b], hits[lo[i] : hi[i]] - a)
                        out += [(ids[i], items.ids[k], -at, n, s) for k, (s, at, n) in found.items()]
                    for n, members in items.short_members.items():
                        line = grams(words.hash, n)
                        seen = set()
                        for p in members.where(line).tolist():
                            i = int(np.searchsorted(words.first, p, "right")) - 1
                            if p + n <= words.first[i + 1]:
                                for k in items.short[n][int(line[p])]:
                                    if (i, k) not in seen:
                                        seen.add((i, k))
                                        out.append((ids[i], items.ids[k], p - int(words.first[i]), n, 1.0))
                names = ["doc_id", "item_id", "start_word", "n_words", "similarity"]
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in out], kinds[c]) for c in range(5)], names
                )

        return run

    blocks = [spark.sparkContext.broadcast(block) for block in item_blocks(benchmark, item, item_text)]
    if not blocks:
        return spark.createDataFrame([], FOUND)
    found = reduce(DataFrame.unionAll, [rows.where("doc_id is not null").mapInArrow(scan(b), FOUND) for b in blocks])
    place = F.struct(F.col("similarity"), (-F.col("start_word")).alias("s"), "n_words")
    return (
        found.groupBy("doc_id", "item_id").agg(F.max(place).alias("m"))
        .select("doc_id", "item_id", (-F.col("m.s")).alias("start_word"), "m.n_words", "m.similarity")
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of `docs` in which no benchmark item is found, all columns kept."""
    (name,) = unused(docs, "_leak")
    leaks = find_leaks(docs, benchmark, percent).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(leaks, docs["doc_id"] == leaks[name], "left_anti")
