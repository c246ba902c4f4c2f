"""Interpolated modified Kneser-Ney model over word bigrams or trigrams, counted in Spark and scored
from memory-mapped sorted arrays.

Tokens are lower-cased words and one end token per text; a text begins in a start context.

    P(w | v) = max(c(v w) - D(c), 0) / c(v .) + g(v) P(w)
    P(w)     = max(n(w) - E(n), 0) / n(.) + g0 / (V + 1),   n(w) = number of distinct v before w

with the modified discounts of Chen and Goodman (1998) for counts 1, 2 and 3+, and g, g0 the mass they
free. A word that follows no known context is scored by P(w).

With order 3, P(w | u v) = max(c(u v w) - F(c), 0) / c(u v .) + g(u v) P(w | v), and the counts of pairs
become adjusted counts: c(v w) is the number of distinct u before v w, the plain count where v is the
start context. The first token of a text is scored by P(w | start).

1. Tasks count word hashes and send packed sorted arrays to one group per hash range; a group writes
   its part of the vocabulary: sorted hashes and counts. A word's id is its place in it.
2. Tasks count (context id, word id) keys likewise, for ranges of keys that hold about `RANGE_TOKENS`
   tokens each (cut points from a bounded sample of keys; a frequent context spans several ranges). A
   group writes sorted keys and counts, and returns what its contexts and words add up to.
3. Those sums meet by id range and become dense arrays: totals, free mass, numbers of contexts.
   With order 3, tasks first count (pair id, word id) keys in ranges of the same kind; a pair's id is
   its place in the sorted keys. Their sums meet by range of pair ids and become dense arrays too.
4. Scoring tasks map all files and look their distinct keys up.

Every count is summed inside the task before it travels, so frequent words and word pairs are single
entries. What a group holds is bounded by the ranges. The numbers of ranges change no result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recolens.llm.files import pack, pack_small, read_file, summed, unpack, unpack_small, write_file
from recolens.llm.store import drop_written, shared_folder, written
from recolens.llm.tokens import Words, pieces

RANGE_TOKENS = 3_000_000
HELD_TOKENS = 4_000_000
SAMPLE_KEYS = 200_000
PIECE = 1 << 20
END = np.uint64(0xE3D0000000000001)
NONE = np.zeros(0, np.uint64)


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts): the words of each text and its end token; starts has one entry more."""
    words = Words(texts)
    n = len(words.first) - 1
    starts = words.first + np.arange(n + 1)
    out = np.empty(len(words) + n, np.uint64)
    out[starts[1:] - 1] = END
    out[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(words.first))] = words.hash
    return out, starts


class Buffer:
    """Sums keys of a task and gives them out as packed arrays per range."""

    def __init__(self):
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> bool:
        keys, counts = np.unique(keys, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        return self.size >= HELD_TOKENS

    def rows(self, bounds: np.ndarray) -> pa.RecordBatch:
        keys, counts = summed(np.concatenate(self.keys or [NONE]), np.concatenate(self.counts or [np.zeros(0, np.int64)]))
        self.__init__()
        cuts = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
        parts = [k for k in range(len(cuts) - 1) if cuts[k] < cuts[k + 1]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(parts, pa.int32()),
                pa.array([int(cuts[k + 1] - cuts[k]) for k in parts], pa.int64()),
                pa.array([pack(keys[cuts[k] : cuts[k + 1]]) for k in parts], pa.binary()),
                pa.array([pack_small(counts[cuts[k] : cuts[k + 1]]) for k in parts], pa.binary()),
            ],
            ["part", "n", "keys", "counts"],
        )


PACKED = "part int, n long, keys binary, counts binary"


def gathered(table: pa.Table, counts: str = "counts") -> tuple[np.ndarray, np.ndarray]:
    """The summed keys and counts of a group's packed rows."""
    sizes = table.column("n").to_pylist()
    keys = [unpack(b, n) for b, n in zip(table.column("keys").to_pylist(), sizes)]
    values = [unpack_small(b, n) for b, n in zip(table.column(counts).to_pylist(), sizes)]
    return summed(np.concatenate(keys or [NONE]), np.concatenate(values or [NONE]))


def write_dense(folder: str, name: str, columns: np.ndarray) -> str:
    """A file of columns of counts: one byte each, and 255 for those listed with their places."""
    big = [np.flatnonzero(c > 254) for c in columns]
    return write_file(
        folder, name,
        [u64(columns.shape[1], *(len(b) for b in big)), *(x for c, b in zip(columns, big) for x in (b.astype(np.uint64), c[b].astype(np.uint64))),
         *(np.minimum(c, 255).astype(np.uint8) for c in columns)],
    )


class Dense:
    """Reads a file of `write_dense`."""

    def __init__(self, path: str, columns: int):
        raw, at = read_file(path), 8 * (columns + 1)
        n, *sizes = (int(x) for x in raw[:at].view(np.uint64))
        self.big = []
        for size in sizes:
            self.big.append((raw[at : at + 8 * size].view(np.uint64), raw[at + 8 * size : at + 16 * size].view(np.uint64)))
            at += 16 * size
        self.small = [raw[at + k * n : at + (k + 1) * n] for k in range(columns)]

    def take(self, column: int, at: np.ndarray) -> np.ndarray:
        out = self.small[column][at].astype(np.int64)
        over = np.flatnonzero(out == 255)
        places, values = self.big[column]
        out[over] = values[np.searchsorted(places, at[over].astype(np.uint64))]
        return out


#: Columns of the dense files; `FREE` is worked out from the first four and the discounts.
TOTAL, ONES, TWOS, MORE, BEFORE, COLUMNS = range(6)
FREE = "free"


def free_mass(total, ones, twos, more, d: tuple[float, float, float]) -> np.ndarray:
    """What the discounts take of a context's total."""
    return (d[0] * ones + d[1] * twos + d[2] * more) / np.maximum(total, 1)


def u64(*values) -> np.ndarray:
    return np.array(values, np.uint64)


@dataclass
class Model:
    """Where the files are, and the few global numbers."""

    shift: int  # a hash's vocabulary part is hash >> shift
    vocabulary: list[tuple[int, str]]  # (part, path), by part
    words: int
    tokens: int
    bounds: np.ndarray  # the first key of every bigram part but the first
    pairs: list[tuple[int, str]]
    per_range: int  # ids of one file of `sums`
    sums: list[tuple[int, str]]
    discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    lower: tuple[float, float, float] = (0.0, 0.0, 0.0)
    contexts: int = 0  # n(.)
    free: float = 1.0  # g0
    order: int = 2
    n_pairs: int = 0  # distinct pairs; a pair's id is its place in the sorted keys of all parts
    triple_bounds: np.ndarray = field(default_factory=lambda: NONE)
    triples: list[tuple[int, str]] = field(default_factory=list)
    per_pair_range: int = 1  # pair ids of one file of `pair_sums`
    pair_sums: list[tuple[int, str]] = field(default_factory=list)
    upper: tuple[float, float, float] = (0.0, 0.0, 0.0)  # D of the triples


class Vocabulary:
    def __init__(self, model: Model):
        self.shift, self.parts, base = model.shift, {}, 0
        for part, path in model.vocabulary:
            raw = read_file(path)
            n = int(raw[:8].view(np.uint64)[0])
            self.parts[part] = (raw[8 : 8 + 8 * n].view(np.uint64), raw[8 + 8 * n : 8 + 16 * n].view(np.uint64), base)
            base += n

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of sorted distinct hashes; unknown ones have the id -1 and the count 0."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        cuts = np.searchsorted(hashes >> np.uint64(self.shift), np.arange(max(self.parts, default=0) + 2, dtype=np.uint64))
        for part, (known, often, base) in self.parts.items():
            a, b = cuts[part], cuts[part + 1]
            if a < b and len(known):
                at = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
                hit = known[at] == hashes[a:b]
                ids[a:b] = np.where(hit, at + base, -1)
                counts[a:b] = np.where(hit, often[at], 0)
        return ids, counts


def keys_of(ids: np.ndarray, starts: np.ndarray, start_id: int) -> np.ndarray:
    """context id << 32 | word id of every token; the context of a text's first token is `start_id`."""
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    before[starts[:-1]] = start_id
    return (before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)


def discount(n: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of entries with the counts 1 to 4; half the count where one of them
    leaves the estimate undefined, never outside 0 .. count."""
    out = []
    for i in (1, 2, 3):
        if n[0] and n[1] and n[i - 1]:
            y = n[0] / (n[0] + 2 * n[1])
            out.append(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.0), float(i)))
        else:
            out.append(i / 2)
    return tuple(out)


def taken(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """max(count - its discount, 0)."""
    return np.maximum(counts - np.array((0.0, *d))[np.minimum(counts, 3).astype(np.int64)], 0.0)


def train(texts: DataFrame, text: str = "text", order: int = 2) -> Model:
    """Count and write the model of all rows of `texts`; see the module for nulls and empty texts: a
    null text is empty, an empty text has the end token alone, repeated rows count again."""
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    spark = texts.sparkSession
    folder = shared_folder(spark, "lm")
    texts = texts.select(F.col(text).cast("string").alias("text"))
    width = max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    shift = 64 - width
    hash_bounds = np.arange(1, 1 << width, dtype=np.uint64) << np.uint64(shift)

    def count_words(batches):
        buffer = Buffer()
        for batch in batches:
            for piece in pieces(batch, 0, PIECE):
                if buffer.add(token_hashes(piece.column(0))[0]):
                    yield buffer.rows(hash_bounds)
        yield buffer.rows(hash_bounds)

    def write_words(key, table):
        hashes, counts = gathered(table)
        path = write_file(folder, "words", [u64(len(hashes)), hashes, counts])
        return pa.table(
            {
                "part": pa.array([key[0].as_py()], pa.int32()), "path": [path],
                "n": pa.array([len(hashes)], pa.int64()), "total": pa.array([int(counts.sum())], pa.int64()),
            }
        )

    parts = (
        texts.mapInArrow(count_words, PACKED).groupBy("part")
        .applyInArrow(write_words, "part int, path string, n long, total long")
    )
    parts = sorted(written(parts, "lm-words").collect())
    words, tokens = sum(r.n for r in parts), sum(r.total for r in parts)
    if words >= 1 << 31:
        raise ValueError("more than 2 ** 31 distinct words")
    model = Model(shift, [(r.part, r.path) for r in parts], words, tokens, NONE, [], -(-(words + 1) // (1 << width)), [])
    if not tokens:
        return model

    def pair_keys(batches):
        vocabulary = Vocabulary(model)
        for batch in batches:
            for piece in pieces(batch, 0, PIECE):
                hashes, starts = token_hashes(piece.column(0))
                distinct, back = np.unique(hashes, return_inverse=True)
                yield keys_of(vocabulary.find(distinct)[0][back], starts, words)

    n_parts = -(-tokens // RANGE_TOKENS)
    if n_parts > 1:

        def some_keys(batches):
            for keys in pair_keys(batches):
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])

        share = min(1.0, SAMPLE_KEYS / tokens)
        some = texts.sample(share, 5).mapInArrow(some_keys, "key long").limit(2 * SAMPLE_KEYS).toArrow()
        some = np.sort(some.column(0).to_numpy())
        if len(some):
            at = np.arange(1, n_parts) * len(some) // n_parts
            model.bounds = np.unique(some[at]).astype(np.uint64)
    bounds, per_range = model.bounds, model.per_range

    def count_pairs(batches):
        buffer = Buffer()
        for keys in pair_keys(batches):
            if buffer.add(keys):
                yield buffer.rows(bounds)
        yield buffer.rows(bounds)

    names = ["kind", "part", "path", "n", "of", "keys", "counts", "ones", "twos", "more"]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.int64())] + [pa.binary()] * 5

    def ranges(kind: int, ids: np.ndarray, *values: np.ndarray, per: int = per_range) -> list[tuple]:
        part = (ids.astype(np.int64)) // per
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
        ends = [*first[1:], len(part)] if len(part) else []
        return [
            (kind, int(part[a]), None, int(b - a), None, pack(ids[a:b]), *(pack_small(v[a:b]) for v in values), *[b""] * (4 - len(values)))
            for a, b in zip(first, ends)
        ]

    def left_sums(keys: np.ndarray, counts: np.ndarray) -> tuple:
        """(contexts, totals, and their numbers of keys counted once, twice, more often)"""
        left = keys >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]]))
        return left[first], *(np.add.reduceat(x.astype(np.int64), first) for x in (counts, counts == 1, counts == 2, counts > 2))

    def rows_table(rows: list[tuple]) -> pa.Table:
        return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds))})

    def write_keys(name: str, keys: np.ndarray, counts: np.ndarray) -> str:
        big = np.flatnonzero(counts > 254)
        return write_file(
            folder, name,
            [u64(len(keys), len(big)), keys, big.astype(np.uint64), counts[big], np.minimum(counts, 255).astype(np.uint8)],
        )

    def write_pairs(key, table):
        keys, counts = gathered(table)
        path = write_keys("pairs", keys, counts)
        often = [int((counts == i).sum()) for i in (1, 2, 3, 4)]
        rows = [(0, key[0].as_py(), path, len(keys), often, b"", b"", b"", b"", b"")]
        if order == 2:
            rows += ranges(1, *left_sums(keys, counts))
        rows += ranges(2, *np.unique(keys & np.uint64(0xFFFFFFFF), return_counts=True))
        return rows_table(rows)

    pairs = (
        texts.mapInArrow(count_pairs, PACKED).groupBy("part").applyInArrow(
            write_pairs,
            "kind int, part int, path string, n long, of array<long>, keys binary, counts binary, ones binary, "
            "twos binary, more binary",
        )
    )
    pairs = written(pairs, "lm-pairs")
    parts = sorted(pairs.where("kind = 0").select("part", "path", "n", "of").collect())
    model.pairs, model.n_pairs = [(r.part, r.path) for r in parts], sum(r.n for r in parts)
    if order == 3:
        lefts = count_triples(spark, texts, model, folder, ranges, left_sums, rows_table, write_keys)
        pairs = pairs.where("kind = 2").unionAll(lefts)
    else:
        model.discounts = discount([sum(r.of[i] for r in parts) for i in range(4)])

    def write_sums(key, table):
        part = key[0].as_py()
        dense = np.zeros((5, per_range), np.int64)
        kind = np.array(table.column("kind").to_pylist())
        for k, columns in ((1, ("counts", "ones", "twos", "more")), (2, ("counts",))):
            own = table.filter(pa.array(kind == k))
            for row in own.to_pylist():
                at = unpack(row["keys"], row["n"]).astype(np.int64) - part * per_range
                for j, c in enumerate(columns):
                    dense[j if k == 1 else 4][at] += unpack_small(row[c], row["n"]).astype(np.int64)
        before = dense[BEFORE]
        path = write_dense(folder, "sums", dense)
        often = [int((before == i).sum()) for i in (1, 2, 3, 4)] + [int((before > 2).sum()), int(before.sum())]
        return pa.table({"part": pa.array([part], pa.int32()), "path": [path], "of": pa.array([often], pa.list_(pa.int64()))})

    sums = pairs.where("kind > 0").groupBy("part").applyInArrow(write_sums, "part int, path string, of array<long>")
    parts = sorted(written(sums, "lm-sums").collect())
    drop_written(pairs)
    model.sums = [(r.part, r.path) for r in parts]
    often = [sum(r.of[i] for r in parts) for i in range(6)]
    model.lower, model.contexts = discount(often[:4]), often[5]
    e = model.lower
    model.free = (e[0] * often[0] + e[1] * often[1] + e[2] * often[4]) / often[5]
    return model


ROWS = (
    "kind int, part int, path string, n long, of array<long>, keys binary, counts binary, ones binary, twos binary, more binary"
)


def count_triples(spark, texts, model, folder, ranges, left_sums, rows_table, write_keys) -> DataFrame:
    """Count the triples of `model`, write their files, the dense sums by pair id and the pairs' adjusted
    counts; returns what those add up to by context word (rows of kind 1).

    A triple's key is the id of its first two tokens' pair << 32 | the third token's id. The first token
    of a text has the start context alone, so it is no triple. The adjusted count of a pair is the
    number of distinct tokens before it; of a pair of the start context, its plain count.
    """
    if model.n_pairs >= 1 << 32:
        raise ValueError("2 ** 32 distinct pairs or more")
    model.order = 3
    words, pair_parts, n_parts = model.words, -(-model.n_pairs // RANGE_TOKENS), -(-model.tokens // RANGE_TOKENS)
    model.per_pair_range = per = -(-model.n_pairs // max(1, pair_parts))

    def triple_keys(batches):
        scorer = Scorer(model)
        for batch in batches:
            for piece in pieces(batch, 0, PIECE):
                hashes, starts = token_hashes(piece.column(0))
                distinct, back = np.unique(hashes, return_inverse=True)
                keys = keys_of(scorer.vocabulary.find(distinct)[0][back], starts, words)
                distinct, back = np.unique(keys, return_inverse=True)
                yield triples_of(scorer.pair_ids(distinct)[back], keys, starts)

    def some_keys(batches):
        for keys in triple_keys(batches):
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])

    bounds = NONE
    if n_parts > 1:
        share = min(1.0, SAMPLE_KEYS / model.tokens)
        some = texts.sample(share, 5).mapInArrow(some_keys, "key long").limit(2 * SAMPLE_KEYS).toArrow()
        some = np.sort(some.column(0).to_numpy().view(np.uint64))
        if len(some):
            bounds = np.unique(some[np.arange(1, n_parts) * len(some) // n_parts])
    model.triple_bounds = bounds

    def count(batches):
        buffer = Buffer()
        for keys in triple_keys(batches):
            if buffer.add(keys):
                yield buffer.rows(bounds)
        yield buffer.rows(bounds)

    def write_triples(key, table):
        keys, counts = gathered(table)
        path = write_keys("triples", keys, counts)
        often = [int((counts == i).sum()) for i in (1, 2, 3, 4)]
        rows = [(0, key[0].as_py(), path, len(keys), often, b"", b"", b"", b"", b"")]
        if len(keys):
            rows += ranges(3, *left_sums(keys, counts), per=per)
            # Each distinct triple is one token before the pair of its last two.
            scorer = Scorer(model)
            middle = scorer.pair_keys((keys >> np.uint64(32)).astype(np.int64)) & np.uint64(0xFFFFFFFF)
            pair, n = np.unique((middle << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF)), return_counts=True)
            rows += ranges(4, scorer.pair_ids(pair).astype(np.uint64), n, per=per)
        return rows_table(rows)

    triples = written(texts.mapInArrow(count, PACKED).groupBy("part").applyInArrow(write_triples, ROWS), "lm-triples")
    parts = sorted(triples.where("kind = 0").select("part", "path", "of").collect())
    model.triples = [(r.part, r.path) for r in parts]
    model.upper = discount([sum(r.of[i] for r in parts) for i in range(4)])

    def write_pair_sums(key, table):
        part = key[0].as_py()
        size = min(per, model.n_pairs - part * per)
        dense = np.zeros((5, size), np.int64)
        for row in table.to_pylist():
            if row["kind"] in (3, 4):
                at = unpack(row["keys"], row["n"]).astype(np.int64) - part * per
                for j, c in enumerate(("counts", "ones", "twos", "more") if row["kind"] == 3 else ("counts",)):
                    dense[j if row["kind"] == 3 else 4][at] += unpack_small(row[c], row["n"]).astype(np.int64)
        scorer = Scorer(model)
        keys = scorer.pair_keys(np.arange(part * per, part * per + size))
        begins = (keys >> np.uint64(32)) == np.uint64(words)
        adjusted = dense[4]
        adjusted[begins] = scorer.pair_counts(keys[begins])
        path = write_dense(folder, "pair-sums", dense)
        often = [int((adjusted == i).sum()) for i in (1, 2, 3, 4)]
        return rows_table([(0, part, path, size, often, b"", b"", b"", b"", b""), *ranges(1, *left_sums(keys, adjusted))])

    every = spark.range(pair_parts).selectExpr(
        "5 as kind", "cast(id as int) as part", "cast(null as string) as path", "0L as n", "cast(null as array<long>) as of",
        *(f"cast('' as binary) as {c}" for c in ("keys", "counts", "ones", "twos", "more")),
    )
    sums = triples.where("kind > 2").unionAll(every).groupBy("part").applyInArrow(write_pair_sums, ROWS)
    sums = written(sums, "lm-pair-sums")
    drop_written(triples)
    parts = sorted(sums.where("kind = 0").select("part", "path", "of").collect())
    model.pair_sums = [(r.part, r.path) for r in parts]
    model.discounts = discount([sum(r.of[i] for r in parts) for i in range(4)])
    return sums.where("kind = 1")


def triples_of(pairs: np.ndarray, keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Triple keys of all tokens but each text's first, from the pair ids and keys of all tokens."""
    later = np.ones(len(pairs), bool)
    later[starts[:-1]] = False
    later = np.flatnonzero(later)
    return (pairs[later - 1].astype(np.uint64) << np.uint64(32)) | (keys[later] & np.uint64(0xFFFFFFFF))


class Scorer:
    """The model's files, mapped into memory."""

    def __init__(self, model: Model):
        self.model, self.vocabulary = model, Vocabulary(model)
        self.pairs, self.triples = self.key_files(model.pairs), self.key_files(model.triples)
        # The id of the first pair of every part.
        self.first_pair = np.cumsum([0, *(len(self.pairs[k][0]) for k in sorted(self.pairs))])
        self.pair_sums = {part: Dense(path, COLUMNS) for part, path in model.pair_sums}
        self.sums = {part: Dense(path, COLUMNS) for part, path in model.sums}

    @staticmethod
    def key_files(files: list[tuple[int, str]]) -> dict:
        out = {}
        for part, path in files:
            raw = read_file(path)
            n, big = (int(x) for x in raw[:16].view(np.uint64))
            at = 16 + 8 * n
            out[part] = (
                raw[16:at].view(np.uint64), raw[at + 16 * big :],
                raw[at : at + 8 * big].view(np.uint64), raw[at + 8 * big : at + 16 * big].view(np.uint64),
            )
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct keys."""
        return self.counts_in(self.pairs, self.model.bounds, keys)

    @staticmethod
    def counts_in(files: dict, bounds: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        cuts = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
        for part, (known, counts, big, values) in files.items():
            a, b = cuts[part], cuts[part + 1]
            if a < b and len(known):
                at = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
                c = np.where(known[at] == keys[a:b], counts[at], 0).astype(np.int64)
                over = np.flatnonzero(c == 255)
                c[over] = values[np.searchsorted(big, at[over].astype(np.uint64))]
                out[a:b] = c
        return out

    def pair_ids(self, keys: np.ndarray) -> np.ndarray:
        """Ids of sorted distinct pair keys, -1 for unknown ones."""
        out = np.full(len(keys), -1, np.int64)
        cuts = np.concatenate([[0], np.searchsorted(keys, self.model.bounds), [len(keys)]])
        for base, part in zip(self.first_pair, sorted(self.pairs)):
            known, a, b = self.pairs[part][0], cuts[part], cuts[part + 1]
            if a < b and len(known):
                at = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
                out[a:b] = np.where(known[at] == keys[a:b], at + base, -1)
        return out

    def pair_keys(self, ids: np.ndarray) -> np.ndarray:
        """Pair keys of sorted ids."""
        cuts = np.searchsorted(ids, self.first_pair)
        return np.concatenate(
            [NONE, *(self.pairs[p][0][ids[a:b] - base] for p, base, a, b in zip(sorted(self.pairs), self.first_pair, cuts, cuts[1:]))]
        )

    def of_pairs(self, ids: np.ndarray, column: int | str) -> np.ndarray:
        """Entries of a dense column by pair id, for sorted ids; 0 for -1."""
        if column == FREE:
            return free_mass(*(self.of_pairs(ids, c) for c in (TOTAL, ONES, TWOS, MORE)), self.model.upper)
        out = np.zeros(len(ids), np.int64)
        per = self.model.per_pair_range
        for part, dense in self.pair_sums.items():
            a, b = np.searchsorted(ids, [part * per, (part + 1) * per])
            if a < b:
                out[a:b] = dense.take(column, ids[a:b] - part * per)
        return out

    def of_ids(self, ids: np.ndarray, column: int | str) -> np.ndarray:
        """Entries of a dense column for sorted ids."""
        if column == FREE:
            return free_mass(*(self.of_ids(ids, c) for c in (TOTAL, ONES, TWOS, MORE)), self.model.discounts)
        out = np.zeros(len(ids), np.int64)
        cuts = np.searchsorted(ids, np.arange(0, self.model.words + 1 + self.model.per_range, self.model.per_range))
        for part, dense in self.sums.items():
            a, b = cuts[part], cuts[part + 1]
            if a < b:
                out[a:b] = dense.take(column, ids[a:b] - part * self.model.per_range)
        return out

    def score(self, texts: pa.Array) -> dict[str, np.ndarray]:
        m = self.model
        hashes, starts = token_hashes(texts)
        distinct, back = np.unique(hashes, return_inverse=True)
        ids, counts = self.vocabulary.find(distinct)
        base = np.log10((counts + 0.1) / (m.tokens + 0.1 * (m.words + 1)))
        lower = np.full(len(distinct), 1.0 / (m.words + 1))
        order = np.argsort(ids, kind="stable")
        if m.contexts:
            before = self.of_ids(np.maximum(ids[order], 0), BEFORE)
            before[ids[order] < 0] = 0
            lower[order] = taken(before, m.lower) / m.contexts + m.free / (m.words + 1)
        p = lower[back]
        if m.pairs:
            own = ids[back]
            keys = keys_of(np.maximum(own, 0), starts, m.words)
            unknown = own < 0
            lost = np.zeros(len(own), bool)
            lost[1:] = unknown[:-1]
            lost[starts[:-1]] = False
            keys, where = np.unique(keys, return_inverse=True)
            # Keys of unknown words are looked up as word 0 and overruled below.
            if m.order == 3:
                known = self.pair_ids(keys)
                pair = np.where(unknown | lost, -1, known[where])
                distinct_pairs, back_pairs = np.unique(pair, return_inverse=True)
                c = self.of_pairs(distinct_pairs, BEFORE)[back_pairs]
            else:
                c = np.where(unknown, 0, self.pair_counts(keys)[where])
            left, at = np.unique((keys >> np.uint64(32)).astype(np.int64), return_inverse=True)
            total = self.of_ids(left, TOTAL)[at][where]
            free = self.of_ids(left, FREE)[at][where]
            usable = ~lost & (total > 0)
            p = np.where(usable, taken(c, m.discounts) / np.maximum(total, 1) + free * p, p)
            if m.order == 3:
                # The context of a token is the pair before it; a text's first token has none.
                context = np.full(len(own), -1, np.int64)
                context[1:] = pair[:-1]
                context[starts[:-1]] = -1
                left, at = np.unique(context, return_inverse=True)
                total, free = self.of_pairs(left, TOTAL)[at], self.of_pairs(left, FREE)[at]
                triple = (np.maximum(context, 0).astype(np.uint64) << np.uint64(32)) | np.maximum(own, 0).astype(np.uint64)
                distinct_triples, at = np.unique(triple, return_inverse=True)
                c = np.where(unknown | (context < 0), 0, self.counts_in(self.triples, m.triple_bounds, distinct_triples)[at])
                p = np.where(total > 0, taken(c, m.upper) / np.maximum(total, 1) + free * p, p)
        first = starts[:-1]
        return {
            "n_tokens": np.diff(starts),
            "n_known": np.add.reduceat((ids >= 0)[back].astype(np.int64), first),
            "base_score": np.add.reduceat(base[back], first),
            "score": np.add.reduceat(np.log10(p), first),
        }


def score(docs: DataFrame, model: Model, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, perplexity), one row per row of `docs`.

    Scores are log10 probabilities, rounded to six decimals; perplexity is 10 ** (-score / n_tokens).
    Null and empty texts have the end token alone. An empty table gives an empty result, an untrained
    model the uniform distribution. Repeated rows are scored alike, other columns ignored.
    """

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            for piece in pieces(batch, 1, PIECE):
                s = scorer.score(piece.column(1))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *(pa.array(s[k]) for k in ("n_tokens", "n_known", "base_score", "score"))],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id", "n_tokens", "n_known", F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"),
        F.round(F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")), 4).alias("perplexity"),
    )


def held_out(doc: str = "doc_id"):
    """Whether a document is kept out of training: crc32 of its id as text is divisible by 10."""
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % 10 == 0, F.lit(False))
