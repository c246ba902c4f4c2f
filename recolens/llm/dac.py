"""Token ids of a corpus as directly addressable codes.

Every id is cut into chunks of 8 bits, lowest first. Level 1 holds the first chunk of every id, level
2 the second chunk of those ids that go on, and so on; a continuation bitmap tells which ids of a
level go on, and a rank directory (one count per 512 bits) gives their place in the next level. So any
token is read with one look-up per level, and no block is decoded for it.

A file, little endian: the magic `DACIDS01`; n_docs, n_tokens, n_levels (uint64); doc_id (int64) and
valid (uint8, padded to 8 bytes) per document; n_docs + 1 starts (uint64); then per level its length
(uint64), the chunks (uint8) and, but for the last level, the bitmap (bits from the lowest, uint8) and
the directory (uint64), each padded to 8 bytes.

The corpus is range-partitioned by doc_id and sorted; a task writes its documents in files of at most
`FILE_TOKENS` tokens (a longer document alone). File order is partition, then number in the partition.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from recolens.llm.files import read_file, write_file
from recolens.llm.store import shared_folder, written
from recolens.llm.tokens import LOWER, Words, pieces

FILE_TOKENS = 1 << 22
RANK_BITS = 512
MAGIC = np.frombuffer(b"DACIDS01", np.uint8)
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint64)


def padded(a: np.ndarray) -> np.ndarray:
    raw = np.ascontiguousarray(a).view(np.uint8).ravel()
    return np.concatenate([raw, np.zeros(-len(raw) % 8, np.uint8)])


def encode_file(doc_ids: list[int | None], starts: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
    """The parts of one file. `starts` are the documents' first tokens, and the end."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        levels.append(rest)
        rest = rest[rest > 0xFF] >> np.uint32(8)
        if not len(rest):
            break
    out = [MAGIC, np.array([len(doc_ids), len(ids), len(levels)], np.uint64)]
    out.append(np.array([d or 0 for d in doc_ids], np.int64))
    out.append(padded(np.array([d is not None for d in doc_ids], np.uint8)))
    out.append(starts.astype(np.uint64))
    for k, values in enumerate(levels):
        out += [np.array([len(values)], np.uint64), padded(values.astype(np.uint8))]
        if k < len(levels) - 1:
            bitmap = padded(np.packbits(values > 0xFF, bitorder="little"))
            bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % (RANK_BITS // 8), np.uint8)])
            ones = _ONES[bitmap].reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint64)
            out += [bitmap, np.concatenate([[0], np.cumsum(ones)]).astype(np.uint64)]
    return out


class DacFile:
    """Reads one file through a byte array (memory-mapped or not)."""

    def __init__(self, raw: np.ndarray):
        if bytes(raw[:8]) != MAGIC.tobytes():
            raise ValueError("not a token file")
        self.raw, self.at = raw, 8
        self.n_docs, self.n_tokens, n_levels = (int(x) for x in self._take(3, np.uint64))
        self.doc_ids = self._take(self.n_docs, np.int64)
        self.valid = self._take(self.n_docs, np.uint8)
        self.starts = self._take(self.n_docs + 1, np.uint64)
        self.levels = []
        for k in range(n_levels):
            n = int(self._take(1, np.uint64)[0])
            chunks, bitmap, ranks = self._take(n, np.uint8), None, None
            if k < n_levels - 1:
                blocks = -(-n // RANK_BITS)
                bitmap = self._take(blocks * RANK_BITS // 8, np.uint8)
                ranks = self._take(blocks + 1, np.uint64)
            self.levels.append((chunks, bitmap, ranks))

    def _take(self, n: int, kind) -> np.ndarray:
        size = n * np.dtype(kind).itemsize
        part = self.raw[self.at : self.at + size].view(kind)
        self.at += size + -size % 8
        return part

    def token(self, i: int) -> int:
        """The id at position i, one look-up per level."""
        value = 0
        for k, (chunks, bitmap, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            if bitmap is None or not (int(bitmap[i >> 3]) >> (i & 7)) & 1:
                break
            block = i // RANK_BITS
            before = bitmap[block * RANK_BITS // 8 : i >> 3]
            i = int(ranks[block]) + int(_ONES[before].sum()) + (int(bitmap[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
        return value

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """The ids lo .. hi - 1 as uint32."""
        out = np.zeros(hi - lo, np.uint32)
        where = np.arange(hi - lo)
        for k, (chunks, bitmap, ranks) in enumerate(self.levels):
            out[where] |= chunks[lo:hi].astype(np.uint32) << np.uint32(8 * k)
            if bitmap is None or lo == hi:
                break
            flags = np.unpackbits(bitmap[lo >> 3 : (hi + 7) >> 3], bitorder="little")
            flags = flags[lo & 7 :][: hi - lo].astype(bool)
            block = lo // RANK_BITS
            first = int(ranks[block]) + int(
                np.unpackbits(bitmap[block * RANK_BITS // 8 : (lo + 7) >> 3], bitorder="little")[: lo - block * RANK_BITS].sum()
            )
            where = where[flags]
            lo, hi = first, first + len(where)
        return out


def words_stand_alone(tokenizer: str) -> bool:
    """Whether a tokenizer file's first cut drops white space, so that no token joins two words."""
    with open(tokenizer, encoding="utf-8") as source:
        first = json.load(source).get("pre_tokenizer") or {}
    while first.get("type") == "Sequence" and first["pretokenizers"]:
        first = first["pretokenizers"][0]
    if first.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer"):
        return True
    pattern = first.get("pattern", {}).get("Regex", "")
    # What the pattern matches stays, the rest goes: it must not match a space anywhere.
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    return bool(drops and pattern) and not any(regex.search(pattern, s) for s in (" ", "\n", "\t"))


#: A first cut that takes runs of letters, single digits and runs of other characters.
RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_NORMALISERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def runs_stand_alone(tokenizer: str) -> bool:
    """Whether a tokenizer file lower-cases and cuts words into `RUNS`: `Runs` may then be encoded one by one."""
    with open(tokenizer, encoding="utf-8") as source:
        parts = json.load(source)
    normaliser, cut = parts.get("normalizer") or {}, parts.get("pre_tokenizer") or {}
    steps = normaliser.get("normalizers", []) if normaliser.get("type") == "Sequence" else [normaliser]
    cuts = cut.get("pretokenizers", []) if cut.get("type") == "Sequence" else [cut]
    first = {"type": "Split", "pattern": {"Regex": RUNS}, "behavior": "Removed", "invert": True}
    whole = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    taken = [a for a in parts.get("added_tokens", []) if a.get("normalized") or a.get("single_word") or not _MARKED.fullmatch(a["content"])]
    return not taken and (
        all(s in PLAIN_NORMALISERS for s in steps) and PLAIN_NORMALISERS[-1] in steps
        and cuts[:1] == [first] and all({k: c.get(k) for k in whole} == whole for c in cuts[1:])
    )


_PRINTED = np.array([32 < i < 127 for i in range(256)])
_PLAIN = np.array([i < 128 and chr(i).isalnum() for i in range(256)])
_MARK = _PRINTED & ~_PLAIN
_LATIN = np.array([128 <= i < 192 and i not in (0x97, 0xB7) for i in range(256)])  # letters after 0xC3
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


_MARKED = re.compile(r"[!-/:-@\[-`{-~][!-~]*")  # a mark first, no white space


class Runs(Words):
    """Words without the ASCII marks at their ends, and those marks as words of their own.

    A word is cut only after an ASCII letter or digit or a letter of U+00C0-U+00FF, where `RUNS` cuts it too;
    marks of more than `LONGEST` bytes stay with their word. The hash takes A-Z as a-z, but not before a
    character that may be a combining one, as those compose with capitals otherwise. Words that hold one of
    the byte strings `whole`, in capitals or not, stay as they are.
    """

    LONGEST = 16

    def __init__(self, texts: pa.Array, whole: list[bytes] = ()):
        self.whole = re.compile(b"|".join(re.escape(w) for w in whole), re.IGNORECASE) if whole else None
        super().__init__(texts, lower=False)

    def _cut(self) -> None:
        raw, marks = self.raw, np.zeros(len(self.start), np.int64)
        found = [m.start() for m in self.whole.finditer(raw)] if self.whole and len(raw) else []
        kept = np.unique(np.searchsorted(self.start, found, "right") - 1) if found else np.zeros(0, np.int64)
        self.kept = self.start[kept], self.end[kept]
        on = np.flatnonzero(_MARK[raw[self.end - 1]])
        for n in range(1, self.LONGEST + 1):
            marks[on] = n
            on = on[self.end[on] - n > self.start[on]]
            on = on[_MARK[raw[self.end[on] - n - 1]]]
        marks[on] = 0
        marks[kept] = 0
        some = np.flatnonzero(marks)
        at = self.end[some] - marks[some]
        inside = at > self.start[some]
        some, at = some[inside], at[inside]
        latin = _LATIN[raw[at - 1]] & (raw[np.maximum(at - 2, 0)] == 0xC3) & (at - 2 >= self.start[some])
        right = _PLAIN[raw[at - 1]] | latin
        some, at = some[right], at[right]
        self.start = np.insert(self.start, some + 1, at)
        self.end = np.insert(self.end, some, at)
        self.first = self.first + np.searchsorted(some, self.first)

    def _folded(self, lower: bool) -> np.ndarray:
        after = np.append(self.raw[1:], 0)
        fold = (after < 128) | (after == 0xC3)
        if len(self.kept[0]):
            inside = np.zeros(len(self.raw) + 1, np.int8)
            inside[self.kept[0]] += 1
            inside[self.kept[1]] -= 1
            fold &= np.cumsum(inside[:-1], dtype=np.int8) == 0
        return np.where(fold, LOWER[self.raw], self.raw)


class TextEncoder:
    """Ids of whole texts under any tokenizer, each text given to the library as it is."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts): the ids of all texts, `end_id` after each, and where each text starts."""
        flat, sizes = self.ids_of(["" if t is None else t for t in texts.to_pylist()])
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        return np.insert(flat, np.cumsum(sizes), np.uint32(end_id)), starts


class WordEncoder(TextEncoder):
    """Ids of whole texts under a tokenizer that never joins across ASCII spaces (`words_stand_alone`).

    Each distinct word, or run of `Runs` where the tokenizer cuts those apart itself, is given to the library
    once as long as it stays in a bounded cache; the ids of a text are those of its words in order. The cache is sorted arrays, about 30 bytes a word, so that
    a worker holds the words of a large part of a corpus; it is emptied when it has `CACHED` words.
    """

    CACHED = 4_000_000

    JOINED = 512  # words that the library gets at a time

    def __init__(self, path: str):
        super().__init__(path)
        self.between = self._separator(path)
        self.runs = runs_stand_alone(path)
        self.last = self._last_ids() if self.runs else None
        self.whole = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def _last_ids(self) -> np.ndarray | None:
        """Which ids end a run, if every run ends with such an id and has none elsewhere."""
        model = json.loads(self.tokenizer.to_str())["model"]
        suffix, known = model.get("end_of_word_suffix"), self.tokenizer.get_vocab(with_added_tokens=False)
        letters = [t for t in known if len(t) == 1]
        if model.get("type") != "BPE" or not suffix or model.get("dropout") or len(letters) < 256 or not all(c + suffix in known for c in letters):
            return None
        out = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        out[[i for t, i in known.items() if t.endswith(suffix)]] = True
        return out

    def _separator(self, path: str) -> tuple[bytes, int] | None:
        """A special token that may stand between words, cuts the text and has an id of its own."""
        with open(path, encoding="utf-8") as source:
            added = json.load(source).get("added_tokens", [])
        plain = [a for a in added if a.get("special") and not (a.get("lstrip") or a.get("rstrip") or a.get("single_word"))]
        return (plain[0]["content"].encode(), plain[0]["id"]) if plain else None

    def ids_of_runs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """`ids_of_words`; words of letters alone are one run each and go to the library as one text, cut
        again where an id ends a run."""
        if self.last is None:
            return self.ids_of_words(words)
        pure = np.fromiter((_LETTERS.fullmatch(w) is not None for w in words), bool, len(words))
        letters = [words[i] for i in np.flatnonzero(pure).tolist()]
        groups = [letters[i : i + self.JOINED] for i in range(0, len(letters), self.JOINED)]
        lists = self.tokenizer.encode_batch_fast([b" ".join(g).decode("utf-8") for g in groups], add_special_tokens=False)
        sizes, begins, flat, at = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], 0
        where = np.flatnonzero(pure)
        for k, (group, found) in enumerate(zip(groups, lists)):
            ids = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(group) and ends[-1] == len(ids):
                size = np.diff(ends, prepend=0)
            else:
                ids, size = self.ids_of_words(group)
            some = where[k * self.JOINED : k * self.JOINED + len(group)]
            sizes[some], begins[some] = size, at + np.cumsum(size) - size
            flat.append(ids)
            at += len(ids)
        where = np.flatnonzero(~pure)
        if len(where):
            ids, size = self.ids_of_words([words[i] for i in where.tolist()])
            sizes[where], begins[where] = size, at + np.cumsum(size) - size
            flat.append(ids)
        total = np.cumsum(sizes) - sizes
        return np.concatenate(flat)[np.repeat(begins - total, sizes) + np.arange(int(sizes.sum()))], sizes

    def ids_of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """`ids_of` for words. Many words go to the library as one text with a special token between them,
        as most of the time for a word alone goes into making its result. Where the words don't come back
        one for one, a word holds that token's text: those words are encoded one by one."""
        if self.between is None:
            return self.ids_of([w.decode("utf-8") for w in words])
        mark, number = self.between
        groups = [words[i : i + self.JOINED] for i in range(0, len(words), self.JOINED)]
        lists = self.tokenizer.encode_batch_fast([mark.join(g).decode("utf-8") for g in groups], add_special_tokens=False)
        flat, sizes = [], []
        for group, found in zip(groups, lists):
            ids = np.array(found.ids, np.uint32)
            cuts = np.flatnonzero(ids == number)
            if len(cuts) == len(group) - 1:
                flat.append(np.delete(ids, cuts))
                sizes.append(np.diff(cuts, prepend=-1, append=len(ids)) - 1)
            else:
                one, size = self.ids_of([w.decode("utf-8") for w in group])
                flat.append(one)
                sizes.append(size)
        return np.concatenate(flat), np.concatenate(sizes)

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.slots = np.zeros(0, np.int32)  # of each key, its number in `ends`
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _slots(self, hashes: np.ndarray, words: Words, where: np.ndarray) -> np.ndarray:
        """The slot of each of the sorted hashes; `where` names a word of each."""
        at = np.searchsorted(self.keys, hashes)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == hashes[known]
        new = np.flatnonzero(~known)
        if len(new):
            raw, spots = words.raw.tobytes(), where[new]
            spans = zip(words.start[spots].tolist(), words.end[spots].tolist())
            flat, sizes = (self.ids_of_runs if self.runs else self.ids_of_words)([raw[a:b] for a, b in spans])
            slots = np.arange(len(self.keys), len(self.keys) + len(new), dtype=np.int32)
            self.ends = np.concatenate([self.ends, np.cumsum(sizes) + self.ends[-1]])
            self.flat = np.concatenate([self.flat, flat])
            self.slots = np.insert(self.slots, at[new], slots)
            self.keys = np.insert(self.keys, at[new], hashes[new])
            at = np.searchsorted(self.keys, hashes)
        return self.slots[at]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        words = Runs(texts, self.whole) if self.runs else Words(texts, lower=False)
        if len(self.keys) > self.CACHED:
            self.clear()
        hashes, where, back = np.unique(words.hash, return_index=True, return_inverse=True)
        slots = self._slots(hashes, words, where)[back]
        begin, length = self.ends[slots], self.ends[slots + 1] - self.ends[slots]
        total = np.concatenate([[0], np.cumsum(length)])
        n_docs = len(words.first) - 1
        starts = total[words.first] + np.arange(n_docs + 1)
        doc_of_word = np.repeat(np.arange(n_docs), np.diff(words.first))
        out = np.empty(int(total[-1]) + n_docs, np.uint32)
        out[starts[1:] - 1] = end_id
        source = np.repeat(begin - total[:-1], length) + np.arange(total[-1])
        target = np.arange(total[-1]) + np.repeat(doc_of_word, length)
        out[target] = self.flat[source]
        return out, starts


_encoders: dict[str, TextEncoder] = {}


def encoder_of(path: str) -> TextEncoder:
    """The worker's encoder for a file; its cache serves all tasks that the worker runs."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path) if words_stand_alone(path) else TextEncoder(path)
    return _encoders[path]


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode and write all documents; a table (part, number, path, n_docs, n_tokens, start) of files.

    Runs once, when called. Documents are in ascending doc_id order, ties by text; null doc_ids come
    first and are marked in the file; null and empty texts have only the end id; repeated rows are
    documents of their own. An empty table gives no files. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")

    def run(batches):
        encoder, part, number = encoder_of(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        held = 0

        def flush():
            starts = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
            path = write_file(folder, f"{part:06d}-{number:06d}", encode_file(doc_ids, starts, np.concatenate(ids)))
            row = [[part], [number], [path], [len(doc_ids)], [int(starts[-1])]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(row, kinds)], ["part", "number", "path", "n_docs", "n_tokens"]
            )

        for batch in batches:
            for piece in pieces(batch, 1, 1 << 21):
                own, starts = encoder.encode(piece.column(1), end_id)
                if held and held + len(own) > FILE_TOKENS:
                    yield flush()
                    doc_ids, ids, lengths, held, number = [], [], [], 0, number + 1
                doc_ids += piece.column(0).to_pylist()
                ids.append(own)
                lengths.append(np.diff(starts))
                held += len(own)
        if doc_ids:
            yield flush()

    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    files = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(
        run, "part int, number int, path string, n_docs long, n_tokens long"
    )
    files = written(files, "token-files")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""

    def run(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = DacFile(read_file(path))
                starts = file.starts.astype(np.int64)
                for lo in range(0, file.n_docs, 4096):
                    hi = min(lo + 4096, file.n_docs)
                    # Whole runs of documents are read at once; each document is a slice of the run.
                    ids = file.slice(int(starts[lo]), int(starts[hi]))
                    cuts = (starts[lo : hi + 1] - starts[lo]).tolist()
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cuts, cuts[1:])]
                    valid = file.valid[lo:hi].astype(bool)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(file.doc_ids[lo:hi]), pa.int64(), mask=~valid),
                            pa.array(starts[lo:hi] + base),
                            pa.array(np.diff(starts[lo : hi + 1])),
                            pa.array(crc, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    # A row is a whole file: the number of partitions follows the number of files, not the rows' bytes.
    spread = files.select("path", "start").repartition(max(1, files.count()), "path")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(files: DataFrame, positions: DataFrame, position: str = "position") -> DataFrame:
    """(position, id) for a stated list of token positions, by random access. The positions meet the
    files by a range join on the files' starts, on buckets of FILE_TOKENS positions."""
    spans = files.where("n_tokens > 0").select(
        "path", F.col("start").alias("lo"), (F.col("start") + F.col("n_tokens")).alias("hi")
    ).withColumn("cell", F.explode(F.expr(f"sequence(lo div {FILE_TOKENS}, (hi - 1) div {FILE_TOKENS})")))
    asked = positions.select(F.col(position).cast("long").alias("position")).withColumn(
        "cell", F.expr(f"position div {FILE_TOKENS}")
    )
    met = asked.join(spans, "cell").where("position >= lo and position < hi")

    def run(batches):
        files: dict[str, DacFile] = {}
        for batch in batches:
            paths, lo, at = (batch.column(k).to_pylist() for k in range(3))
            ids = []
            for p, a, b in zip(paths, lo, at):
                if p not in files:
                    files = {p: DacFile(read_file(p))}
                ids.append(files[p].token(b - a))
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(ids, pa.int64())], ["position", "id"])

    return met.select("path", "lo", "position").mapInArrow(run, "position long, id long")
