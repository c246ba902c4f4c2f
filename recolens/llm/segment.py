"""Distinct sampled segmentations of whole texts under a SentencePiece vocabulary, and decoding.

The lattice of a text has a node per character and an edge per piece that fits; a segmentation is a
path, with a probability proportional to the exponential of its edges' weights. The Gumbel top-k trick
draws k paths without replacement: give every path its log-probability plus a Gumbel variate, take the
k largest. They are found best first, as in A* sampling: the set of all paths that share a prefix has
an exactly known log-mass (the backward sums of the lattice, an exact heuristic), so the largest
perturbed value in it is one Gumbel variate at that mass. Taking the best set off the queue fixes its
best path, which is drawn from the lattice, and splits the rest by the first edge where it differs:
each part gets a Gumbel variate truncated at the value of the path.

No piece joins characters across the start of a run of spaces or a line feed, so the lattice falls
into units there. The sums are computed once per distinct unit of a batch, and paths and queue entries
are arrays over all texts of the batch.

The (k + 1)-th largest value is the threshold of the sample: a path of log-probability l is included
with the probability 1 - exp(-exp(l - threshold)), its inclusion score.

All random numbers are hashes of the row's key, the sample's number and the place in the text, so a
row's samples do not depend on partitioning, batches or repeated tasks.

The vocabulary is a byte-pair model without probabilities: the weight of a piece is -log(2 + rank) by
its merge rank, that of a byte is -log(2 + vocabulary size); characters without a piece are bytes.
"""

from __future__ import annotations

import os
import zlib
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from recolens.llm.tokens import BASE, BASE_INVERSE, buffers, mix, pieces, powers

SPACE_MARK = "▁"
SAMPLES = 2
#: Text that a task works on at once. A worker needs about 130 MB and 120 times this; smaller pieces share
#: fewer equal units, larger ones don't fit the caches that the tasks of a machine share. It changes no result.
PIECE_BYTES = 1 << 18
NEVER = -np.inf
#: Sums of probabilities are plain numbers while their logarithm is surely within this, of 708 in a double.
LOG_RANGE = 600.0
#: Bytes of the character that a byte starts, 0 within one.
FOLLOW = np.repeat(np.array([1, 0, 2, 3, 4], np.uint8), [0x80, 0x40, 0x20, 0x10, 0x10])
KIND_BITS = 18
KIND_SHIFT = np.uint64(64 - KIND_BITS)


class Pieces:
    """The vocabulary as byte strings (a space for the space mark), their trie and weights."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        self.byte_ids = np.full(256, sp.unk_id(), np.int64)
        texts, by_length = [b""] * n, {}
        for i in range(n):
            if sp.is_byte(i):
                value = int(sp.id_to_piece(i)[3:5], 16)
                self.byte_ids[value], texts[i] = i, bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                texts[i] = sp.id_to_piece(i).replace(SPACE_MARK, " ").encode()
                by_length.setdefault(len(texts[i]), []).append((i, -np.log(2.0 - sp.get_score(i))))
        self.byte_weight = -float(np.log(2.0 + n))
        self.texts = texts
        self.flat = np.frombuffer(b"".join(texts), np.uint8)
        self.size = np.array([len(t) for t in texts], np.int64)
        self.ends = np.concatenate([[0], np.cumsum(self.size)])
        self._grow(by_length)

    @cached_property
    def tables(self) -> dict:
        """Per length the hashes of the pieces, sorted, and their ids: the vocabulary without the trie."""
        out = {}
        for length in np.unique(self.size[self.lattice_ids]).tolist():
            ids = self.lattice_ids[self.size[self.lattice_ids] == length]
            hashes = self._starts(ids, length)[:, -1]
            order = np.argsort(hashes)
            out[length] = hashes[order], ids[order]
        return out

    @cached_property
    def kinds(self) -> dict:
        """Per length, what a hash's first bits may be: 1 the start of a longer piece, 2 a piece."""
        out = {length: np.zeros(1 << KIND_BITS, np.uint8) for length in range(1, self.longest + 1)}
        for length, (_, ids) in self.tables.items():
            at = (self._starts(ids, length) >> KIND_SHIFT).astype(np.int64)
            for k in range(1, length + 1):
                out[k][at[:, k - 1]] |= 2 if k == length else 1
        return out

    def _starts(self, ids: np.ndarray, length: int) -> np.ndarray:
        raw = self.flat[self.ends[ids][:, None] + np.arange(length)].astype(np.uint64)
        return np.cumsum((raw + np.uint64(1)) * powers(BASE, length), axis=1, dtype=np.uint64)

    def _grow(self, by_length: dict) -> None:
        """The trie of the pieces: `step[row + code of a byte]` is the next state, 0 for none."""
        own = [i for _, of_length in sorted(by_length.items()) for i in of_length]
        size = np.array([len(self.texts[i]) for i, _ in own], np.int64)
        at = np.array([self.ends[i] for i, _ in own], np.int64)
        self.lattice_ids = np.array([i for i, _ in own], np.int64)
        used = np.unique(self.flat)
        self.code = np.zeros(256, np.int64)  # 0 for a byte that no piece has
        self.code[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        self.longest = int(size.max(initial=0))
        state, states, edges, ids = np.ones(len(own), np.int64), 2, [], [np.full(2, -1)]
        for k in range(self.longest):
            on = np.flatnonzero(size > k)
            keys, of = np.unique(state[on] * 256 + self.flat[at[on] + k], return_inverse=True)
            state[on] = states + of
            edges.append((keys, states + np.arange(len(keys))))
            ids.append(np.full(len(keys), -1))
            last = np.flatnonzero(size[on] == k + 1)
            ids[-1][of[last]] = [own[i][0] for i in on[last]]
            states += len(keys)
        self.id_of, self.weight = np.concatenate(ids), np.zeros(len(self.texts))
        self.weight[self.lattice_ids] = [w for _, w in own]
        self.factor = np.exp(self.weight)
        keys, to = (np.concatenate(x) for x in zip(*edges)) if edges else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        inner, of = np.unique(keys >> 8, return_inverse=True)
        self.row = np.full(states, -1)
        self.row[inner] = np.arange(len(inner)) * width
        self.step = np.zeros(max(len(inner), 1) * width, np.int32)
        self.step[of * width + self.code[keys & 255]] = to

    @classmethod
    def of(cls, model_file: str) -> Pieces:
        """The vocabulary of a file, read once by a process that serves several tasks."""
        held = os.stat(model_file)
        return _read(model_file, held.st_mtime_ns, held.st_size)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that a sequence of ids stands for."""
        length = self.size[ids]
        total = np.concatenate([[0], np.cumsum(length)])
        return self.flat[np.repeat(self.ends[ids] - total[:-1], length) + np.arange(total[-1])]


@lru_cache(maxsize=1)
def _read(model_file: str, changed: int, size: int) -> Pieces:
    return Pieces(model_file)


def normalised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts): a space before every text that isn't empty, space marks as spaces."""
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), SPACE_MARK, " ")
    none, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    texts = pc.binary_join_element_wise(pc.if_else(pc.equal(texts, none), none, space), texts, none)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def flattened(starts: np.ndarray, lengths: np.ndarray, gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Positions starts[i] .. starts[i] + lengths[i] - 1 one after another, `gap` more for each; begins."""
    wide = lengths + gap
    begins = np.concatenate([[0], np.cumsum(wide)])
    return np.repeat(starts - begins[:-1], wide) + np.arange(begins[-1]), begins


class Lattices:
    """The lattices of the distinct units of a batch: edges in order of their node, with probabilities.

    Nodes are ordered by the bytes left in their unit, then by unit, the longest first: the node of unit k
    with r bytes left is level[r] + k, so the backward sums read and write whole ranges.
    """

    def __init__(self, pieces_: Pieces, raw: np.ndarray, starts: np.ndarray):
        n = len(raw)
        begins = np.zeros(n, bool)
        begins[starts[:-1][starts[:-1] < starts[1:]]] = True
        space, line = raw == 32, raw == 10
        begins[1:] |= (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
        self.unit_start = np.flatnonzero(begins)
        unit_length = np.diff(np.append(self.unit_start, n))
        values = (raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values, dtype=np.uint64, out=sums[1:])
        inverse = powers(BASE_INVERSE, n + 1)
        hashes = mix((sums[self.unit_start + unit_length] - sums[self.unit_start]) * inverse[self.unit_start])
        _, where, unit = np.unique(hashes, return_index=True, return_inverse=True)
        length = unit_length[where]
        order = np.argsort(-length, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        unit, length = rank[unit], length[order]
        end = self.unit_start[where[order]] + length
        many = np.cumsum(np.bincount(length)[::-1])[::-1]  # units of at least so many bytes
        level = np.concatenate([[0], np.cumsum(many)])
        nodes = int(level[-1])
        rest = np.repeat(np.arange(len(many)), many)
        inner = slice(len(length), None)  # all nodes but the units' ends
        source = end[np.arange(len(length), nodes) - level[rest[inner]]] - rest[inner]
        follow = np.zeros(nodes, np.uint8)
        follow[inner] = FOLLOW[raw[source]]
        active = heads = np.flatnonzero(follow)
        # An edge as one number: its node, its place among the node's edges, its piece + 1.
        id_bits, place_bits = len(pieces_.texts).bit_length(), (pieces_.longest + 1).bit_length()
        edges = []
        alone = np.zeros(nodes, bool)
        # Every node walks down the trie of the pieces while it may still be the start of one.
        at = source[active - len(length)]
        row, codes = np.full(len(active), max(pieces_.row[1], 0)), pieces_.code[raw]
        for size in range(1, pieces_.longest + 1):
            state = pieces_.step[row + codes[at]]
            found = pieces_.id_of[state]
            hit = np.flatnonzero(found >= 0)
            p = active[hit]
            edges.append((p << place_bits | size) << id_bits | found[hit] + 1)
            if size <= 4:
                alone[p[follow[p] == size]] = True
            if size + 1 >= len(many):
                break
            more = int(np.searchsorted(active, level[size + 1]))  # nodes from here on have more bytes left
            row = pieces_.row[state[more:]]
            on = np.flatnonzero(row >= 0)
            if not len(on):
                break
            row = row[on]
            on += more
            active, at = active[on], at[on] + 1
        bare = heads[~alone[heads]]
        edges.append((bare << place_bits | pieces_.longest + 1) << id_bits)
        edges = np.sort(np.concatenate(edges))
        self.id = ((edges & (1 << id_bits) - 1) - 1).astype(np.int32)
        edges >>= id_bits
        self.node = edges >> place_bits
        self.size = (edges & (1 << place_bits) - 1).astype(np.min_scalar_type(max(pieces_.longest + 1, 4)))
        spelled = np.flatnonzero(self.id < 0)
        self.size[spelled] = follow[self.node[spelled]]
        degree = np.bincount(self.node, minlength=nodes)
        self.first_edge = np.concatenate([[0], np.cumsum(degree)])
        del edges, follow, alone, source, values, active, at, row, sums, hashes
        # The node that an edge leads to has as many bytes left less, in the same unit.
        left = rest[self.node]
        onto = self.node - level[left]
        left -= self.size
        onto += level[left]
        #: The first edge of the node that an edge leads to, -1 at the end of the unit.
        self.after = np.where(left > 0, self.first_edge[onto], -1)
        self.begin = self.first_edge[level[length] + np.arange(len(length))][unit]
        # Backward sums, all nodes with the same number of bytes left at once: as plain numbers while the
        # least of them is surely one, then as logarithms.
        plain = int(LOG_RANGE / max(np.abs(pieces_.weight).max(), -pieces_.byte_weight))
        factor = pieces_.factor[self.id]
        factor[spelled] = np.exp(pieces_.byte_weight * self.size[spelled])
        mass, self.q = np.ones(nodes), np.empty(len(self.id))
        first = self.first_edge[heads]
        edge_cuts, head_cuts = self.first_edge[level].tolist(), np.searchsorted(heads, level).tolist()
        for r in range(1, len(many)):
            e, h = slice(*edge_cuts[r : r + 2]), slice(*head_cuts[r : r + 2])
            if h.start == h.stop:
                continue
            if r <= plain:
                self.q[e] = factor[e] * mass[onto[e]]
                mass[heads[h]] = np.add.reduceat(self.q[e], first[h] - e.start)
                continue
            if plain >= 0:  # the first level beyond
                below = edge_cuts[r]
                self.q[:below] /= mass[self.node[:below]]
                mass, plain = np.log(mass), -1
                w = pieces_.weight[self.id]
                w[spelled] = pieces_.byte_weight * self.size[spelled]
            x = w[e] + mass[onto[e]]
            mass[heads[h]] = np.logaddexp.reduceat(x, first[h] - e.start)
            self.q[e] = np.exp(x - mass[self.node[e]])
        if plain >= 0:
            self.q /= mass[self.node]
        #: Per edge the probability of its node's edges up to it, beyond 1 for the last.
        self.upto = np.cumsum(self.q)
        self.upto -= np.repeat(self.upto[first] - self.q[first], degree[heads])
        self.upto[self.first_edge[heads + 1] - 1] = 2.0

    def choose(self, first: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge from each node, given by its first edge, by its probability; u is uniform."""
        e = first.copy()
        on = np.flatnonzero(self.upto[e] <= u)
        own, u = e[on] + 1, u[on]
        while len(on):
            e[on] = own
            more = np.flatnonzero(self.upto[own] <= u)
            on, own, u = on[more], own[more] + 1, u[more]
        return e


def seeds(keys: np.ndarray, sample: int, kind: int) -> np.ndarray:
    """What the numbers of a row come from, by its key, the sample and the use."""
    return mix(keys + np.uint64((2 * sample + kind + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))


def uniform(seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from the row's seed and the byte position in the text."""
    x = mix(seed ^ (place.astype(np.uint64) * np.uint64(BASE)))
    x >>= np.uint64(11)
    out = x.astype(np.float64)
    out += 0.5
    out *= 2.0**-53
    return out


class Sampler:
    """Draws the samples of all texts of a batch."""

    def __init__(self, pieces_: Pieces, texts: pa.Array, keys: np.ndarray):
        self.pieces = pieces_
        self.raw, self.starts = normalised(texts)
        self.n_docs, self.keys = len(self.starts) - 1, keys
        self.some = self.starts[:-1] < self.starts[1:]
        if len(self.raw):
            self.lattices = Lattices(pieces_, self.raw, self.starts)
            # The document and the lattice node of every byte that starts a unit.
            self.doc_of_unit = self._docs(np.searchsorted(self.lattices.unit_start, self.starts))

    def _docs(self, cuts: np.ndarray) -> np.ndarray:
        """The document of each of some places in order, of which document d has cuts[d] .. cuts[d + 1] - 1."""
        return np.repeat(np.arange(self.n_docs), np.diff(cuts))

    def _walk(self, path: np.ndarray, place: np.ndarray, first: np.ndarray, doc: np.ndarray, sample: int) -> None:
        """Draw edges from the nodes with the given first edges to the ends of their units into path[byte]."""
        t = self.lattices
        seed, origin = seeds(self.keys, sample, 0)[doc], self.starts[doc]
        while len(place):
            e = t.choose(first, uniform(seed, place - origin))
            path[place] = e
            first = t.after[e]
            on = np.flatnonzero(first >= 0)
            place, first, seed, origin = place[on] + t.size[e[on]], first[on], seed[on], origin[on]

    def _regions(self, path, sample, from_place, barred):
        """(place, document, lateness) of the sets that leave the path at a place, and its log-probability.

        from_place: the byte of each document from which on sets are new; barred: probability at that
        byte which earlier samples have taken. The perturbed value of a set falls with its lateness: it is
        a Gumbel variate at the set's mass, truncated at the path's value, -logaddexp(-value, lateness).
        """
        t = self.lattices
        place = np.flatnonzero(path >= 0)
        cut = np.searchsorted(place, self.starts)
        q = t.q[path[place]]
        total = np.concatenate([[0.0], np.cumsum(np.log(q))])
        left = np.subtract(1.0, q, out=q)
        some = np.flatnonzero(barred)
        left[np.searchsorted(place, from_place[some])] -= barred[some]
        on = np.flatnonzero(left > 1e-12)
        doc = self._docs(np.searchsorted(on, cut))
        own = place[on]
        if (from_place > self.starts[:-1]).any():
            new = np.flatnonzero(own >= from_place[doc])
            on, doc, own = on[new], doc[new], own[new]
        late = -np.log(uniform(seeds(self.keys, sample, 1)[doc], own - self.starts[doc]))
        late /= left[on]
        np.log(late, out=late)
        late -= total[on]
        late += total[cut[:-1]][doc]
        return own, doc, late, total[cut[1:]] - total[cut[:-1]]

    def samples(self, k: int):
        """Per sample: (documents, path, log-probability, perturbed value); then the thresholds."""
        n = self.n_docs
        if not len(self.raw):
            return [], np.full(n, NEVER)
        t = self.lattices
        value = -np.log(-np.log(uniform(seeds(self.keys, 0, 1), np.full(n, 2**40))))
        path = np.full(len(self.raw), -1, np.int64)
        self._walk(path, t.unit_start, t.begin, self.doc_of_unit, 0)
        from_place, barred = self.starts[:-1].copy(), np.zeros(n)
        out, queue = [], []  # queue: (places, docs, lateness, value of the path) of the sets not yet taken
        paths, bars, begun = [path], [[[] for _ in range(n)]], [from_place]
        alive = self.some.copy()
        for j in range(k):
            path = paths[j]
            place, doc, late, log_p = self._regions(path, j, from_place, barred)
            queue.append((place, doc, late, value))
            out.append((np.flatnonzero(alive), path, log_p, value))
            best, which, index = np.full(n, NEVER), np.full(n, -1), np.full(n, -1)
            for s, (_, d, late, own) in enumerate(queue):
                if len(d):
                    cuts = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
                    least = np.minimum.reduceat(late, cuts)
                    lead = np.flatnonzero(late == np.repeat(least, np.diff(np.append(cuts, len(d)))))[::-1]
                    v = -np.logaddexp(-own[d[lead]], late[lead])
                    over = v > best[d[lead]]
                    lead, v = lead[over], v[over]
                    best[d[lead]], which[d[lead]], index[d[lead]] = v, s, lead
            if j == k - 1:
                return out, best
            # Take the best set of each document and draw its best path.
            alive = which >= 0
            path = np.full(len(self.raw), -1, np.int64)
            bar = [[] for _ in range(n)]
            value, from_place, barred = best.copy(), self.starts[:-1].copy(), np.zeros(n)
            resume = np.full(n, len(self.raw) + 1, np.int64)
            at_place, at_first, at_doc = [], [], []
            places = np.zeros(n, np.int64)
            for s, (own, *_) in enumerate(queue):
                of = np.flatnonzero(which == s)
                places[of] = own[index[of]]
            chance = uniform(seeds(self.keys, j + 1, 0), places - self.starts[:-1]).tolist()
            for d in np.flatnonzero(alive).tolist():
                s, i, place = int(which[d]), int(index[d]), int(places[d])
                queue[s][2][i] = -NEVER
                old = paths[s]
                lo = int(self.starts[d])
                path[lo:place] = old[lo:place]
                edge = int(old[place])
                taken = [edge, *(bars[s][d] if int(begun[s][d]) == place else [])]
                first, last = int(t.first_edge[t.node[edge]]), int(t.first_edge[t.node[edge] + 1])
                free = [x for x in range(first, last) if x not in taken]
                odds = np.cumsum(t.q[free])
                new = free[min(int(np.searchsorted(odds, chance[d] * odds[-1], "right")), len(free) - 1)]
                path[place] = new
                bar[d], from_place[d], barred[d] = taken, place, float(t.q[taken].sum())
                after, then = place + int(t.size[new]), int(t.after[new])
                resume[d] = after
                if then >= 0:
                    at_place.append(after)
                    at_first.append(then)
                    at_doc.append(d)
            rest = np.flatnonzero(t.unit_start >= resume[self.doc_of_unit])
            self._walk(
                path,
                np.concatenate([np.array(at_place, np.int64), t.unit_start[rest]]),
                np.concatenate([np.array(at_first, np.int64), t.begin[rest]]),
                np.concatenate([np.array(at_doc, np.int64), self.doc_of_unit[rest]]),
                j + 1,
            )
            paths.append(path)
            bars.append(bar)
            begun.append(from_place)
        raise AssertionError("unreachable")

    def ids(self, path: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the piece ids along a path for the given documents, bytes written out."""
        t = self.lattices
        place = np.flatnonzero(path >= 0)
        e = path[place]
        own, count = t.id[e], np.ones(len(e), np.int64)
        spelled = np.flatnonzero(own < 0)
        count[spelled] = t.size[e[spelled]]
        total = np.concatenate([[0], np.cumsum(count)])
        out = np.repeat(own, count)
        byte, to = (flattened(x[spelled], count[spelled])[0] for x in (place, total))
        out[to] = self.pieces.byte_ids[self.raw[byte]]
        return out.astype(np.int32), total[np.searchsorted(place, self.starts)]


SAMPLED = (
    "doc_id long, sample int, ids array<int>, ids_crc32 long, n_pieces long, log_prob double, perturbed double, log_inclusion double, "
    "decoded boolean, restored boolean"
)


def row_keys(ids: pa.Array) -> np.ndarray:
    return mix(pc.fill_null(ids, -1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) + np.uint64(1))


def encode_samples(
    docs: DataFrame,
    model_file: str,
    samples: int = SAMPLES,
    with_ids: bool = True,
    piece_bytes: int = PIECE_BYTES,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, sample, ids, ids_crc32, n_pieces, log_prob, perturbed, inclusion, decoded, restored), up
    to `samples` rows per row; log_inclusion is the natural logarithm of the inclusion score; ids is null without `with_ids`, ids_crc32 is that of its little-endian uint32.

    Samples are numbered from 1 by falling perturbed value and are distinct; a text with fewer
    segmentations gives fewer, each then with the log_inclusion 0. Null and empty texts have the one
    empty segmentation. `decoded` tells whether the ids spell the normalised text again, `restored` whether what
    `decode_ids` gives back is the text itself (not so where it holds U+2581). Rows are seeded by
    doc_id (null counts as -1): repeated rows give equal samples. An empty table gives an empty
    result; other columns are ignored.
    """

    names = ["doc_id", "sample", "ids", "ids_crc32", "n_pieces", "log_prob", "perturbed", "log_inclusion", "decoded", "restored"]

    def run(batches):
        known = Pieces.of(model_file)
        for batch in batches:
            for part in pieces(batch, 1, piece_bytes):
                doc_ids = part.column(0).to_pylist()
                sampler = Sampler(known, part.column(1), row_keys(part.column(0)))
                drawn, threshold = sampler.samples(samples)
                given, given_at = buffers(part.column(1))

                def is_text(d, spelled):
                    return np.array_equal(spelled[1:], given[given_at[d] : given_at[d + 1]])

                same = np.array([is_text(d, sampler.raw[a:b]) for d, (a, b) in enumerate(zip(sampler.starts, sampler.starts[1:]))], bool)
                for j, (docs_, path, log_p, value) in enumerate(drawn):
                    ids, ends = sampler.ids(path, docs_)
                    text_of = known.decode(ids.astype(np.int64))
                    # Documents without a path of this number have no ids and are not compared.
                    spelled = np.concatenate(
                        [sampler.raw[sampler.starts[d] : sampler.starts[d + 1]] for d in docs_]
                    ) if len(docs_) else text_of
                    right, restored = np.ones(len(docs_), bool), same[docs_]
                    if len(text_of) != len(spelled) or not (text_of == spelled).all():
                        right = np.array(
                            [
                                np.array_equal(
                                    known.decode(ids[ends[d] : ends[d + 1]].astype(np.int64)),
                                    sampler.raw[sampler.starts[d] : sampler.starts[d + 1]],
                                )
                                for d in docs_
                            ],
                            bool,
                        )
                        restored = np.array([is_text(d, known.decode(ids[ends[d] : ends[d + 1]].astype(np.int64))) for d in docs_], bool)
                    over = np.minimum(log_p[docs_] - threshold[docs_], 700.0)
                    inclusion = np.where(over < -30, over, np.log(-np.expm1(-np.exp(over))))
                    n = (ends[1:] - ends[:-1])[docs_]
                    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets, offsets[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([doc_ids[d] for d in docs_], pa.int64()),
                            pa.array(np.full(len(docs_), j + 1, np.int32)),
                            lists if with_ids else pa.nulls(len(docs_), lists.type),
                            pa.array(crc, pa.int64()), pa.array(n.astype(np.int64)), pa.array(log_p[docs_]),
                            pa.array(value[docs_]), pa.array(inclusion), pa.array(right), pa.array(restored),
                        ],
                        names,
                    )
                bare = np.flatnonzero(~sampler.some)
                if len(bare):
                    k = len(bare)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([doc_ids[d] for d in bare], pa.int64()), pa.array(np.ones(k, np.int32)),
                            pa.array([[] if with_ids else None] * k, pa.list_(pa.int32())),
                            pa.array(np.zeros(k, np.int64)), pa.array(np.zeros(k, np.int64)),
                            pa.array(np.zeros(k)), pa.array(np.zeros(k)), pa.array(np.zeros(k)), pa.array([True] * k), pa.array(same[bare]),
                        ],
                        names,
                    )

    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, SAMPLED)


def decode_ids(encoded: DataFrame, model_file: str, ids: str = "ids") -> DataFrame:
    """`encoded` with a column `text`: the text that each row's ids spell (invalid UTF-8 replaced)."""
    names = [c for c in encoded.columns if c != "text"]
    at = names.index(ids)

    def run(batches):
        known = Pieces.of(model_file)
        for batch in batches:
            texts = []
            for row in batch.column(at):
                raw = known.decode(np.array(row.as_py() or [], np.int64)).tobytes().decode("utf-8", "replace")
                texts.append(raw[1:])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "text"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "text")
    return encoded.select(*names).mapInArrow(run, f"{kinds}, text string")

