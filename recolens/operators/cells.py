"""Exact top-k of many queries among many items without most of the products.

Items are put into cells around a few thousand centroids, fitted on a sample of them, and sorted by (cell, id). Runs
of one cell are pieces, each with its mean and its radius, the distance of the item farthest from the mean. A task
takes a block of queries past all items: what came by shuffle waits in a file, every query meets the pieces nearest
to it first, and then only those that can still change its list, as no item of a piece scores more than
query . mean + |query| * radius. The lists leave once, when all items are through, so no copy of a query and no
partial list is ever moved. What is left out is proven not to count, whatever the vectors; the farther they are from
noise, the more that is.
"""

from __future__ import annotations

import math
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from recolens.operators import scoring
from recolens.operators.skew import cut

MOST_CELLS, CELL_ITEMS = 4096, 256
SAMPLE, ROUNDS = 16, 3  # vectors a centroid is fitted on, about, and how often
FLOATS = 1 << 24  # most numbers of the sample, which the driver fits
PIECE = 2048  # most items of a piece
FIRST = 4  # pieces a query meets first
QUERIES, LIST_ROWS, MASKS = 200_000, 4_000_000, 4_000_000  # that a task holds at most, about
PACK_BYTES = 4 << 20  # items that travel as one
AT_ONCE = 1 << 20  # scores of a tile
MASKS_AT_ONCE = 500_000
TOGETHER = 32  # pieces whose bounds are taken at once
WAITING = 500_000  # cells that are collected before they are ranked
OUT_BATCH = 100_000
_LAST = np.iinfo(np.int64).max

_ITEM = pa.schema(
    [
        ("product_id", pa.string()),
        ("category", pa.string()),
        ("is_cold", pa.bool_()),
        ("place", pa.int64()),
        ("cell", pa.int32()),
        ("vec", pa.list_(pa.float32())),
    ]
)

# Queries that meet the classes of items up to their depth, for scores of their bar or more.
_DEEP = pa.schema([*scoring._QUERY, ("depth", pa.int32()), ("bar", pa.float64())])


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    half = (centroids.astype(np.float64) ** 2).sum(axis=1).astype(np.float32) / 2
    out = np.empty(len(x), np.int32)
    for at in range(0, len(x), 1024):
        out[at : at + 1024] = (x[at : at + 1024] @ centroids.T - half).argmax(axis=1)
    return out


def _centroids(items: DataFrame, n_items: int, classes: int) -> np.ndarray:
    """Centroids of a sample by Lloyd's rounds. They only decide how tight the cells are."""
    cells = max(1, min(MOST_CELLS, n_items // (CELL_ITEMS * classes)))
    wanted = cells * SAMPLE
    drawn = items.where(F.pmod(F.xxhash64("product_id"), F.lit(max(1, n_items // wanted))) == 0).select("vec")
    width = items.select(F.size("vec")).first()[0]
    x = scoring._matrix(drawn.limit(max(1, min(2 * wanted, FLOATS // max(width, 1)))).toArrow()["vec"])
    x = x[np.isfinite(x).all(axis=1)]
    if not len(x):
        return np.zeros((1, width), np.float32)
    centroids = x[np.random.default_rng(7).permutation(len(x))[:cells]].copy()
    for _ in range(ROUNDS):
        of = _nearest(x, centroids)
        n = np.bincount(of, minlength=len(centroids))
        sums = np.stack([np.bincount(of, weights=x[:, d], minlength=len(centroids)) for d in range(width)], axis=1)
        centroids[n > 0] = (sums[n > 0] / n[n > 0, None]).astype(np.float32)
    return centroids


def _item_packs(items: DataFrame, n_items: int, classes: int) -> DataFrame:
    """(pack): items in the order (class, cell, id), many as one Arrow batch; ``place`` numbers them in the order of ids."""
    spark = items.sparkSession
    by_id = F.col("product_id").asc_nulls_last()
    items = cut(items)  # the bounds of the ranges and the centroids are taken from it before it is read
    centroids = _centroids(items, n_items, classes)
    placed = items.repartitionByRange(by_id).sortWithinPartitions(by_id).withColumn("place", F.monotonically_increasing_id())

    def deal(batches):
        for batch in batches:
            x = np.nan_to_num(scoring._matrix(batch.column("vec"))) if batch.num_rows else np.empty((0, centroids.shape[1]))
            cell = _nearest(x.astype(np.float32, copy=False), centroids) + MOST_CELLS * batch["c"].to_numpy()
            yield batch.drop_columns(["c"]).append_column("cell", pa.array(cell, pa.int32()))

    def pack(batches):
        held, size = [], 0

        def packed():
            table = pa.Table.from_batches(held).select(_ITEM.names).cast(_ITEM).combine_chunks()
            return pa.RecordBatch.from_arrays([pa.array([b.serialize().to_pybytes() for b in table.to_batches()], pa.binary())], ["pack"])

        for batch in batches:
            while batch.num_rows:
                rows = max(1, min(batch.num_rows, math.ceil((PACK_BYTES - size) * batch.num_rows / max(batch.nbytes, 1))))
                held.append(batch.slice(0, rows))
                size += held[-1].nbytes
                batch = batch.slice(rows)
                if size >= PACK_BYTES:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    fields = "product_id string, category string, is_cold boolean, vec array<float>, place bigint, cell int"
    dealt = placed.select("product_id", "category", "is_cold", "vec", "place", "c").mapInArrow(deal, fields)
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(n_items / 500_000))
    return dealt.repartition(parts, "cell").sortWithinPartitions("cell", "place").mapInArrow(pack, "pack binary")


def top_items_by_cells(
    queries: DataFrame,
    items: DataFrame,
    n_queries: int,
    n_items: int,
    k: int,
    masked: DataFrame | None = None,
    exclude_self: bool = False,
    with_range: bool = False,
    per_category: int | None = None,
    classes: int | None = None,
) -> DataFrame:
    """:func:`scoring.top_items`, which says when. ``queries``: query_id, category, n, vec. ``items``: product_id,
    category, is_cold, vec. ``k``: the largest n. The total of a query's scores is not known here.

    Where there are ``classes``, the items have theirs, ``c``, and the queries a ``depth`` and a ``bar``: a query meets
    the classes up to its depth, and only scores of its bar or more come back."""
    spark = queries.sparkSession
    blocks = max(
        math.ceil(n_queries / min(QUERIES, max(1, LIST_ROWS // max(k, 1)))),
        min(2 * spark.sparkContext.defaultParallelism, math.ceil(n_queries / scoring.LEAST_QUERIES)),
        1,
    )
    if masked is not None:
        blocks = max(blocks, math.ceil(masked.count() / MASKS))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("qb")
    known = ["depth", "bar"] if classes else []
    asked = queries.where(F.col("vec").isNotNull()).select(
        block, "query_id", F.lit(None).cast("string").alias("product_id"), "category", "n", "vec", *known
    )
    rows = scoring._packed(asked, _DEEP if classes else scoring._QUERY, ["qb"]).withColumn("kind", F.lit(0))
    if masked is not None:
        pairs = masked.select(block, F.col("query_id").cast("string"), F.col("product_id").cast("string"))
        rows = rows.unionByName(scoring._packed(pairs, scoring._MASK, ["qb"]).withColumn("kind", F.lit(1)))
    offered = items.select("product_id", "category", "is_cold", "vec", F.col("c").cast("int") if classes else F.lit(0).alias("c"))
    packs = _item_packs(offered, n_items, classes or 1).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("qb"), "pack", F.lit(2).alias("kind")
    )
    met = rows.unionByName(packs).repartitionById(blocks, F.col("qb"))
    return met.select("kind", "pack").mapInArrow(_finder(exclude_self, with_range, per_category, bool(classes)), scoring._OUT)


class _Kept:
    """Packs of items in a file, and what is known of their pieces."""

    def __init__(self, file):
        self.file, self.size, self.n = file, 0, 0
        self.packs: list[tuple[int, int, int, int, int]] = []  # offset, bytes, first item, first piece, end of pieces
        self.starts, self.centers, self.radii, self.places, self.kinds = [0], [], [], [], []
        self.names: dict = {}
        self.classes: list[int] = []

    def add(self, raw: bytes) -> None:
        batch = pa.ipc.read_record_batch(pa.py_buffer(raw), _ITEM)
        x, cell = scoring._matrix(batch["vec"]), batch["cell"].to_numpy()
        cuts = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1))
        cuts = np.concatenate([np.arange(a, b, PIECE) for a, b in zip(cuts, [*cuts[1:], len(cell)])])
        ends = np.append(cuts[1:], len(cell))
        wide = x.astype(np.float64)
        centers = (np.add.reduceat(wide, cuts) / (ends - cuts)[:, None]).astype(np.float32)
        away = np.sqrt(((wide - np.repeat(centers.astype(np.float64), ends - cuts, axis=0)) ** 2).sum(axis=1))
        self.packs.append((self.size, len(raw), self.n, len(self.radii), len(self.radii) + len(cuts)))
        self.starts += [self.n + int(e) for e in ends]
        self.centers.append(centers)
        self.classes += (cell[cuts] // MOST_CELLS).tolist()
        self.radii += np.maximum.reduceat(away, cuts).tolist()
        self.places.append(batch["place"].to_numpy())
        known = batch["category"].dictionary_encode()
        codes = np.array([self.names.setdefault(c, len(self.names)) for c in known.dictionary.to_pylist()] + [-1], np.int32)
        self.kinds.append(codes[pc.fill_null(known.indices, -1).to_numpy(zero_copy_only=False)])
        self.file.write(raw)
        self.size, self.n = self.size + len(raw), self.n + len(cell)

    def close(self) -> None:
        self.starts, self.radii = np.array(self.starts), np.array(self.radii)
        self.centers, self.places, self.kinds = (np.concatenate(x) for x in (self.centers, self.places, self.kinds))

    def batch(self, pack: int) -> pa.RecordBatch:
        self.file.seek(self.packs[pack][0])
        return pa.ipc.read_record_batch(pa.py_buffer(self.file.read(self.packs[pack][1])), _ITEM)


class _Lists:
    """The best cells found for each query, best first; equal ones by place."""

    def __init__(self, limit: np.ndarray, kept: _Kept, cap: int | None, known: np.ndarray | None = None):
        self.limit, self.kept, self.cap = limit, kept, cap
        self.steps = np.full((len(limit), int(limit.max())), -np.inf)
        self.item = np.full(self.steps.shape, -1, np.int32)
        # What has to be beaten: steps and, among equal ones, the place.
        self.bar = np.full(len(limit), -np.inf) if known is None else known.copy()
        self.bar_place = np.full(len(limit), _LAST)
        self.waiting, self.n_waiting = [], 0

    def beats(self, row, steps, place):
        return (steps > self.bar[row]) | ((steps == self.bar[row]) & (place < self.bar_place[row]) & (steps > -np.inf))

    def add(self, row: np.ndarray, item: np.ndarray, steps: np.ndarray) -> None:
        self.waiting.append((row, item, steps))
        self.n_waiting += len(row)
        if self.n_waiting > WAITING:
            self.flush()

    def flush(self) -> None:
        if not self.n_waiting:
            self.waiting = []
            return
        row, item, steps = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.n_waiting = [], 0
        rows = np.unique(row)
        at, col = np.nonzero(self.item[rows] >= 0)
        row = np.concatenate([rows[at], row])
        item = np.concatenate([self.item[rows[at], col], item])
        steps = np.concatenate([self.steps[rows[at], col], steps])
        order = np.lexsort((self.kept.places[item], -steps, row))
        row, item, steps = row[order], item[order], steps[order]
        if self.cap:
            kind = self.kept.kinds[item]
            grouped = np.lexsort((kind, row))  # stable: the order inside a category stays
            new = (np.diff(row[grouped], prepend=-1) != 0) | (np.diff(kind[grouped], prepend=-2) != 0)
            first = np.flatnonzero(new)
            within = np.arange(len(row)) - np.repeat(first, np.diff(first, append=len(row)))
            keep = np.sort(grouped[within < self.cap])
            row, item, steps = row[keep], item[keep], steps[keep]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < self.limit[row]
        row, item, steps, rank = row[keep], item[keep], steps[keep], rank[keep]
        self.item[rows], self.steps[rows] = -1, -np.inf
        self.item[row, rank], self.steps[row, rank] = item, steps
        full = rank == self.limit[row] - 1
        self.bar[row[full]], self.bar_place[row[full]] = steps[full], self.kept.places[item[full]]


def _most(steps: np.ndarray, beats: np.ndarray, most: int) -> np.ndarray:
    """Of what ``beats`` only the best ``most`` a row; of equal ones the first."""
    rows = np.flatnonzero(beats.sum(axis=1) > most)
    if len(rows):
        s = np.where(beats[rows], steps[rows], -np.inf)
        least = np.partition(s, s.shape[1] - most, axis=1)[:, s.shape[1] - most][:, None]
        above, equal = s > least, s == least
        room = most - above.sum(axis=1)
        beats[rows] = above | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= room[:, None]))
    return beats


def _tile(u, p, first: int, rows, cols, hidden, lists: _Lists, error, double: bool, most: int) -> None:
    """Queries ``rows`` against the items ``cols`` of a piece that begins with item ``first``; ``hidden``: (rows,
    columns of the piece) to leave out."""
    scale = 10.0**scoring.DIGITS
    v = p if cols is None else p[cols]
    items = np.arange(first, first + len(p), dtype=np.int32) if cols is None else (first + cols).astype(np.int32)
    places = lists.kept.places[items]
    each = max(1, AT_ONCE // len(v))
    for at in range(0, len(rows), each):
        who = rows[at : at + each]
        bar, bar_place = lists.bar[who], lists.bar_place[who]
        row, col = np.searchsorted(who, hidden[0]), hidden[1]
        if cols is not None:
            col = np.searchsorted(cols, col)
        hit = (row < len(who)) & (col < len(v))
        hit[hit] = who[row[hit]] == hidden[0][hit]
        if cols is not None:
            hit[hit] = cols[col[hit]] == hidden[1][hit]
        row, col = row[hit], col[hit]
        if not double and np.isfinite(bar).mean() > 0.5:
            cells = u[who] @ v.T
            cells[row, col] = -np.inf
            # Where all places of the piece come after the bar's, equal steps don't count.
            least = (bar + np.where(bar_place < places[0], 0.49, -0.51)) / scale - error[who]
            least = np.maximum(least - np.abs(np.where(np.isfinite(least), least, 0)) * 2.0**-22, np.finfo(np.float32).min)
            flat = np.flatnonzero(cells >= least.astype(np.float32)[:, None])
            if 16 * len(flat) <= cells.size:
                if len(flat):
                    r, c = np.divmod(flat, len(v))
                    steps = scoring._steps(u[who], v, r, c)
                    keep = lists.beats(who[r], steps, places[c])
                    lists.add(who[r[keep]], items[c[keep]], steps[keep])
                continue
        steps = np.rint(u[who].astype(np.float64) @ v.T.astype(np.float64) * scale)
        steps[row, col] = -np.inf
        if double:
            steps[np.isnan(steps)] = -np.inf
        beats = steps > bar[:, None]
        equal = steps == bar[:, None]
        beats |= equal & (places < bar_place[:, None]) & np.isfinite(steps)
        r, c = np.nonzero(_most(steps, beats, min(most, len(v))))
        lists.add(who[r], items[c], steps[r, c])


def _search(kept: _Kept, u: np.ndarray, lists: _Lists, wanted: np.ndarray, hidden, depth: np.ndarray | None = None) -> None:
    """Fill ``lists`` for the queries ``u``. ``wanted``: the code of the category a query asks for, scoring.ANY, or
    scoring.NOWHERE. ``hidden``: (query, item) to leave out, ordered by item. With a ``depth`` bars are known."""
    m, pieces = len(u), len(kept.radii)
    norm = np.sqrt((u.astype(np.float64) ** 2).sum(axis=1))
    reach = np.sqrt((kept.centers.astype(np.float64) ** 2).sum(axis=1)) + kept.radii
    with np.errstate(all="ignore"):
        double = not (norm.max() * reach.max() < 1e30)
        error = (u.shape[1] + 4) * 2.0**-23 * norm * reach.max()
    seekers, first = np.flatnonzero(wanted != scoring.NOWHERE), np.full((m, min(FIRST, pieces)), -1, np.int32)
    centers = kept.centers
    for at in range(0, len(seekers) if depth is None else 0, 1024):
        some = seekers[at : at + 1024]
        with np.errstate(all="ignore"):
            near = -np.nan_to_num(u[some] @ centers.T)
        first[some] = np.argpartition(near, first.shape[1] - 1, axis=1)[:, : first.shape[1]]
    scopes = [int(w) for w in np.unique(wanted[seekers]) if w != scoring.ANY]
    most = lists.cap or int(lists.limit.max())

    def meet(p, piece: int, rows: np.ndarray) -> None:
        start = int(kept.starts[piece])
        lo, hi = np.searchsorted(hidden[1], [start, start + len(p)])
        hide = hidden[0][lo:hi], hidden[1][lo:hi] - start
        kinds = kept.kinds[start : start + len(p)]
        if lists.cap:
            for kind in np.unique(kinds):
                _tile(u, p, start, rows[(wanted[rows] == scoring.ANY) | (wanted[rows] == kind)], np.flatnonzero(kinds == kind), hide, lists, error, double, most)
            return
        free = rows[wanted[rows] == scoring.ANY] if scopes else rows
        if len(free):
            _tile(u, p, start, free, None, hide, lists, error, double, most)
        for kind in scopes:
            cols, who = np.flatnonzero(kinds == kind), rows[wanted[rows] == kind]
            if len(cols) and len(who):
                _tile(u, p, start, who, cols, hide, lists, error, double, most)

    # Every query meets the pieces nearest to it ...
    by_piece = np.argsort(first.ravel(), kind="stable")
    edges = np.searchsorted(first.ravel()[by_piece], np.arange(pieces + 1))
    for pack, (_, _, begin, lo, hi) in enumerate(kept.packs):
        p = scoring._matrix(kept.batch(pack)["vec"]) if edges[hi] > edges[lo] else None
        for piece in range(lo, hi):
            if edges[piece + 1] > edges[piece]:
                rows = np.sort(by_piece[edges[piece] : edges[piece + 1]] // first.shape[1])
                meet(p[kept.starts[piece] - begin : kept.starts[piece + 1] - begin], piece, rows)
    lists.flush()
    # ... and then those that can change its list.
    seeking, flat_u = wanted != scoring.NOWHERE, np.ascontiguousarray(u.T)
    for pack, (_, _, begin, lo, hi) in enumerate(kept.packs):
        p = None
        for at in range(lo, hi, TOGETHER):
            end = min(hi, at + TOGETHER)
            if double:
                need = np.broadcast_to(seeking, (end - at, m))
            else:
                least = ((lists.bar - 0.51) / 10.0**scoring.DIGITS - 2 * error).astype(np.float32)
                least -= np.abs(np.where(np.isfinite(least), least, 0)) * np.float32(2.0**-22)
                bound = centers[at:end] @ flat_u
                bound += (kept.radii[at:end, None] * (1 + 1e-6)).astype(np.float32) * norm.astype(np.float32)
                need = ~(bound < least) & seeking
            for piece in range(at, end):
                rows = np.flatnonzero(need[piece - at] if depth is None else need[piece - at] & (depth >= kept.classes[piece]))
                rows = rows[(first[rows] != piece).all(axis=1)]
                if len(rows):
                    if p is None:
                        p = scoring._matrix(kept.batch(pack)["vec"])
                    meet(p[kept.starts[piece] - begin : kept.starts[piece + 1] - begin], piece, rows)
    lists.flush()


class _Places:
    """Where values stand in an array of codes that may repeat; -1 stands nowhere."""

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(codes, kind="stable").astype(np.int32)
        self.codes = codes[self.order]

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``keys``, place in the array) of all equal ones."""
        lo, hi = (np.searchsorted(self.codes, keys, side) for side in ("left", "right"))
        n = np.where(keys < 0, 0, hi - lo)
        return np.repeat(np.arange(len(keys)), n), self.order[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]


def _hidden(kept: _Kept, query_ids: pa.Array, masks: list[bytes], exclude_self: bool):
    """Distinct (query, item) to leave out, ordered by item."""
    none = np.empty(0, np.int64)
    if not masks and not exclude_self:
        return none, none
    pairs = [pa.ipc.read_record_batch(pa.py_buffer(m), scoring._MASK) for m in masks]
    if exclude_self:
        pairs.append(pa.RecordBatch.from_arrays([query_ids, query_ids], schema=scoring._MASK))
    pairs = pa.Table.from_batches(pairs, scoring._MASK)
    known, wanted = pc.unique(query_ids), pc.unique(pairs["product_id"])
    of_query, of_item = scoring._positions(pairs["query_id"], known), scoring._positions(pairs["product_id"], wanted)
    del pairs
    masks.clear()
    queries = _Places(scoring._positions(query_ids, known))
    ids = pa.chunked_array([kept.batch(i)["product_id"] for i in range(len(kept.packs))])
    items = _Places(scoring._positions(ids, wanted))
    del ids, wanted
    both = [none]
    for start in range(0, len(of_query), MASKS_AT_ONCE):
        at, query = queries.of(of_query[start : start + MASKS_AT_ONCE])
        which, item = items.of(of_item[start : start + MASKS_AT_ONCE][at])
        both.append(item.astype(np.int64) * len(query_ids) + query[which])
    item, query = np.divmod(np.unique(np.concatenate(both)), len(query_ids))
    return query, item


def _finder(exclude_self: bool, with_range: bool, per_category: int | None, deep: bool):
    def run(batches):
        with tempfile.TemporaryFile() as file:
            kept, queries, masks = _Kept(file), [], []
            for batch in batches:
                for kind, pack in zip(batch["kind"].to_pylist(), batch["pack"]):
                    if kind == 2:
                        kept.add(pack.as_py())
                    else:
                        (masks if kind else queries).append(pack.as_py())
            if not queries or not kept.n:
                return
            kept.close()
            yield from _found(kept, queries, masks, exclude_self, with_range, per_category, deep)

    return run


def _found(kept: _Kept, queries: list[bytes], masks: list[bytes], exclude_self, with_range, per_category, deep):
    schema = _DEEP if deep else scoring._QUERY
    asked = pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(q), schema) for q in queries], schema)
    asked = asked.filter(pc.greater(asked["n"], 0)).combine_chunks()
    if not asked.num_rows:
        return
    query_ids, limit = asked["query_id"].combine_chunks(), asked["n"].to_numpy()
    u, wish = scoring._matrix(asked["vec"]), asked["category"].combine_chunks().dictionary_encode()
    codes = np.array([kept.names.get(c, scoring.NOWHERE) for c in wish.dictionary.to_pylist()] + [scoring.ANY], np.int32)
    wanted = codes[pc.fill_null(wish.indices, -1).to_numpy(zero_copy_only=False)]
    hidden = _hidden(kept, query_ids, masks, exclude_self)
    scale, depth, known = 10.0**scoring.DIGITS, None, None
    if deep:
        depth = asked["depth"].to_numpy()
        known = np.rint(pc.fill_null(asked["bar"], -np.inf).to_numpy() * scale)
    lists = _Lists(limit, kept, per_category, known)
    _search(kept, u, lists, wanted, hidden, depth)
    if with_range:
        lowest = _Lists(np.ones(len(u), np.int32), kept, None)
        _search(kept, -u, lowest, wanted, hidden)
        low, high = -lowest.steps[:, 0], lists.steps[:, 0]
        per_kind = np.bincount(kept.kinds + 1, minlength=len(kept.names) + 1)
        candidates = np.where(wanted == scoring.ANY, kept.n, per_kind[np.maximum(wanted, -1) + 1])
        counted = (wanted[hidden[0]] == scoring.ANY) | (wanted[hidden[0]] == kept.kinds[hidden[1]])
        candidates = candidates - np.bincount(hidden[0][counted], minlength=len(u))
    winners = np.unique(lists.item[lists.item >= 0])
    shown = []
    for pack, (_, _, begin, lo, hi) in enumerate(kept.packs):
        a, b = np.searchsorted(winners, [begin, kept.starts[hi]])
        if b > a:
            batch = kept.batch(pack).select(["product_id", "category", "is_cold"])
            shown.append(batch.take(pa.array(winners[a:b] - begin)))
    if not shown:
        return
    shown = pa.Table.from_batches(shown).combine_chunks()
    each = max(1, OUT_BATCH // lists.item.shape[1])
    for at in range(0, len(u), each):
        r, rank = np.nonzero(lists.item[at : at + each] >= 0)
        if not len(r):
            continue
        r += at
        of = shown.take(pa.array(np.searchsorted(winners, lists.item[r, rank])))
        columns = [
            query_ids.take(pa.array(r)),
            of["product_id"].combine_chunks(),
            pa.array(lists.steps[r, rank] / scale + 0.0),
            pa.array((rank + 1).astype(np.int32)),
            of["category"].combine_chunks(),
            of["is_cold"].combine_chunks(),
            pa.array(limit[r].astype(np.int32)),
        ]
        if with_range:
            columns += [pa.array(x[r] / scale + 0.0) for x in (low, high)]
            columns += [pa.nulls(len(r), pa.float64()), pa.array(candidates[r].astype(np.int64))]
        else:
            columns += [pa.nulls(len(r), t) for t in (pa.float64(), pa.float64(), pa.float64(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [f.name for f in scoring._OUT])
