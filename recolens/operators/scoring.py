"""Blocked top-k scoring: every query against every item, only k rows leave a block.

Queries and items are dealt into hash blocks; each (query block, item block) is one Spark
group, scored as a matrix product on Arrow batches. Block counts follow from the table
sizes, so a group holds a bounded number of rows whatever the totals: more data means more
groups. Nothing passes through the driver and pairs are never materialised as rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

ITEM_BLOCK = 1_000_000
QUERY_BLOCK = 400_000
MOST_BLOCKS = 8  # item blocks that smaller ones are joined into: a query travels once per block
LEAST_QUERIES = 1000  # queries below which a block is not split for the sake of free cores
OUT_ROWS = 2_000_000  # rows one group may return
MAX_K = 100
MASK_BLOCK = 2_000_000
QUERY_CHUNK, TILE, FIRST_TILE = 512, 1024, 8192  # scores of a tile fit a core's cache
WAITING = 8  # cells per query that are collected before they are ranked
CELLS = 500_000  # cells scored again at once
DIGITS = 6
ANY, NOWHERE = -3, -2  # codes of no wish and of a category no item of the block has; -1 is an item without one
GROUP = 64  # columns per group when bounding the k-th best score
PACK_BYTES = 8 << 20  # rows that travel as one
CELL_PAIRS = 4_000_000_000  # pairs from which items are scored by cells

_OUT = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("is_cold", T.BooleanType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("candidates", T.LongType()),
    ]
)


_QUERY = pa.schema(
    [
        ("query_id", pa.string()),
        ("product_id", pa.string()),
        ("category", pa.string()),
        ("n", pa.int32()),
        ("vec", pa.list_(pa.float32())),
    ]
)
_MASK = pa.schema([("query_id", pa.string()), ("product_id", pa.string())])
_ITEM = pa.schema(
    [("product_id", pa.string()), ("category", pa.string()), ("is_cold", pa.bool_()), ("vec", pa.list_(pa.float32()))]
)


def _packed(rows: DataFrame, schema: pa.Schema, keys: list[str]) -> DataFrame:
    """(*keys, pack): many rows with the same keys as one Arrow batch, which copies and moves as one value."""

    def pack(table: pa.Table):
        part = np.zeros(table.num_rows, np.int64)
        for key in keys:
            part = part * (1 << 31) + table[key].to_numpy()
        order = np.argsort(part, kind="stable")
        table, part = table.take(pa.array(order)), part[order]
        ends = np.flatnonzero(np.diff(part, append=-1)) + 1
        of_part = table.select(schema.names).cast(schema).combine_chunks()
        packs = [
            of_part.slice(a, b - a).to_batches()[0].serialize().to_pybytes() for a, b in zip([0, *ends[:-1]], ends)
        ]
        columns = [table[key].take(pa.array(ends - 1)).combine_chunks() for key in keys]
        return pa.RecordBatch.from_arrays([*columns, pa.array(packs, pa.binary())], [*keys, "pack"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= PACK_BYTES:
                yield pack(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            yield pack(pa.Table.from_batches(held))

    return rows.select(*keys, *schema.names).mapInArrow(run, ", ".join([*[f"{key} int" for key in keys], "pack binary"]))


def _unpacked(packs: pa.Table, schema: pa.Schema) -> pa.Table:
    batches = [pa.ipc.read_record_batch(pa.py_buffer(p), schema) for p in packs["pack"].to_pylist()]
    return pa.Table.from_batches(batches, schema)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
    return flat.reshape(len(column), -1)


def _positions(values: pa.Array, among: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.index_in(values, value_set=among), -1).to_numpy(zero_copy_only=False)


def _merged(row: np.ndarray, col: np.ndarray, steps: np.ndarray, limit: np.ndarray):
    """(row, column, steps, place) of the best cells per row, ties to the lower column."""
    order = np.lexsort((col, -steps, row))
    row, col, steps = row[order], col[order], steps[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = place < limit[row]
    return row[keep], col[keep], steps[keep], place[keep]


def _steps(u: np.ndarray, p: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Rounded scores of single cells, in double precision."""
    out = np.empty(len(row))
    for at in range(0, len(row), CELLS):
        r, c = row[at : at + CELLS], col[at : at + CELLS]
        out[at : at + CELLS] = np.einsum("ij,ij->i", u[r].astype(np.float64), p[c].astype(np.float64))
    return np.rint(out * 10.0**DIGITS)


def _floor(cells: np.ndarray, k: int) -> np.ndarray:
    """A lower bound of the k-th largest cell per row: the k-th largest maximum of column groups."""
    width = cells.shape[1]
    size = min(max(width // (2 * k), 1), GROUP)
    groups = width // size
    if groups <= k:
        return np.full(len(cells), -np.inf)
    tops = cells[:, : groups * size].reshape(len(cells), groups, size).max(axis=2)
    return np.partition(tops, groups - k, axis=1)[:, groups - k].astype(np.float64)


class _Ends:
    """Lowest, highest and sum of the steps of all candidates per row, and their number."""

    def __init__(self, n: int):
        self.low, self.high = np.full(n, np.inf), np.full(n, -np.inf)
        self.total, self.count = np.zeros(n), np.zeros(n, np.int64)

    def add(self, cells: np.ndarray, row: np.ndarray, col: np.ndarray) -> None:
        """Take in a tile of steps without its hidden cells (row, col), which it marks as -inf."""
        self.total += cells.sum(axis=1)
        np.subtract.at(self.total, row, cells[row, col])
        self.count += cells.shape[1] - np.bincount(row, minlength=len(cells))
        cells[row, col] = np.inf
        np.minimum(self.low, cells.min(axis=1), out=self.low)
        cells[row, col] = -np.inf
        np.maximum(self.high, cells.max(axis=1), out=self.high)


def _scan(u: np.ndarray, p: np.ndarray, limit: np.ndarray, hidden, ends: _Ends | None, known: np.ndarray | None = None):
    """Best cells (row, column, steps) of the queries ``u`` among the items ``p``, ordered by id.

    Items pass tile by tile. A tile is one product in single precision; cells that its error could lift
    over the row's last kept cell are few and are scored again in double. The first, wider tile sets
    the bar, unless the least steps that count are ``known`` (-inf where not). ``hidden``: (rows, columns
    ascending) to leave out, each once. For ``ends`` every cell is rounded, in double.
    """
    m, n = len(u), len(p)
    scale, k = 10.0**DIGITS, int(limit.max())
    hidden_row, hidden_col = hidden
    norm = np.sqrt((u.astype(np.float64) ** 2).sum(axis=1))
    reach = float(np.sqrt(np.einsum("ij,ij->i", p, p, dtype=np.float64).max()))
    double = ends is not None or not norm.max() * reach < 1e30
    left, unit = (u.astype(np.float64), 2.0**-52) if double else (u, 2.0**-23)
    if ends is not None:
        left = left * scale
    error = (u.shape[1] + 4) * unit * norm * reach
    lowest = np.finfo(left.dtype).min
    row, col, steps = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    bar, found, waiting, start = np.full(m, -np.inf), [], 0, 0
    if known is not None:
        bar = np.minimum(known - 1, np.nextafter(known, -np.inf))  # cells equal to what is known count
    while start < n:
        stop = min(n, start + (TILE if start else FIRST_TILE))
        cells = left @ p[start:stop].T.astype(left.dtype, copy=False)
        lo, hi = np.searchsorted(hidden_col, [start, stop])
        at = hidden_row[lo:hi], hidden_col[lo:hi] - start
        if ends is None:
            cells[at] = -np.inf
            # A cell counts if its rounded score is above the bar. Ties after it have higher columns.
            least = (bar + 0.49) / scale - error
            if start == 0 and not np.isfinite(bar).all():
                least = np.maximum(least, _floor(cells, k) - 2 * error - 0.5 / scale)
            least -= np.abs(np.where(np.isfinite(least), least, 0)) * unit
        else:
            np.rint(cells, out=cells)
            ends.add(cells, *at)
            least = _floor(cells, k) if start == 0 else np.nextafter(bar, np.inf)
        least = np.maximum(least, lowest).astype(left.dtype)
        flat = np.flatnonzero(cells >= least[:, None])
        if len(flat):
            r, c = np.divmod(flat, stop - start)
            value = _steps(u, p, r, c + start) if ends is None else cells[r, c]
            keep = value > bar[r]
            found.append((r[keep], c[keep] + start, value[keep]))
            waiting += int(keep.sum())
        if found and (start == 0 or stop == n or waiting > WAITING * m):
            row, col, steps = (np.concatenate([x, *y]) for x, y in zip((row, col, steps), zip(*found)))
            row, col, steps, place = _merged(row, col, steps, limit)
            full = place == limit[row] - 1
            bar[row[full]] = steps[full]
            found, waiting = [], 0
        start = stop
    return row, col, steps


def _scorer(exclude_self: bool, with_range: bool, per_category: int | None):
    """Scores a group of queries against a group of items.

    Left rows without a vector are masks. Where the items have a class ``c`` and the queries a ``depth``,
    a query meets the classes up to its depth, and only scores of its ``bar`` or more come back.
    """

    def score(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[pa.Table] = []
        schema = pa.schema(
            [
                ("query_id", pa.string()),
                ("product_id", pa.string()),
                ("score", pa.float64()),
                ("rank", pa.int32()),
                ("category", pa.string()),
                ("is_cold", pa.bool_()),
                ("n", pa.int32()),
                ("low", pa.float64()),
                ("high", pa.float64()),
                ("total", pa.float64()),
                ("candidates", pa.int64()),
            ]
        )
        queries = left.filter(pc.is_valid(left["vec"]))
        if queries.num_rows == 0 or right.num_rows == 0:
            return schema.empty_table()
        p = _matrix(right["vec"])
        items = right.drop_columns(["vec"])
        by_id = pc.sort_indices(items, sort_keys=[("product_id", "ascending")])
        items, p = items.take(by_id), p[by_id.to_numpy()]
        item_ids = items["product_id"].combine_chunks()
        query_ids = queries["query_id"].combine_chunks()
        u = _matrix(queries["vec"])
        limit = queries["n"].to_numpy()

        item_category = items["category"].combine_chunks()
        item_cold = items["is_cold"].combine_chunks()
        categories = item_category.dictionary_encode()
        codes = pc.fill_null(categories.indices, -1).to_numpy(zero_copy_only=False)
        wanted = queries["category"].combine_chunks()
        asked = pc.is_valid(wanted).to_numpy(zero_copy_only=False)
        wanted_codes = _positions(wanted, categories.dictionary)
        wanted_codes = np.where(wanted_codes < 0, NOWHERE, wanted_codes)
        wanted_codes = np.where(asked, wanted_codes, ANY)

        masks = left.filter(pc.is_null(left["vec"]))
        mask_q = _positions(masks["query_id"].combine_chunks(), query_ids)
        mask_i = _positions(masks["product_id"].combine_chunks(), item_ids)
        if exclude_self:
            own = _positions(query_ids, item_ids)
            mask_q = np.concatenate([mask_q, np.arange(len(own))])
            mask_i = np.concatenate([mask_i, own])
        usable = (mask_q >= 0) & (mask_i >= 0)
        pairs = np.unique(mask_q[usable].astype(np.int64) * len(item_ids) + mask_i[usable])
        mask_q, mask_i = np.divmod(pairs, len(item_ids))
        classes = items["c"].to_numpy() if "c" in items.column_names else None
        depth = queries["depth"].to_numpy() if classes is not None else None
        known = pc.fill_null(queries["bar"], -np.inf).to_numpy() if classes is not None else None

        scale = 10.0**DIGITS
        if known is not None:
            known = np.rint(known * scale)
        for scope in np.unique(wanted_codes):
            if scope == NOWHERE:
                continue
            of_scope = np.flatnonzero(wanted_codes == scope)
            inside = np.arange(len(item_ids)) if scope == ANY else np.flatnonzero(codes == scope)
            if classes is not None:
                kinds = classes[inside]
            else:
                kinds = codes[inside] if per_category else np.zeros(len(inside), np.int8)
            by_kind = np.argsort(kinds, kind="stable")
            edges = np.flatnonzero(np.diff(kinds[by_kind], prepend=kinds[by_kind][:1] - 1, append=kinds[by_kind][-1:] + 1))
            parts = [inside[by_kind[a:b]] for a, b in zip(edges, edges[1:])]
            vectors = [p if len(part) == len(p) else p[part] for part in parts]
            for start in range(0, len(of_scope), QUERY_CHUNK):
                at = of_scope[start : start + QUERY_CHUNK]
                # Masks are ordered by query, so those of a chunk are one slice.
                lo, hi = np.searchsorted(mask_q, [at[0], at[-1] + 1])
                place = np.searchsorted(at, mask_q[lo:hi])
                mine = at[np.minimum(place, len(at) - 1)] == mask_q[lo:hi]
                hide_q, hide_i = place[mine], mask_i[lo:hi][mine]
                ends, got = _Ends(len(at)) if with_range else None, []
                for part, v in zip(parts, vectors):
                    who = np.arange(len(at)) if depth is None else np.flatnonzero(depth[at] >= classes[part[0]])
                    if not len(who):
                        continue
                    col = np.searchsorted(part, hide_i)
                    row = np.searchsorted(who, hide_q)
                    hit = (part[np.minimum(col, len(part) - 1)] == hide_i) & (who[np.minimum(row, len(who) - 1)] == hide_q)
                    order = np.argsort(col[hit], kind="stable")
                    most = np.full(len(who), per_category) if per_category else limit[at[who]]
                    r, c, x = _scan(u[at[who]], v, most, (row[hit][order], col[hit][order]), ends, None if known is None else known[at[who]])
                    got.append((who[r], part[c], x))
                if not got:
                    continue
                r, c, x, place = _merged(*(np.concatenate(g) for g in zip(*got)), limit[at])
                columns = [
                    query_ids.take(pa.array(at[r])),
                    item_ids.take(pa.array(c)),
                    pa.array(x / scale + 0.0),
                    pa.array((place + 1).astype(np.int32)),
                    item_category.take(pa.array(c)),
                    item_cold.take(pa.array(c)),
                    pa.array(limit[at[r]].astype(np.int32)),
                ]
                if with_range:
                    columns += [pa.array(v[r] / scale + 0.0) for v in (ends.low, ends.high, ends.total)]
                    columns.append(pa.array(ends.count[r]))
                else:
                    columns += [pa.nulls(len(r), f.type) for f in list(schema)[7:]]
                rows.append(pa.table(columns, schema=schema))
        return pa.concat_tables(rows) if rows else schema.empty_table()

    return score


def _packed_scorer(exclude_self: bool, with_range: bool, per_category: int | None):
    """:func:`_scorer` for packed queries, masks and items."""
    score = _scorer(exclude_self, with_range, per_category)

    def opened(key, left: pa.Table, right: pa.Table) -> pa.Table:
        queries = _unpacked(left.filter(pc.invert(left["masks"])), _QUERY)
        masks = _unpacked(left.filter(left["masks"]), _MASK)
        return score(key, pa.concat_tables([queries, masks], promote_options="default"), _unpacked(right, _ITEM))

    return opened


def top_items(
    queries: DataFrame,
    items: DataFrame,
    k: int = MAX_K,
    masked: DataFrame | None = None,
    exclude_self: bool = False,
    with_range: bool | str = False,
    query_block: int = QUERY_BLOCK,
    item_block: int = ITEM_BLOCK,
    per_category: int | None = None,
) -> DataFrame:
    """Best items per query by inner product.

    ``queries``: query_id (unique), vec; optional n (limit per query, ``k`` where null; more than ``k``
    is an error) and category (NULL: all). ``items``: product_id (unique), vec; optional
    category and is_cold, which come along in the result. ``query_block`` and ``item_block`` ask for smaller
    blocks; items are cut into ``MOST_BLOCKS`` for that at most, as each block takes a copy of the queries.
    ``masked``: (query_id, product_id) pairs to leave out, in any number.

    Returns query_id, product_id, score, rank, category, is_cold and, filled when ``with_range``, the low, high,
    total (sum of scores) and number of all candidates of the query; without the total for ``"ends"``. Scores are
    rounded to six digits before ranking; ties go to the smaller id. Queries without candidates give
    no rows. From ``CELL_PAIRS`` pairs on, items that provably don't count are left out, see :mod:`cells`; a total
    needs them all.
    """
    from recolens.operators.cells import top_items_by_cells

    spark = queries.sparkSession
    wants, has, none = queries.columns, items.columns, F.lit(None)
    asked = queries.select(
        "query_id",
        (F.col("category") if "category" in wants else none).cast("string").alias("category"),
        (_limit(k) if "n" in wants else F.lit(k)).cast("int").alias("n"),
        F.col("vec").cast("array<float>").alias("vec"),
    )
    offered = items.select(
        "product_id",
        (F.col("category") if "category" in has else none).cast("string").alias("category"),
        (F.col("is_cold") if "is_cold" in has else none).cast("boolean").alias("is_cold"),
        F.col("vec").cast("array<float>").alias("vec"),
    )
    n_queries, n_items = queries.count(), items.count()
    if n_queries * n_items >= CELL_PAIRS and with_range is not True:
        most = asked.agg(F.max("n")).first()[0] if "n" in wants else k
        return top_items_by_cells(
            asked, offered, n_queries, n_items, most, masked, exclude_self, bool(with_range), per_category
        ).drop("n")
    with_range = bool(with_range)
    ib = max(1, math.ceil(n_items / ITEM_BLOCK), min(math.ceil(n_items / item_block), MOST_BLOCKS))
    qb = max(
        math.ceil(n_queries / min(query_block, max(1, OUT_ROWS // k))),
        min(math.ceil(2 * spark.sparkContext.defaultParallelism / ib), math.ceil(n_queries / LEAST_QUERIES)),
        1,
    )
    if masked is not None:
        # Raw rows bound the distinct pairs, and counting them needs no shuffle.
        qb = max(qb, math.ceil(masked.count() / (MASK_BLOCK * ib)))

    def block(col: str, n: int):
        return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = _packed(
        asked.select(
            block("query_id", qb).alias("qb"), "query_id", none.cast("string").alias("product_id"), "category", "n", "vec"
        ),
        _QUERY,
        ["qb"],
    ).select("qb", every(ib).alias("ib"), F.lit(False).alias("masks"), "pack")
    if masked is not None:
        pairs = masked.select("query_id", "product_id").distinct()
        pairs = pairs.select(
            block("query_id", qb).alias("qb"), block("product_id", ib).alias("ib"), "query_id", "product_id"
        )
        left = left.unionByName(_packed(pairs, _MASK, ["qb", "ib"]).withColumn("masks", F.lit(True)))
    right = _packed(offered.select(block("product_id", ib).alias("ib"), "*"), _ITEM, ["ib"]).select(
        every(qb).alias("qb"), "ib", "pack"
    )
    # A number of its own: blocks are small to move but long to score, and must not be coalesced.
    left, right = (side.repartition(2 * qb * ib, "qb", "ib") for side in (left, right))
    scored = (
        left.groupBy("qb", "ib")
        .cogroup(right.groupBy("qb", "ib"))
        .applyInArrow(_packed_scorer(exclude_self, with_range, per_category), _OUT)
    )
    return (scored if ib == 1 else _merge(scored, with_range, per_category)).drop("n")


def _limit(k: int):
    asked = F.raise_error(F.lit(f"a query asks for more than k = {k} items")).cast("int")
    return F.when(F.col("n") > k, asked).otherwise(F.coalesce("n", F.lit(k)))


def _merge(scored: DataFrame, with_range: bool, per_category: int | None) -> DataFrame:
    """Combine the winners of several item blocks: at most n rows per query and block."""
    query = Window.partitionBy("query_id")
    if with_range:
        first = F.col("rank") == 1  # one row per block carries the block's sums
        scored = scored.withColumns(
            {
                "low": F.min("low").over(query),
                "high": F.max("high").over(query),
                "total": F.sum(F.when(first, F.col("total"))).over(query),
                "candidates": F.sum(F.when(first, F.col("candidates"))).over(query),
            }
        )
    best = query.orderBy(F.col("score").desc(), "product_id")
    if per_category:
        inside = Window.partitionBy("query_id", "category").orderBy(F.col("score").desc(), "product_id")
        scored = scored.withColumn("rank", F.row_number().over(inside)).filter(F.col("rank") <= per_category)
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= F.col("n"))
