"""Exact nearest neighbour by cosine distance, pruned by pivots, on the executors.

Some merchants serve as pivots: at most ``PIVOTS`` of them, and fewer where
their vectors would pass a block's bytes. Every merchant and every query
belongs to the cell of its nearest pivot. As angles obey the triangle
inequality, a merchant at angle r from pivot p is at least |angle(q, p) - r|
away from query q, and as pivots are merchants, q's nearest is no further than
q's nearest pivot. A cell whose every merchant must be further than that is
neither sent to q nor compared with it. Pivots decide how much is compared,
never the result.

Both sides stay distributed. Cells that lie together are packed into blocks of
at most about ``BLOCK_BYTES_CONF`` bytes of vectors, larger cells are salted
over several blocks, and a block of queries meets a block of merchants in a
cogrouped Arrow task if any of its queries may need it. The task goes through
the block's cells, multiplies what the bound leaves, at most ``CELLS`` numbers
at a time, and returns one candidate per query; ``min(struct)`` picks the
overall best. Query x merchant pairs never become rows. The driver reads the
pivots and one row of counts per cell; where nothing can be pruned, every
block meets every block, as without pivots.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import sinks

DEFAULT_BLOCK_BYTES = 32 * 1024 * 1024
BLOCK_BYTES_CONF = "ledgerloom.nearest.blockBytes"
#: Distances that a task holds at a time.
CELLS = 1 << 22
#: Queries are not cut below so many a block for the sake of more tasks.
LEAST_QUERIES = 256
#: Pivots, each with a cell, at most.
PIVOTS = 256
#: Angles that differ by less may be equal; far above what rounding does to an arc cosine.
ANGLE_SLACK = 1e-6

_FOUND = "id string, other_id string, distance double"


def _sizes(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim"))


def _in_blocks(left: DataFrame, right: DataFrame, task: Callable[[pa.Table, pa.Table], pa.Table],
               block_bytes: int | None) -> DataFrame:
    """``task`` over every pair of blocks of left(id, vec, ...) and right(id, vec, ...)."""
    spark = left.sparkSession
    limit = block_bytes or int(spark.conf.get(BLOCK_BYTES_CONF, str(DEFAULT_BLOCK_BYTES)))
    (n, dim), (m, m_dim) = _sizes(left).unionAll(_sizes(right)).collect()  # two rows of counts
    width = 8 * max(dim or 1, m_dim or 1, 1)
    right_blocks = max(1, math.ceil(m * width / limit))
    wanted = min(spark.sparkContext.defaultParallelism, math.ceil(n / LEAST_QUERIES))
    left_blocks = max(1, math.ceil(n * width / limit), math.ceil(wanted / right_blocks))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        # named anew: a cogroup of a table with itself must tell its sides' columns apart
        return df.select(*[F.col(c).alias(c) for c in df.columns], F.pmod(F.xxhash64("id"), F.lit(blocks)).alias(own),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))).alias(other))

    a = dealt(left, "lb", left_blocks, "rb", right_blocks).groupBy("lb", "rb")
    b = dealt(right, "rb", right_blocks, "lb", left_blocks).groupBy("lb", "rb")
    return a.cogroup(b).applyInArrow(task, _FOUND)


def _block_task(max_distance: float | None = None, cells: int = CELLS) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """(id, other_id, distance) of two blocks: each left row's nearest right row, or with
    ``max_distance`` every right row strictly closer than that. Where the blocks carry ``ord_key``,
    a right row counts only if it comes before the left one.

    All helpers are inside, so they travel with the function and executors need no copy of this package."""
    def unit(block: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in order, order keys and unit vectors of the rows that have a direction."""
        ids = np.array(block["id"].to_pylist(), object)
        vectors = block["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        vectors = vectors.reshape(len(ids), -1)
        keys = np.array(block["ord_key"].to_pylist() if "ord_key" in block.column_names else ids, object)
        norms = np.linalg.norm(vectors, axis=1)
        order = np.argsort(ids, kind="stable")
        order = order[norms[order] > 0]
        return ids[order], keys[order], vectors[order] / norms[order, None]

    def distances(left: pa.Table, right: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(left ids, right ids, distances), as many rows of left at a time as ``cells`` allows."""
        if not left.num_rows or not right.num_rows:
            return
        (ids, keys, q), (others, other_keys, m) = unit(left), unit(right)
        if not len(ids) or not len(others):
            return
        ranks = np.unique(np.concatenate([keys, other_keys]), return_inverse=True)[1] if "ord_key" in left.column_names else None
        step = max(1, cells // len(others))
        for at in range(0, len(ids), step):
            dist = 1.0 - q[at:at + step] @ m.T
            if ranks is not None:
                dist[ranks[None, len(ids):] >= ranks[:len(ids)][at:at + step, None]] = np.inf
            yield ids[at:at + step], others, dist

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for ids, others, dist in distances(left, right):
            if max_distance is not None:
                i, j = np.nonzero(dist < max_distance)
            else:  # others are in order of id: the first of equals has the smallest
                j = dist.argmin(axis=1)
                i = np.flatnonzero(np.isfinite(dist[np.arange(len(ids)), j]))
                j = j[i]
            found.append((ids[i], others[j], dist[i, j]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        return pa.table({"id": pa.array(columns[0], pa.string()), "other_id": pa.array(columns[1], pa.string()),
                         "distance": pa.array(columns[2], pa.float64())})

    return run


def _cells(pivots: np.ndarray, reach: np.ndarray | None = None, packs: np.ndarray | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, vec) with the ``cell`` of their nearest pivot and the ``angle`` to it; given the ``reach`` of the merchants'
    cells and the ``packs`` they are in, also with the packs that the row ``needs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vec = batch.column("vec")
            v = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            angles = v @ pivots.T
            angles /= np.linalg.norm(v, axis=1)[:, None]
            np.arccos(np.clip(angles, -1.0, 1.0, out=angles), out=angles)
            cell = angles.argmin(axis=1)
            least = angles[np.arange(len(cell)), cell]
            columns = {"id": batch.column("id"), "vec": vec, "cell": pa.array(cell, pa.int32()), "angle": pa.array(least, pa.float64())}
            if reach is not None:
                needed = angles - reach <= least[:, None] + ANGLE_SLACK
                rows, cells = np.nonzero(needed)
                pairs = np.unique(np.stack([rows, packs[cells]]), axis=1)
                offsets = np.searchsorted(pairs[0], np.arange(batch.num_rows + 1))
                columns["needs"] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(pairs[1], pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _cell_task(pivots: np.ndarray, cells: int = CELLS) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """(id, other_id, distance, compared) of a block of queries and a block of merchants: each query's nearest merchant of
    those that the bound leaves, the smallest id of equals, and the number it was compared with.

    Beside the blocks as they came a task holds one copy of their vectors and two arrays of distances."""
    def unit(block: pa.Table, order: np.ndarray | None = None) -> np.ndarray:
        """The unit vectors of the rows, in ``order``; they are worked on chunk by chunk."""
        order = np.arange(block.num_rows) if order is None else order
        sizes = np.cumsum([0] + [len(c) for c in block["vec"].chunks])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        out = None
        for at, chunk in zip(sizes, block["vec"].chunks):
            for first in range(0, len(chunk), 1024):
                part = chunk.slice(first, 1024)
                v = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(part), -1)
                if out is None:
                    out = np.empty((len(order), v.shape[1]))
                out[place[at + first:at + first + len(part)]] = v / np.linalg.norm(v, axis=1)[:, None]
        return out

    def angles(cosines: np.ndarray) -> np.ndarray:
        """In the place of the cosines."""
        return np.arccos(np.clip(cosines, -1.0, 1.0, out=cosines), out=cosines)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids, others = (np.array(block["id"].to_pylist(), object) for block in (left, right))
            cell, angle = right["cell"].to_numpy(), right["angle"].to_numpy()
            order = np.lexsort((np.argsort(np.argsort(others, kind="stable"), kind="stable"), cell))  # by cell, then id
            others, cell, angle = others[order], cell[order], angle[order]
            q, m = unit(left), unit(right, order)
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            ends = np.r_[starts[1:], len(cell)]
            low, high = np.minimum.reduceat(angle, starts), np.maximum.reduceat(angle, starts)
            step = max(1, cells // max(len(pivots), int((ends - starts).max())))
            for at in range(0, len(ids), step):
                part = q[at:at + step]
                theta = angles(part @ pivots.T)
                bound = theta.min(axis=1) + ANGLE_SLACK
                best = np.full(len(part), np.inf)
                who = np.full(len(part), -1)
                compared = np.zeros(len(part), np.int64)
                least = theta[:, cell[starts]]
                del theta
                under = low - least
                least -= high
                np.maximum(least, under, out=least)
                del under
                for c in np.argsort(least.min(axis=0), kind="stable"):
                    rows = np.flatnonzero(least[:, c] <= bound)
                    if not len(rows):
                        continue
                    dist = part[rows] @ m[starts[c]:ends[c]].T
                    np.subtract(1.0, dist, out=dist)
                    j = dist.argmin(axis=1)
                    d = dist[np.arange(len(rows)), j]
                    j = j + starts[c]
                    compared[rows] += ends[c] - starts[c]
                    equal = np.flatnonzero(d == best[rows])
                    closer = d < best[rows]
                    closer[equal] = [others[j[i]] < others[who[rows[i]]] for i in equal]
                    best[rows[closer]], who[rows[closer]] = d[closer], j[closer]
                    bound[rows] = np.minimum(bound[rows], angles(1.0 - d) + ANGLE_SLACK)
                hit = np.flatnonzero(who >= 0)
                found.append((ids[at:at + step][hit], others[who[hit]], best[hit], compared[hit]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], [], []]
        return pa.table({"id": pa.array(columns[0], pa.string()), "other_id": pa.array(columns[1], pa.string()),
                         "distance": pa.array(columns[2], pa.float64()), "compared": pa.array(columns[3], pa.int64())})

    return run


def _together(pivots: np.ndarray) -> list[int]:
    """The cells in an order that keeps near ones together: always on to the nearest cell not yet passed."""
    cosines = pivots @ pivots.T
    order, open_ = [0], np.arange(len(pivots)) > 0
    while open_.any():
        order.append(int(np.where(open_, cosines[order[-1]], -np.inf).argmax()))
        open_[order[-1]] = False
    return order


def _packed(order: list[int], counts: dict[int, int], rows: int) -> tuple[np.ndarray, list[int]]:
    """The pack of every cell, cells in order while they hold at most ``rows`` together, and over how many blocks each pack is salted."""
    pack, held = np.zeros(len(order), np.int64), [0]
    for c in order:
        n = counts.get(c, 0)
        if held[-1] and held[-1] + n > rows:
            held.append(0)
        pack[c] = len(held) - 1
        held[-1] += n
    return pack, [max(1, math.ceil(n / rows)) for n in held]


def _pruned(queries: DataFrame, merchants: DataFrame, block_bytes: int | None, pivot_count: int | None) -> DataFrame:
    """(id, other_id, distance, compared) of the blocks that meet; both sides are (id, vec) with a direction each."""
    spark = queries.sparkSession
    limit = block_bytes or int(spark.conf.get(BLOCK_BYTES_CONF, str(DEFAULT_BLOCK_BYTES)))
    (n, dim), (m, m_dim) = _sizes(queries).unionAll(_sizes(merchants)).collect()  # two rows of counts
    if not n or not m:
        return spark.createDataFrame([], _FOUND + ", compared bigint")
    width = 8 * max(dim, m_dim)
    k = max(1, min(pivot_count or math.ceil(math.sqrt(m)), PIVOTS, limit // width))
    chosen = merchants.orderBy(F.xxhash64("id"), "id").limit(k).select("vec").collect()  # at most PIVOTS rows and a block's bytes
    pivots = np.array([r[0] for r in chosen], np.float64)
    pivots /= np.linalg.norm(pivots, axis=1)[:, None]
    order = _together(pivots)
    folder = sinks.run_folder(spark)

    def per_cell(df: DataFrame) -> dict[int, tuple[int, float]]:
        return {r[0]: (r[1], r[2]) for r in df.groupBy("cell").agg(F.count(F.lit(1)), F.max("angle")).collect()}  # at most PIVOTS rows

    # written, as bounds taken from one reading must hold for the next
    right = sinks.materialize(merchants.mapInArrow(_cells(pivots), "id string, vec array<double>, cell int, angle double"), f"{folder}/merchant-cells")
    right_cells = per_cell(right)
    rows = max(1, limit // width)
    right_pack, right_salts = _packed(order, {c: x[0] for c, x in right_cells.items()}, rows)
    reach = np.array([right_cells[c][1] if c in right_cells else -np.inf for c in range(len(pivots))])  # no merchant: out of reach

    left = sinks.materialize(queries.mapInArrow(_cells(pivots, reach, right_pack), "id string, vec array<double>, cell int, angle double, needs array<int>"),
                             f"{folder}/query-cells")
    left_cells = per_cell(left)
    wanted = min(spark.sparkContext.defaultParallelism, math.ceil(n / LEAST_QUERIES))
    left_blocks = max(1, math.ceil(n / rows), math.ceil(wanted / sum(right_salts)))
    left_pack, left_salts = _packed(order, {c: x[0] for c, x in left_cells.items()}, math.ceil(n / left_blocks))

    apart = np.arccos(np.clip(pivots @ pivots.T, -1.0, 1.0))
    meets = {(int(right_pack[j]), int(left_pack[i])) for i, (_, furthest) in left_cells.items()
             for j in np.flatnonzero(apart[i] - reach <= 2 * furthest + ANGLE_SLACK)}

    def small(rows_: list[tuple], schema: str) -> DataFrame:
        return F.broadcast(spark.createDataFrame(rows_, schema))  # at most PIVOTS, or PIVOTS x PIVOTS, rows of integers

    own_left = small([(c, int(left_pack[c]), left_salts[left_pack[c]]) for c in range(len(pivots))], "cell int, lp int, ln int")
    own_right = small([(c, int(right_pack[c]), right_salts[right_pack[c]]) for c in range(len(pivots))], "cell int, rp int, rn int")
    pack_right = small([(p, s) for p, s in enumerate(right_salts)], "rp int, rn int")
    pack_left = small([(r, p, left_salts[p]) for r, p in sorted(meets)], "rp int, lp int, ln int")

    def salt(blocks: str) -> F.Column:
        return F.pmod(F.xxhash64("id"), F.col(blocks))

    def all_salts(blocks: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks).cast("long") - 1))

    a = (left.join(own_left, "cell").select("id", "vec", "lp", salt("ln").alias("ls"), F.explode("needs").alias("rp"))
             .join(pack_right, "rp").select("id", "vec", "lp", "ls", "rp", all_salts("rn").alias("rs")))
    b = (right.join(own_right, "cell").select("id", "vec", "cell", "angle", "rp", salt("rn").alias("rs"))
              .join(pack_left, "rp").select("id", "vec", "cell", "angle", "rp", "rs", "lp", all_salts("ln").alias("ls")))
    keys = ("lp", "ls", "rp", "rs")
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(_cell_task(pivots), _FOUND + ", compared bigint")


def _directed(df: DataFrame) -> DataFrame:
    """The rows whose vector has a direction: some number in it, no null, none that is not finite."""
    norm = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return df.where(F.col("vec").isNotNull() & (F.size("vec") > 0) & (norm > 0) & (norm < float("inf")))


def _best(queries: DataFrame, found: DataFrame, *extra: F.Column) -> DataFrame:
    best = found.groupBy(F.col("id").alias("query_id")).agg(
        F.min(F.struct("distance", F.col("other_id").alias("merchant_id"))).alias("b"), *extra)
    return queries.select(F.col("id").alias("query_id")).join(best, "query_id", "left")


def nearest_merchant(queries: DataFrame, merchants: DataFrame, block_bytes: int | None = None,
                     pivots: int | None = None, counted: bool = False) -> DataFrame:
    """queries(query_id, vec array<double>), merchants(merchant_id, vec) ->
    (query_id, merchant_id, distance), one row per query; ties go to the smallest merchant id.
    With ``counted`` also ``compared``, the number of merchants that the query was compared with.

    Merchants with a NULL or zero vector, or with NULLs, NaNs or infinities in it, are left out (the
    reference would compare against NULL and fail); a query without a direction, or without
    any merchant, gets NULL for both (and 0 for ``compared``). ``pivots`` is the number of pivots, by
    default the root of the number of merchants, in either case at most ``PIVOTS``."""
    q = queries.select(F.col("query_id").cast("string").alias("id"), "vec")
    m = _directed(merchants.select(F.col("merchant_id").cast("string").alias("id"), F.col("vec").cast("array<double>").alias("vec")))
    found = _pruned(_directed(q.withColumn("vec", F.col("vec").cast("array<double>"))), m, block_bytes, pivots)
    out = _best(q, found, F.sum("compared").alias("compared"))
    return out.select("query_id", F.col("b.merchant_id").alias("merchant_id"), F.col("b.distance").alias("distance"),
                      *([F.coalesce("compared", F.lit(0).cast("long")).alias("compared")] if counted else []))


# --- ordered variants, every block against every block (sequential "earlier inserts are visible" semantics) --------------

def neighbours_before(items: DataFrame, max_distance: float, block_bytes: int | None = None) -> DataFrame:
    """items(item_id, ord_key, vec) -> (item_id, other_id, distance) for every
    other item that comes earlier by ``ord_key`` and lies within
    ``max_distance`` (strictly closer). Only qualifying pairs leave a task."""
    it = items.where(F.col("vec").isNotNull() & (F.size("vec") > 0)).select(
        F.col("item_id").cast("string").alias("id"), "ord_key", "vec")
    return _in_blocks(it, it, _block_task(max_distance), block_bytes).withColumnRenamed("id", "item_id")


def nearest_earlier(queries: DataFrame, merchants: DataFrame, block_bytes: int | None = None) -> DataFrame:
    """Like ``nearest_merchant`` but a query only sees merchants whose
    ``ord_key`` is smaller than its own (queries and merchants both carry
    ``ord_key``)."""
    usable = F.col("vec").isNotNull() & (F.size("vec") > 0)
    q = queries.select(F.col("query_id").cast("string").alias("id"), "ord_key", "vec")
    m = merchants.where(usable).select(F.col("merchant_id").alias("id"), "ord_key", "vec")
    return _best(q, _in_blocks(q.where(usable), m, _block_task(), block_bytes)).select(
        "query_id", F.col("b.merchant_id").alias("merchant_id"), F.col("b.distance").alias("distance"))
