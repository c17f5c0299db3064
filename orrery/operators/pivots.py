"""A metric index for exact neighbours and radius joins (JN-2, JN-3, ML-12,
ML-15, ORD-3, NUL-3) in any number of dimensions.

Reference rows are put into the cell of their nearest pivot (a bounded sample
of the rows); every cell keeps its covering radius and its smallest distance.
For a query q and a cell with pivot p the triangle inequality bounds every
member x from below:

    d(q, x) >= d(q, p) - radius,   smallest - d(q, p),
               (d(q, p) - d(q, nearest pivot)) / 2

Cells are gathered into *shelves* of about ``shelf_rows`` rows, close cells
together; a cell of more rows is spread over several shelves.  A search first
meets the shelf of the query's own cell, which gives the distance of its k-th
neighbour so far, and then only those shelves that hold a cell which the
bounds cannot rule out; within a shelf cells are ruled out again as the k-th
distance shrinks.  On data without structure every shelf remains and the work
is that of a block nested loop, no more.

A task holds one shelf and at most ``block_rows`` queries.  Shelves and blocks
grow with the table up to a bounded size, so that a row is copied to a number
of tasks that does not grow before that.  Reference rows
with equal vectors are one entry with its smallest ids (as many as can be
asked for), so a pile of copies is one entry.  Rows without a vector, or with
a null in it, have no neighbours and are none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions import vectors as V
from orrery.session import cut_lineage, many, small_side

METRICS = ("euclidean", "sqeuclidean", "manhattan", "chebyshev")
MAX_PIVOTS = 1024
MAX_VALUES = 200_000  # numbers in all pivots, which travel with the tasks
SLACK = 1e-9          # relative room for rounding in the bounds
TASK_VALUES = 4_000_000  # numbers in a shelf or in a block of queries


def pair_distances(metric: str, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Distances by differences, in blocks of bounded memory."""
    out = np.empty((len(q), len(r)))
    step = max(1, 250_000 // max(1, r.size))
    for a in range(0, len(q), step):
        if q.shape[1] < 8:  # few dimensions: one at a time, added in the same order
            part = out[a:a + step]
            part[:] = 0
            for j in range(q.shape[1]):
                d = np.abs(q[a:a + step, j, None] - r[None, :, j])
                if metric == "chebyshev":
                    np.maximum(part, d, out=part)
                else:
                    part += d * d if metric == "euclidean" else d
            if metric == "euclidean":
                np.sqrt(part, out=part)
            continue
        d = np.abs(q[a:a + step, None, :] - r[None, :, :])
        out[a:a + step] = np.sqrt((d * d).sum(2)) if metric == "euclidean" else d.sum(2) if metric == "manhattan" else d.max(2)
    return out


def _exact(metric: str, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Distances of rows of equal place, as ``pair_distances`` has them."""
    out = np.empty(len(q))
    for a in range(0, len(q), 20_000):
        d = np.abs(q[a:a + 20_000] - r[a:a + 20_000])
        out[a:a + 20_000] = np.sqrt((d * d).sum(1)) if metric == "euclidean" else d.sum(1) if metric == "manhattan" else d.max(1)
    return out


def narrowed(metric: str, r: np.ndarray):
    """What ``close_pairs`` needs of the reference rows for one product of
    narrow numbers: made once for a shelf, and taken for some rows of it by
    index.  None where it makes no product."""
    if metric != "euclidean" or r.shape[1] < 8 or not len(r) or not np.isfinite(r).all():
        return None
    centre = r.mean(0)
    rc = r - centre
    top = (rc * rc).sum(1)
    with np.errstate(over="ignore"):
        return centre, top, np.column_stack([rc, top, np.ones(len(r))]).astype(np.float32)


def _whole_numbers(q: np.ndarray, r: np.ndarray, limit: np.ndarray):
    """Rows as 16-bit numbers whose sums of differences cannot overflow, and
    the largest sum a pair within each query's limit can have; None where they
    would be too coarse for these limits."""
    low, high = np.minimum(q.min(0), r.min(0)), np.maximum(q.max(0), r.max(0))
    span, dim = (high - low).sum(), q.shape[1]
    if dim > 512 or not 1e-30 < span < 1e30:
        return None
    scale, middle = 32_000 / span, (low + high) / 2
    q, r = (q - middle) * scale, (r - middle) * scale
    qi, ri = np.rint(q), np.rint(r)
    room = np.abs(q - qi).sum(1) + np.abs(r - ri).sum(1).max() + 1
    if np.median(room) > 0.05 * scale * np.median(limit):
        return None
    cut = np.minimum(np.floor(limit * scale + room), 32_767).astype(np.int16)
    return qi.astype(np.int16), np.ascontiguousarray(ri.astype(np.int16).T), cut


def _set_places(flags: np.ndarray) -> np.ndarray:
    """Places of the few set flags, looked for eight at a time."""
    flat, whole = flags.ravel(), flags.size // 8 * 8
    some = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([some[flat[some]], np.flatnonzero(flat[whole:]) + whole])


def close_pairs(metric: str, q: np.ndarray, r: np.ndarray, limit: np.ndarray, ready=None):
    """(query row, reference row, distance) of all pairs within the query's
    ``limit``, by query row.

    A first look at narrow numbers (euclidean: one matrix product; manhattan:
    sums of 16-bit differences, else of floats) leaves those pairs that may be
    within it, its own error included; these are measured by their differences.
    ``ready``: the rows of ``narrowed`` that belong to ``r``."""
    found, none = [], np.zeros(0, np.int64)
    low = q.shape[1] < 8 or not (np.isfinite(q).all() and (ready is not None or np.isfinite(r).all()))
    whole = None
    if not low and len(q) and len(r):
        if metric == "euclidean":
            centre, top, narrow = ready or narrowed(metric, r)
            qc = q - centre
            size, most = (qc * qc).sum(1), limit * limit
        else:
            centre = r.mean(0)
            qc, rc = q - centre, r - centre
            size, top, most = np.abs(qc).sum(1), np.abs(rc).sum(1), limit
        scale = size + top.max()
        room = 8 * (q.shape[1] + 4) * np.finfo(np.float32).eps * scale
        # narrow numbers only where their error is small beside the limit
        wide = scale.max() > 1e30 or np.median(room) > 0.05 * np.median(most)
        if wide:
            room = room * (np.finfo(float).eps / np.finfo(np.float32).eps)
        kind = float if wide else np.float32
        if metric == "euclidean":
            # |q|^2 + |r|^2 - 2qr - cut as one product; no distance exceeds 4 scale
            cut = size - (np.minimum(most, 4 * scale) + 2 * room)
            cut = cut if wide else np.nextafter(cut.astype(kind), np.float32(-np.inf))
            left = np.column_stack([-2 * qc, np.ones(len(q)), cut]).astype(kind)
            right = np.column_stack([r - centre, top, np.ones(len(r))]) if wide else narrow
        else:
            whole = _whole_numbers(q, r, limit) if metric == "manhattan" else None
            cut = (most + 2 * room).astype(kind)
            if not wide:
                cut = np.nextafter(cut, np.float32(np.inf))
            qc, rc = qc.astype(kind), np.ascontiguousarray(rc.astype(kind).T)
            if whole:
                qc, rc, cut = whole
    # a tile stays in the cache
    step = max(1, (2_000_000 if low else 1_000_000 if metric == "euclidean" else 131_072) // max(1, len(r)))
    if not low and len(q) and len(r):
        shape = (min(step, len(q)), len(r))
        tile, flags = np.empty(shape, right.dtype if metric == "euclidean" else rc.dtype), np.empty(shape, bool)
        part = None if metric == "euclidean" else np.empty_like(tile)
    for a in range(0, len(q), step):
        e = slice(a, a + step)
        if low:
            d = pair_distances(metric, q[e], r)
            row, col = np.nonzero(d <= limit[e, None])
            found.append((row + a, col, d[row, col]))
            continue
        few = min(step, len(q) - a)
        d, near = tile[:few], flags[:few]
        if metric == "euclidean":
            np.matmul(left[e], right.T, out=d)
            np.less_equal(d, 0, out=near)
        else:
            d[:] = 0
            for j in range(q.shape[1]):
                np.subtract(qc[e, j, None], rc[j], out=part[:few])
                np.abs(part[:few], out=part[:few])
                (np.maximum if metric == "chebyshev" else np.add)(d, part[:few], out=d)
            np.less_equal(d, cut[e, None], out=near)
        row, col = np.divmod(_set_places(near), len(r))
        d = _exact(metric, q[e][row], r[col]) if len(row) < 200_000 else np.concatenate(
            [_exact(metric, q[e][row[x:x + 200_000]], r[col[x:x + 200_000]]) for x in range(0, len(row), 200_000)])
        within_ = d <= limit[e][row]
        found.append((row[within_] + a, col[within_], d[within_]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (none, none, np.zeros(0))


@dataclass
class Index:
    """What travels to the tasks (bounded by the number of pivots), and the
    table of placed reference rows (shelf, cell, vec, ids)."""
    metric: str
    points: np.ndarray
    radius: np.ndarray
    inner: np.ndarray
    first: np.ndarray   # a cell's first shelf
    splits: np.ndarray  # and how many it is spread over
    shelves: int
    placed: DataFrame
    share: int          # of a table's rows one such part is a shelf or a block

    def light(self):
        return (self.metric, self.points, self.radius, self.inner, self.first, self.splits)


def _matrix(column) -> np.ndarray:
    flat = np.asarray(column.combine_chunks().flatten() if hasattr(column, "combine_chunks") else column.flatten(), np.float64)
    return flat.reshape(len(column), -1)


def _assigner(metric, points):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            if not b.num_rows:
                continue
            d = pair_distances(metric, _matrix(b.column("vec")), points)
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell]),
                                              b.column("vec"), b.column("ids")], names=["cell", "far", "vec", "ids"])
    return run


def _chain(points: np.ndarray, metric: str) -> list[int]:
    """Pivots in an order that keeps close ones together."""
    left, order = list(range(1, len(points))), [0]
    while left:
        d = pair_distances(metric, points[order[-1]][None], points[left])[0]
        order.append(left.pop(int(d.argmin())))
    return order


def _kind(df: DataFrame, col: str) -> str:
    """Floats travel as floats; kernels measure doubles."""
    return "array<float>" if df.select(col).schema[0].dataType.simpleString() == "array<float>" else "array<double>"


def _most(share: int) -> int:
    return TASK_VALUES * 16 // share


def build(ref: DataFrame, id_col: str, vec_col: str, metric: str = "euclidean", keep_ids: int | None = None,
          shelf_rows: int | None = None, max_pivots: int = MAX_PIVOTS, share: int = 16) -> Index | None:
    """Index of ``ref``; None if it has no row with a vector.  ``keep_ids``:
    of rows with equal vectors so many smallest ids are kept (None: every row
    is an entry of its own).  ``shelf_rows``: by default one of ``share`` parts
    of the rows, no fewer than 16384 and no more than ``TASK_VALUES`` numbers
    at 16 parts, twice as many at 8."""
    spark, metric = ref.sparkSession, "euclidean" if metric == "sqeuclidean" else metric
    # + 0.0: the two zeros are one
    kind = _kind(ref, vec_col)
    vec = F.transform(F.col(vec_col).cast(kind), lambda x: x + F.lit(0.0).cast(kind[6:-1]))
    rows = ref.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).filter(
        F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull()))
    if keep_ids:
        lowest = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
        rows = (rows.withColumn("_r", lowest).filter(F.col("_r") <= keep_ids)  # cut before the shuffle as well
                .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")))
        rows = cut_lineage(rows)
    else:
        rows = rows.select("vec", F.array("id").alias("ids"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
    n, dim = size["n"], size["d"]
    if not n:
        return None
    shelf_rows = shelf_rows or max(1, min(max(16384, math.ceil(n / share)), _most(share) // max(1, dim)))
    p = max(1, min(max_pivots, MAX_VALUES // max(1, dim), int(math.sqrt(n))))
    if n <= shelf_rows:  # one shelf: its task makes the cells itself
        none = np.zeros(0)
        return Index(metric, np.zeros((0, dim)), none, none, none, none, 1,
                     rows.select(F.lit(0).cast("long").alias("shelf"), F.lit(0).alias("cell"), "vec", "ids"), share)
    points = np.array([r["vec"] for r in rows.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec").limit(p).collect()], float)
    points = points[_chain(points, metric)]
    placed = cut_lineage(rows.mapInArrow(_assigner(metric, points), f"cell int, far double, vec {kind}, ids array<long>"))
    radius, inner, count = np.zeros(len(points)), np.zeros(len(points)), np.zeros(len(points), np.int64)
    for r in placed.groupBy("cell").agg(F.max("far").alias("r"), F.min("far").alias("i"), F.count(F.lit(1)).alias("n")).collect():
        radius[r["cell"]], inner[r["cell"]], count[r["cell"]] = r["r"], r["i"], r["n"]
    first, splits, at, held = np.zeros(len(points), np.int64), np.ones(len(points), np.int64), 0, 0
    for c in range(len(points)):
        if held and held + count[c] > shelf_rows:
            at, held = at + 1, 0
        first[c], splits[c] = at, max(1, math.ceil(count[c] / shelf_rows))
        at, held = at + splits[c] - 1, held + int(count[c])
    where = spark.createDataFrame([(c, int(first[c]), int(splits[c])) for c in range(len(points))], "cell int, f long, s long")
    shelf = F.col("f") + F.pmod(F.xxhash64("vec", "ids"), F.col("s"))
    placed = placed.join(F.broadcast(where), "cell").select(shelf.alias("shelf"), "cell", "vec", "ids")
    return Index(metric, points, radius, inner, first, splits, at + 1, placed, share)


def _bounds(light, d):
    """Lower bounds of the distance to any member of each cell, from the
    distances ``d`` to the pivots."""
    _, _, radius, inner, _, _ = light
    low = np.maximum(np.maximum(d - radius, inner - d), (d - d.min(1, keepdims=True)) / 2)
    return np.maximum(low, 0)


def _router(light, mode: str):
    """Queries (q_id, q_vec, limit) -> the same with their ``shelves``:
    ``home``: the shelf of the own cell; ``rest``: all others that may hold
    something within the limit; ``all``: both; ``after``: of these the
    query's ``home`` and those behind it."""
    metric, points, _, _, first, splits = light

    def run(batches):
        import pyarrow as pa
        cells = np.repeat(np.arange(len(points)), splits)
        shelf_of = np.concatenate([np.arange(f, f + s) for f, s in zip(first, splits)])
        starts = np.flatnonzero(np.concatenate([[True], shelf_of[1:] != shelf_of[:-1]]))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                d = pair_distances(metric, _matrix(b.column("q_vec")), points)
                own = d.argmin(1)
                ids = np.asarray(b.column("q_id").fill_null(0))
                home = first[own] + np.abs(ids) % splits[own]
                if mode == "home":
                    row, shelf = np.arange(len(d)), home
                else:
                    limit = np.asarray(b.column("limit"))
                    low = _bounds(light, d)
                    open_ = np.logical_or.reduceat((low <= (limit * (1 + SLACK))[:, None] + SLACK * d)[:, cells], starts, axis=1)
                    if mode == "rest":
                        open_[np.arange(len(d)), home] = False
                    if mode == "after":
                        open_ &= np.arange(open_.shape[1]) >= np.asarray(b.column("home"))[:, None]
                    row, shelf = np.nonzero(open_)
                ends = np.searchsorted(row, np.arange(len(d) + 1))
                shelves = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(shelf, pa.int64()))
                yield pa.RecordBatch.from_arrays([shelves, *b.columns], names=["shelves", *b.schema.names])
    return run


_FOUND = "q_id long, r_id long, dist double, tested long"


def _tile(light, k: int, exclude_self: bool, once: bool = False):
    """One shelf and a block of queries: the k nearest of each (``k`` = 0: all
    within its limit), and a row that tells how many distances were measured.
    ``once``: of two rows of one shelf, which meet both ways, the pair whose
    query has the smaller id; of two shelves, which meet one way, every pair,
    with the smaller id as the query."""
    from orrery.operators.neighbors import _nearest_squared  # travels with the kernel
    metric, kk = light[0], k + 1 if exclude_self else k

    def pivot_distances(q, points):
        """Distances to the pivots and their possible error (bounds only)."""
        if metric != "euclidean" or q.shape[1] < 8 or not (np.isfinite(q).all() and np.isfinite(points).all()):
            d = pair_distances(metric, q, points)
            return d, SLACK * d
        centre = points.mean(0)
        qc, pc = q - centre, points - centre
        q2, p2 = (qc * qc).sum(1), (pc * pc).sum(1)
        d = np.sqrt(np.maximum(q2[:, None] + p2 - 2.0 * qc @ pc.T, 0))
        return d, SLACK * d + 2 * np.sqrt(16 * (q.shape[1] + 4) * np.finfo(float).eps * (q2 + p2.max()))[:, None]

    def part(q, limit, bounds, names, at, ends, r, lowest, ready):
        """(query row, entry, distance, measured) for a few queries."""
        near_pivots, room = pivot_distances(q, bounds[1])
        low, room = _bounds(bounds, near_pivots)[:, names], room[:, names]
        tested, pairs = near_pivots.size, []
        best_d, best_r = np.full((len(q), kk), np.inf), np.full((len(q), kk), -1)
        order, size, i, seen = np.argsort(low.mean(0), kind="stable"), ends - at, 0, 0

        def reach(c):
            return low[:, c] <= limit * (1 + SLACK) + room[:, c]

        while i < len(order):
            open_, j, held = reach(order[i]), i + 1, size[order[i]]
            if 4 * open_.sum() >= 3 * len(q) and (k == 0 or np.isfinite(limit).all()):
                # cells that most queries meet are one product: ever larger ones, as limits shrink
                most = 16_384 if k == 0 else min(16_384, 4 * max(seen, 256))
                while j < len(order) and held + size[order[j]] <= most:
                    more = reach(order[j])
                    if 4 * more.sum() < 3 * len(q):
                        break
                    open_, held, j = open_ | more, held + size[order[j]], j + 1
            alive = np.flatnonzero(open_)
            member = np.concatenate([np.arange(at[c], ends[c]) for c in order[i:j]])
            i, seen = j, seen + held
            if not len(alive):
                continue
            tested += len(alive) * len(member)
            rows = ready and (ready[0], ready[1][member], ready[2][member])
            if k == 0:
                row, col, d = close_pairs(metric, q[alive], r[member], limit[alive], rows)
                pairs.append((alive[row], member[col], d))
                continue
            near = np.isfinite(limit[alive])
            free, alive = alive[~near], alive[near]
            if len(free):  # no k-th distance so far
                m = min(kk, len(member))
                new_d, new_r = np.full((len(free), m), np.inf), np.full((len(free), m), -1)
                if metric == "euclidean":
                    none = np.zeros((len(free), len(member)), bool)
                    row, col, d = _nearest_squared(q[free], r[member], m, none)
                    place = np.arange(len(row)) - np.searchsorted(row, row, "left")
                    new_d[row, place], new_r[row, place] = np.sqrt(d), member[col]
                else:
                    d = pair_distances(metric, q[free], r[member])
                    col = np.argsort(d, axis=1, kind="stable")[:, :m]
                    new_d, new_r = np.take_along_axis(d, col, 1), member[col]
                d, x = np.concatenate([best_d[free], new_d], 1), np.concatenate([best_r[free], new_r], 1)
                tie = np.where(x < 0, np.iinfo(np.int64).max, lowest[x])
                by = np.lexsort((tie, d), axis=1)[:, :kk]
                best_d[free], best_r[free] = np.take_along_axis(d, by, 1), np.take_along_axis(x, by, 1)
                limit[free] = np.minimum(limit[free], best_d[free][:, kk - 1])
            if len(alive):
                row, col, d = close_pairs(metric, q[alive], r[member], limit[alive], rows)
                if not len(row):
                    continue
                some, row = np.unique(alive[row], return_inverse=True)
                row = np.concatenate([np.repeat(np.arange(len(some)), kk), row])
                d, x = np.concatenate([best_d[some].ravel(), d]), np.concatenate([best_r[some].ravel(), member[col]])
                by = np.lexsort((np.where(x < 0, np.iinfo(np.int64).max, lowest[x]), d, row))
                row, d, x = row[by], d[by], x[by]
                first = np.arange(len(row)) - np.searchsorted(row, row, "left") < kk
                best_d[some], best_r[some] = d[first].reshape(-1, kk), x[first].reshape(-1, kk)
                limit[some] = np.minimum(limit[some], best_d[some][:, kk - 1])
        if k == 0:
            return (*((np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, int),) * 3), tested)
        row, place = np.nonzero(best_r >= 0)
        return row, best_r[row, place], best_d[row, place], tested

    def run(left, right):
        import pyarrow as pa
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64()]

        def table(q, r, d, tested):
            n = len(q)
            count = pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array([tested], pa.int64())])
            cols = [pa.concat_arrays([pa.array(x, t), pa.nulls(1, t)]) for x, t in zip((q, r, d), kinds)]
            return pa.Table.from_arrays([*cols, count], names=["q_id", "r_id", "dist", "tested"])
        if not left.num_rows or not right.num_rows:
            return table(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), 0)
        qid, q = np.asarray(left.column("q_id").combine_chunks()), _matrix(left.column("q_vec"))
        limit = np.asarray(left.column("limit").combine_chunks()).copy()
        ids = right.column("ids").combine_chunks()
        sizes = np.diff(np.asarray(ids.offsets))
        flat = np.asarray(ids.flatten())
        start = np.cumsum(sizes) - sizes
        cell, r = np.asarray(right.column("cell").combine_chunks()), _matrix(right.column("vec"))
        bounds, tested = light, 0
        if not len(light[1]):  # no cells yet: those of every m-th row
            points = r[np.lexsort((flat[start],))[::max(1, int(math.sqrt(len(r))))]]
            far = pair_distances(metric, r, points)
            cell, tested = far.argmin(1), far.size
            far = far[np.arange(len(r)), cell]
            radius, inner = np.zeros(len(points)), np.full(len(points), np.inf)
            np.maximum.at(radius, cell, far)
            np.minimum.at(inner, cell, far)
            bounds = (metric, points, radius, np.where(np.isfinite(inner), inner, 0.0), None, None)
        order = np.lexsort((flat[start], cell))
        cell, r, sizes, start = cell[order], r[order], sizes[order], start[order]
        lowest = flat[start]
        names, at = np.unique(cell, return_index=True)
        ends = np.append(at[1:], len(cell))
        # queries of one cell go together: their cell comes first and then rules out others
        own = np.concatenate([pair_distances(metric, q[a:a + 4096], bounds[1][names]).argmin(1) for a in range(0, len(q), 4096)])
        order = np.argsort(own, kind="stable")
        qid, q, limit = qid[order], q[order], limit[order]
        found, few, ready = [], 256 if q.shape[1] < 8 else 1024, narrowed(metric, r)  # queries at a time
        for a in range(0, len(q), few):
            row, *rest, n = part(q[a:a + few], limit[a:a + few], bounds, names, at, ends, r, lowest, ready)
            found.append((row + a, *rest))
            tested += n
        row, entry, d = (np.concatenate(x) for x in zip(*found))
        # an entry stands for each of its ids
        n = sizes[entry]
        row, d = np.repeat(row, n), np.repeat(d, n).astype(float)
        r_id = flat[np.repeat(start[entry], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        if exclude_self:
            other = r_id != qid[row]
            row, r_id, d = row[other], r_id[other], d[other]
        if once:
            guest = np.asarray(left.column("home").combine_chunks())[order] < left.column("shelf")[0].as_py()
            a, keep = qid[row], (qid[row] < r_id) | (guest[row] & (qid[row] != r_id))
            a, r_id, d = a[keep], r_id[keep], d[keep]
            return table(np.minimum(a, r_id), np.maximum(a, r_id), d, tested)
        if k:
            by = np.lexsort((r_id, d, row))
            row, r_id, d = row[by], r_id[by], d[by]
            first_k = np.arange(len(row)) - np.searchsorted(row, row, "left") < k
            row, r_id, d = row[first_k], r_id[first_k], d[first_k]
        return table(qid[row], r_id, d, tested)
    return run


def met(queries: DataFrame, placed: DataFrame, shelves: int, kernel, schema: str, block_rows: int | None, dim: int = 64,
        share: int = 16, keep: bool = True) -> DataFrame:
    """``kernel`` over every shelf with its routed queries, blocks of at most
    about ``block_rows`` of them at a time (by default one of ``share`` parts of
    the shelf's queries, within bounds); with ``keep`` the result is written."""
    n = F.count(F.lit(1))
    if block_rows:
        most = F.lit(block_rows)
    else:
        most = F.least(F.greatest(n / share, F.lit(1024)), F.lit(max(1024, min(32768 * 16 // share, _most(share) // max(1, dim)))))
    per = queries.groupBy("shelf").agg(F.ceil(n / most).alias("blocks"))
    if shelves == 1:
        n = F.lit(max((r["blocks"] for r in per.collect()), default=1)).cast("long")
        blocks = lambda df: df.withColumn("blocks", n)
    else:
        per = small_side(per)
        blocks = lambda df: df.join(per, "shelf")
    left = blocks(queries).withColumn("block", F.pmod(F.xxhash64("q_id", "q_vec"), F.col("blocks"))).drop("blocks")
    right = (blocks(placed).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks"))
    found = left.groupBy("shelf", "block").cogroup(right.groupBy("shelf", "block")).applyInArrow(kernel, schema)
    return cut_lineage(found) if keep else found


def _meet(queries: DataFrame, index: Index, kernel, block_rows: int | None, keep: bool = True) -> DataFrame:
    return met(queries, index.placed, index.shelves, kernel, _FOUND, block_rows, index.points.shape[1], index.share, keep)


def _queries(query: DataFrame, q_id: str, q_vec: str, limit: float | str) -> DataFrame:
    most = F.col(limit).cast("double") if isinstance(limit, str) else F.lit(float(limit))
    q = query.select(F.col(q_id).cast("long").alias("q_id"), F.col(q_vec).cast(_kind(query, q_vec)).alias("q_vec"), most.alias("limit"))
    return q.filter(F.col("q_vec").isNotNull() & ~F.exists("q_vec", lambda x: x.isNull()))


def routed(queries: DataFrame, index: Index, mode: str) -> DataFrame:
    """Queries (q_id, q_vec, limit) with the shelves they go to (see
    ``_router``), which are written as a list beside each query."""
    if index.shelves == 1:
        return queries.select(F.lit(0).cast("long").alias("shelf"), "*")
    schema = "shelves array<long>, " + ", ".join(f"{c} {t}" for c, t in queries.dtypes)
    lists = cut_lineage(queries.mapInArrow(_router(index.light(), mode), schema))
    return lists.select(F.explode("shelves").alias("shelf"), *queries.columns)


def nearest(query: DataFrame, index: Index | None, k: int, q_id: str, q_vec: str, exclude_self: bool = False,
            block_rows: int | None = None) -> DataFrame:
    """(q_id, r_id, dist, tested): candidates among which are the k nearest
    rows of every query; rows with ``tested`` count measured distances.
    Distances are those of the index's metric."""
    q = _queries(query, q_id, q_vec, math.inf)
    if index is None:
        return q.sparkSession.createDataFrame([], _FOUND)
    light = index.light()
    kernel = _tile(light, k, exclude_self)
    found = _meet(routed(q, index, "home"), index, kernel, block_rows)
    if index.shelves == 1:
        return found
    reached = found.filter("tested is null").groupBy(F.col("q_id").alias("_q")).agg(
        F.when(F.count(F.lit(1)) >= k, F.max("dist")).otherwise(F.lit(math.inf)).alias("_limit"))
    q = (q.join(many(reached), F.col("q_id").eqNullSafe(F.col("_q")), "left")
         .select("q_id", "q_vec", F.coalesce("_limit", F.lit(math.inf)).alias("limit")))
    return found.unionByName(_meet(routed(q, index, "rest"), index, kernel, block_rows))


def within(query: DataFrame, index: Index | None, eps: float | str, q_id: str, q_vec: str, block_rows: int | None = None) -> DataFrame:
    """(q_id, r_id, dist, tested): every pair within ``eps`` (a number, or a
    column of the queries: each its own limit).  Each query is
    copied to the shelves its ball reaches; the index must hold every row as
    an entry of its own."""
    q = _queries(query, q_id, q_vec, eps)
    if index is None:
        return q.sparkSession.createDataFrame([], _FOUND)
    return _meet(routed(q, index, "all"), index, _tile(index.light(), 0, False), block_rows)


def pairs_once(index: Index | None, spark, eps: float) -> DataFrame:
    """(q_id, r_id, dist, tested): every pair of the index's own rows within
    ``eps`` once, q_id < r_id.  A row is copied to its own shelf and to those
    behind it that its ball reaches, so that two shelves meet one way.  Rows
    are entries of their own with an id; the result is not written."""
    if index is None:
        return spark.createDataFrame([], _FOUND)
    q = index.placed.select(F.get("ids", F.lit(0)).alias("q_id"), F.col("vec").alias("q_vec"), F.lit(float(eps)).alias("limit"),
                            F.col("shelf").alias("home"))
    return _meet(routed(q, index, "after"), index, _tile(index.light(), 0, False, True), None, keep=False)
