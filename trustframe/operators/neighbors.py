"""Exact k nearest neighbours within one table (J7) by metric partitioning.

1. Equal vectors become one *point* that carries its k + 1 smallest ids, so copies are
   compared once however many there are.
2. A k-d tree over a hash-drawn sample cuts the points into cells: about 500 points each in few
   dimensions, so a point is compared with as many however long the table is; in many
   dimensions, where no cell can be excluded, few cells, as each one costs a copy of all points.
3. A point is compared with its own cell first. The k + 1-th distance found there (or, in a
   small cell, the reach of the smallest part of the tree around it that holds enough rows) bounds what
   its neighbours can be at.
4. It is then sent only to cells whose bounding box is within that bound, found down the tree.
5. The candidates are merged to the k nearest, ties by id.

A cell's rows are dealt to blocks of at most ``block`` points and a block's visitors to
several tasks where there are many, so neither a dense cell nor a much visited one grows a task. No
candidate is dropped; how much work the bounds save depends on the data (in many dimensions
little, and the job stays one of all pairs, in blocks). Distances are summed dimension by dimension, as an SQL
expression would; in many dimensions a matrix product, with its rounding allowed for, first tells which pairs can count.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trustframe.session import cut_lineage, importable_in_tasks

#: bytes of a block's points and most of them, visitors of a block in one task
BLOCK_BYTES, BLOCK, VISITORS = 16 << 20, 32_768, 65_536
#: points of a cell in few dimensions, cells in many (more, where a cell would pass a block)
CELL_POINTS, FEW_CELLS = 512, 16
#: bytes of the sample that the tree is made from, which travels through the driver
MAX_SAMPLE_BYTES = 32 << 20
#: cells of a distance table held at a time, points that walk down the tree at a time
CELLS, WALK = 1 << 21, 512
#: dimensions above which a matrix product precedes the distances
PRODUCT_DIMS = 8


def _vectors(col: pa.Array, dims: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dims)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b, summed in the order of dimensions."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        d = a[:, j, None] - b[None, :, j]
        d *= d
        out += d
    return out


def _chunks(n: int, width: int):
    step = max(1, CELLS // max(1, width))
    return ((i, min(i + step, n)) for i in range(0, n, step))


def _grow(x: np.ndarray, m: int) -> tuple[np.ndarray, ...]:
    """A k-d tree of up to m leaves, even over the sample x: axis, cut, child and leaf of each node. Points below the
    cut go on to node ``child``, the others to the one after it; a leaf has child -1 and its number."""
    axis, cut, child, leaf = [0], [0.0], [-1], [-1]
    todo, leaves = [(0, np.arange(len(x)), m)], 0
    while todo:
        node, rows, m = todo.pop()
        y = x[rows]
        low, high = (y.min(0), y.max(0)) if len(y) else (np.zeros(0), np.zeros(0))
        if m > 1 and (high > low).any():
            with np.errstate(invalid="ignore"):
                a = int(np.where(high > low, high - low, 0.0).argmax())
            v = y[:, a]
            at = min(len(v) - 1, max(1, len(v) * (m // 2) // m))
            c = np.partition(v, at)[at]
            c = v[v > c].min() if c == low[a] else c
            below = v < c
            ml = min(m - 1, max(1, round(m * int(below.sum()) / len(v))))
            axis[node], cut[node], child[node] = a, c, len(axis)
            todo += [(len(axis), rows[below], ml), (len(axis) + 1, rows[~below], m - ml)]
            for column, empty in ((axis, 0), (cut, 0.0), (child, -1), (leaf, -1)):
                column += [empty, empty]
        else:
            leaf[node], leaves = leaves, leaves + 1
    return np.array(axis), np.array(cut), np.array(child), np.array(leaf)


def _boxes(tree: tuple[np.ndarray, ...], stats: list, dims: int, k: int) -> tuple[np.ndarray, ...]:
    """Bounding box of each node's points, its rows, and for each leaf the smallest node around it that
    holds over k rows (-1: none)."""
    child, leaf = tree[2:]
    lo, hi, rows = np.full((len(child), dims), np.inf), np.full((len(child), dims), -np.inf), np.zeros(len(child), np.int64)
    node_of = np.empty(leaf.max() + 1, np.int64)
    node_of[leaf[leaf >= 0]] = np.flatnonzero(leaf >= 0)
    for r in stats:
        n = node_of[r["cell"]]
        lo[n], hi[n], rows[n] = r["lo"], r["hi"], r["rows"]
    around = np.full(len(child), -1)
    for n in range(len(child) - 1, -1, -1):  # children come after their parent
        c = child[n]
        if c >= 0:
            lo[n], hi[n], rows[n] = np.minimum(lo[c], lo[c + 1]), np.maximum(hi[c], hi[c + 1]), rows[c] + rows[c + 1]
    for n in range(len(child)):
        around[n] = n if rows[n] > k else around[n]
        c = child[n]
        if c >= 0:
            around[c] = around[c + 1] = around[n]
    return lo, hi, rows, around[node_of]


def _assign(tree, dims: int):
    """Adds the leaf of the tree that each point is in."""
    def run(batches):
        axis, cut, child, leaf = tree.value
        for b in batches:
            x = _vectors(b.column("vec"), dims)
            node = np.zeros(len(x), np.int64)
            on = np.arange(len(x)) if child[0] >= 0 else np.zeros(0, np.int64)
            while len(on):
                n = node[on]
                node[on] = child[n] + (x[on, axis[n]] >= cut[n])
                on = on[child[node[on]] >= 0]
            yield b.append_column("cell", pa.array(leaf[node].astype(np.int32)))
    return run


def _visits(tree, boxes, dims: int):
    """Adds the other cells that may hold one of the k nearest of each point; ``bound`` as far as they matter."""
    def walk(x, own, limit, child, leaf, lo, hi, rows):
        points, cells = [], []
        point, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        while len(point):
            end = child[node] < 0
            points.append(point[end])
            cells.append(leaf[node[end]])
            point, node = np.tile(point[~end], 2), child[node[~end]]
            node = np.concatenate([node, node + 1])
            gap = np.zeros(len(point))
            for j in range(dims):
                v = x[point, j]
                with np.errstate(invalid="ignore"):
                    d = np.fmax(np.fmax(lo[node, j] - v, v - hi[node, j]), 0.0)
                gap += d * d
            near = (gap <= limit[point]) & (rows[node] > 0)
            point, node = point[near], node[near]
        points, cells = np.concatenate(points), np.concatenate(cells)
        other = cells != own[points]
        points, cells = points[other], cells[other]
        order = np.argsort(points, kind="stable")
        return np.bincount(points, minlength=len(x)), cells[order]

    def run(batches):
        (_, _, child, leaf), (lo, hi, rows, around) = tree.value, boxes.value
        for b in batches:
            for at in range(0, b.num_rows, WALK):
                c = b.slice(at, WALK)
                x = _vectors(c.column("vec"), dims)
                own, theta = c.column("cell").to_numpy(), c.column("bound").to_numpy(zero_copy_only=False)
                wide = around[own]
                with np.errstate(invalid="ignore"):
                    reach = np.maximum(np.abs(x - lo[wide]), np.abs(hi[wide] - x))
                    far = np.sqrt((reach * reach).sum(1))
                    t = np.fmin(theta, np.where(wide >= 0, far, np.inf)) * (1 + 1e-9) + 1e-12
                many, cells = walk(x, own, t * t, child, leaf, lo, hi, rows)
                go = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)).astype(np.int32)), pa.array(cells.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([c.column("p"), c.column("vec"), c.column("near"), pa.array(t), go],
                                                 ["p", "vec", "near", "bound", "go"])
    return run


def _pairs(a: np.ndarray, b: np.ndarray, centred: tuple | None, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, squared distance) of the pairs that can be one of the k + 1 nearest points of i in b, as far as i's limit.
    ``centred``: b's mean, b without it, and the squared lengths of that."""
    q = min(k + 1, len(b))
    dims = a.shape[1]
    if centred is not None:
        middle, b0, bb = centred
        a0 = a - middle
        aa = (a0 * a0).sum(1)
    if centred is None or not (aa.max() < 1e150 and bb.max() < 1e150):
        d = _squared(a, b)
        reach = np.minimum(np.partition(d, q - 1, axis=1)[:, q - 1], limit)
        i, j = np.nonzero(d <= reach[:, None])
        return i, j, d[i, j]
    # |a|^2 + |b|^2 - 2 ab is off by less than this, summed in whatever order
    off = 8 * (dims + 8) * np.finfo(float).eps * (np.sqrt(aa) + np.sqrt(bb.max())) ** 2 + 1e-300
    d = a0 @ b0.T
    d *= -2
    d += aa[:, None]
    d += bb
    i, j = np.nonzero(d <= (limit + off)[:, None])
    if len(i) > 4 * q * len(a):  # a wide limit
        i, j = np.nonzero(d <= np.minimum(np.partition(d, q - 1, axis=1)[:, q - 1] + 2 * off, limit + off)[:, None])
    d = np.zeros(len(i))
    for c in range(dims):
        e = a[i, c] - b[j, c]
        d += e * e
    ok = d <= limit[i]
    return i[ok], j[ok], d[ok]


def _match(dims: int, k: int):
    """Streams sorted blocks, residents first: the k + 1 nearest rows in the block for each visitor, as far as its bound."""
    def centre(x):
        if dims <= PRODUCT_DIMS:
            return None
        with np.errstate(all="ignore"):
            middle = x.mean(0)
            x = x - middle
            return middle, x, (x * x).sum(1)

    def nearest(visitors, residents, centred, first, size, rank, ids):
        x = _vectors(visitors.column("vec"), dims)
        limit = visitors.column("bound").to_numpy(zero_copy_only=False) ** 2
        for lo, hi in _chunks(len(x), len(residents)):
            i, j, d = _pairs(x[lo:hi], residents, centred, limit[lo:hi], k)
            n = size[j]
            ends = np.cumsum(n)
            entry = np.arange(int(n.sum())) - np.repeat(ends - n - first[j], n)
            dist, row = np.repeat(d, n), np.repeat(i, n)
            order = np.lexsort((rank[entry], dist, row))
            row, entry, dist = row[order], entry[order], dist[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) <= k
            row, entry, dist = row[keep], entry[keep], dist[keep]
            if len(row):
                who, at = np.unique(row, return_index=True)
                rows = pa.StructArray.from_arrays([pa.array(dist), ids.take(pa.array(entry))], ["d", "id"])
                near = pa.ListArray.from_arrays(pa.array(np.append(at, len(row)).astype(np.int32)), rows)
                yield pa.RecordBatch.from_arrays([visitors.column("p").take(pa.array(lo + who)), near], ["p", "near"])

    def run(batches):
        key, parts, block = None, [], None
        for b in batches:
            keys = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "block", "copy", "visitor")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for lo, hi in zip(np.append(0, cuts), np.append(cuts, b.num_rows)):
                if hi == lo:
                    continue
                now, piece = tuple(keys[:3, lo]), b.slice(lo, hi - lo)
                if now != key:
                    key, parts, block = now, [], None
                if not keys[3, lo]:
                    parts.append(piece)
                elif parts:
                    if block is None:
                        lists = pa.chunked_array([x.column("ids") for x in parts]).combine_chunks()
                        ids = lists.flatten()
                        rank = np.empty(len(ids), np.int64)
                        rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
                        size = pc.list_value_length(lists).to_numpy().astype(np.int64)
                        points = np.concatenate([_vectors(x.column("vec"), dims) for x in parts])
                        block = points, centre(points), np.cumsum(size) - size, size, rank, ids
                    yield from nearest(piece, *block)
    return run


def _nearest(k: int) -> Column:
    """The k + 1 nearest of all lists of a point."""
    return F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k + 1)


def knn_self_join(df: DataFrame, id_col: str, vec: Column, k: int = 5, seed: int = 42, block: int | None = None, pivots: int | None = None,
                  report: dict | None = None) -> DataFrame:
    """The k nearest other rows of every row by Euclidean distance: ``id_col``, rank (from 1), neighbor (its id),
    distance; equal distances by ascending id. Fewer rows where the table has not k others.

    ``vec`` is an array of numbers, equally long in all rows; rows whose vector or id is null, or whose vector
    holds a null or NaN, have no neighbours and are none. Ids are unique (a row is no neighbour of rows with its id).
    ``pivots`` sets the number of cells. ``report`` gets the numbers of points, pivots (cells) and visits (point and
    cell pairs beyond the own cell)."""
    importable_in_tasks(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    v = F.transform(vec, lambda x: x.cast("double") + F.lit(0.0))
    rows = df.select(F.col(id_col).alias("id"), v.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x)))
    rows = cut_lineage(rows)
    # the row limit of the window works before the shuffle: a vector that a third of all rows share stays small
    few = rows.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("r") <= k + 1)
    points = few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    points = cut_lineage(points.withColumn("p", F.monotonically_increasing_id()))
    n, dims = points.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not n:
        return rows.select(F.col("id").alias(id_col), F.lit(0).alias("rank"), F.col("id").alias("neighbor"), F.lit(0.0).alias("distance"))
    wide = 8 * max(1, dims)
    block = block or max(1, min(BLOCK, BLOCK_BYTES // wide))
    m = math.isqrt(n - 1) + 1
    if dims <= math.log2(n) / 2:
        m = max(m, n // CELL_POINTS)
    else:  # nearly every point visits nearly every cell
        m = min(m, max(FEW_CELLS, -(-n // block)))
    m = pivots or min(m, n // (2 * k + 2))
    m = max(1, min(n, m, MAX_SAMPLE_BYTES // wide))
    share = min(1.0, (16 * m + 1000) / n, MAX_SAMPLE_BYTES / wide / n)
    # a hash-drawn part, bounded by MAX_SAMPLE_BYTES
    drawn = points.where(F.pmod(F.xxhash64("vec", F.lit(seed)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))).select("vec").toArrow()
    sc = df.sparkSession.sparkContext
    tree = _grow(_vectors(drawn.column("vec").combine_chunks(), dims) if drawn.num_rows else np.zeros((0, dims)), m)
    m = int(tree[3].max()) + 1
    shared = sc.broadcast(tree)
    schema = f"vec array<double>, ids array<{kind}>, p bigint, cell int"
    cells = cut_lineage(points.mapInArrow(_assign(shared, dims), schema))
    ends = [F.array(*[f(F.get("vec", F.lit(j))) for j in range(dims)]).cast("array<double>").alias(c) for f, c in ((F.min, "lo"), (F.max, "hi"))]
    per = cells.groupBy("cell").agg(F.count("*").alias("points"), F.sum(F.size("ids")).alias("rows"), *ends)
    stats = per.collect()  # one row per cell
    boxes = sc.broadcast(_boxes(tree, stats, dims, k))
    near_type = f"p bigint, near array<struct<d: double, id: {kind}>>"

    def compared(visits: DataFrame, count: dict) -> DataFrame:
        """Lists of the nearest rows for (p, vec, bound, cell), one per block of the cell."""
        shape = [(r["cell"], -(-r["points"] // block), -(-count[r["cell"]] // VISITORS)) for r in stats if count.get(r["cell"])]
        blocks = sum(b * c for _, b, c in shape)
        shape = F.broadcast(df.sparkSession.createDataFrame(shape, "cell int, blocks int, copies int"))  # one row per cell
        zero = F.lit(None)
        at = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        home = cells.join(shape, "cell").select("cell", F.pmod(F.xxhash64("p"), "blocks").cast("int").alias("block"), at("copies").alias("copy"),
                                                F.lit(0).alias("visitor"), "p", "vec", zero.cast("double").alias("bound"), "ids")
        guest = visits.join(shape, "cell").select("cell", at("blocks").alias("block"), F.pmod(F.xxhash64("p", F.lit(1)), "copies").cast("int").alias("copy"),
                                                  F.lit(1).alias("visitor"), "p", "vec", "bound", zero.cast(f"array<{kind}>").alias("ids"))
        # a task has several blocks, one after the other; the more there is to compare, the more tasks
        tasks = min(blocks, max(4 * sc.defaultParallelism, sum(count.values()) // VISITORS))
        both = home.unionByName(guest).repartition(tasks, "cell", "block", "copy").sortWithinPartitions("cell", "block", "copy", "visitor")
        return both.mapInArrow(_match(dims, k), near_type)

    own = compared(cells.select("p", "vec", F.lit(float("inf")).alias("bound"), "cell"), {r["cell"]: r["points"] for r in stats})
    own = own.groupBy("p").agg(_nearest(k).alias("near"))
    bound = F.when(F.size("near") > k, F.sqrt(F.get("near", F.lit(k)).d)).otherwise(F.lit(float("inf")))
    own = cells.select("p", "vec", "cell").join(own, "p").withColumn("bound", bound)
    own = cut_lineage(own.mapInArrow(_visits(shared, boxes, dims), f"p bigint, vec array<double>, near {own.schema['near'].dataType.simpleString()}, "
                                                                   "bound double, go array<int>"))
    # the vectors are copied on their way to the cells only, nowhere kept
    visits = own.select("p", "vec", "bound", F.explode("go").alias("cell"))
    count = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}  # one row per cell
    if report is not None:
        report.update(points=n, pivots=m, visits=sum(count.values()))
    found = own.select("p", "near")
    if count:
        found = found.unionByName(compared(visits, count)).groupBy("p").agg(_nearest(k).alias("near"))
    found = own.select("p", "vec").join(found, "p").select("vec", "near")
    # back to the rows; the engine splits a vector that very many rows share
    out = rows.join(found, "vec").select("id", F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k).alias("near"))
    out = out.select("id", F.posexplode("near").alias("r", "x"))
    return out.select(F.col("id").alias(id_col), (F.col("r") + 1).alias("rank"), F.col("x.id").alias("neighbor"), F.sqrt("x.d").alias("distance"))
