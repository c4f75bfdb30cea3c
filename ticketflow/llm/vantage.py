"""Nearest neighbours by cosine with a vantage-point tree per shard.

On unit vectors the cosine orders like the Euclidean distance, a metric, so a
subtree whose distances to its vantage point lie in [lo, hi] holds nothing
nearer than ``max(lo - d, d - hi)`` to a query at distance d. It is skipped if
``factor`` times that exceeds the query's k-th best distance: factor one is
exact search, a larger factor skips more.

The index is a table with one serialized tree for each shard; queries travel in
blocks, and a task searches one tree for one block at a time. All vectors are
indexed; of equal vectors in a shard the ``k + 1`` smallest distinct ids are kept, as no
other can be among the k nearest of any query.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.llm.common import map_arrow, materialize, ship_package

SHARD_ROWS = 4096
BLOCK_ROWS = 1024
LEAF = 64
# Rounding that the distance bounds must allow for.
SLACK = 1e-7


def valid_vectors(rows: DataFrame) -> DataFrame:
    """``(vec_id, v)`` as doubles, without null ids and null, empty, zero or non-finite vectors."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.where("vec_id is not null").select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))
            .where(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)))


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot product of each row pair, added from left to right: equal rows give
    equal results wherever they lie."""
    return np.add.accumulate(a * b, axis=1)[:, -1]


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(dots(x, x))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by the power of two of their largest component: squares of very
    large or small ones stay in range, and all others keep every bit."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / norms(x)[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = scaled(a), scaled(b)
    return dots(a, b) / (norms(a) * norms(b))


def build_tree(ids: np.ndarray, x: np.ndarray, k: int, leaf: int = LEAF) -> bytes:
    """Serialized tree of one shard."""
    order = np.lexsort((ids, *x.T[::-1]))
    ids, x = ids[order], np.ascontiguousarray(x[order])
    new = np.ones(len(ids), bool)
    new[1:] = (x[1:] != x[:-1]).any(axis=1)
    # rows that repeat an id and its vector count once
    once = new | np.append(True, ids[1:] != ids[:-1])
    ids, x, new = ids[once], x[once], new[once]
    start = np.flatnonzero(new)
    rank = np.arange(len(ids)) - np.repeat(start, np.diff(np.append(start, len(ids))))
    ids, x = ids[rank <= k], x[rank <= k]
    unit = units(x)
    perm = np.arange(len(ids))
    nodes: list[list[int]] = []
    bounds: list[list[float]] = []
    points: list[np.ndarray] = []

    def grow(lo: int, hi: int) -> int:
        me = len(nodes)
        nodes.append([lo, hi, -1, -1])
        bounds.append([0.0] * 4)
        points.append(unit[perm[lo]])
        if hi - lo > leaf:
            own = unit[perm[lo:hi]]
            points[me] = own[np.argmax(((own - own[0]) ** 2).sum(axis=1))]
            d = np.sqrt(((own - points[me]) ** 2).sum(axis=1))
            by = np.argsort(d, kind="stable")
            perm[lo:hi], d, mid = perm[lo:hi][by], d[by], (hi - lo) // 2
            bounds[me] = [d[0], d[mid - 1], d[mid], d[-1]]
            nodes[me][2] = grow(lo, lo + mid)
            nodes[me][3] = grow(lo + mid, hi)
        return me

    grow(0, len(ids))
    out = io.BytesIO()
    np.savez(out, ids=ids[perm], x=x[perm], nodes=np.array(nodes), bounds=np.array(bounds), points=np.array(points))
    return out.getvalue()


def search_tree(tree: bytes, q_ids: np.ndarray, q: np.ndarray, k: int, factor: float = 1.0):
    """``(query position, vec_id, score)`` of the k nearest of each query in one shard."""
    t = np.load(io.BytesIO(tree))
    ids, x, nodes, bounds, points = (t[n] for n in ("ids", "x", "nodes", "bounds", "points"))
    unit, uq = units(x), units(q)
    best = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    kth = np.full(len(q), -np.inf)

    def scan(node: int, active: np.ndarray) -> None:
        lo, hi = nodes[node][:2]
        near = uq[active] @ unit[lo:hi].T >= kth[active][:, None] - SLACK
        near &= ids[lo:hi][None, :] != q_ids[active][:, None]
        i, j = np.nonzero(near)
        if not len(i):
            return
        qi, xi = active[i], lo + j
        a = np.concatenate([best[0], qi])
        b = np.concatenate([best[1], ids[xi]])
        c = np.concatenate([best[2], cosines(q[qi], x[xi])])
        order = np.lexsort((b, -c, a))
        a, b, c = a[order], b[order], c[order]
        same = np.zeros(len(a), bool)
        same[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        a, b, c = a[~same], b[~same], c[~same]
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        rank = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
        keep = rank < k
        best[:] = a[keep], b[keep], c[keep]
        full = rank == k - 1
        kth[a[full]] = c[full]

    def to_point(node: int, active: np.ndarray) -> np.ndarray:
        return np.sqrt(((uq[active] - points[node]) ** 2).sum(axis=1))

    def home(node: int, active: np.ndarray) -> None:
        if nodes[node][2] < 0:
            return scan(node, active)
        inner = to_point(node, active) <= (bounds[node][1] + bounds[node][2]) / 2
        for side, at in ((inner, 2), (~inner, 3)):
            if side.any():
                home(nodes[node][at], active[side])

    def visit(node: int, active: np.ndarray) -> None:
        if nodes[node][2] < 0:
            return scan(node, active)
        d = to_point(node, active)
        for at, lo, hi in ((2, *bounds[node][:2]), (3, *bounds[node][2:])):
            least = np.maximum(np.maximum(lo - d, d - hi), 0.0)
            reach = np.sqrt(np.maximum(2 - 2 * kth[active], 0.0))
            go = least * factor <= reach + SLACK
            if go.any():
                visit(nodes[node][at], active[go])

    everyone = np.arange(len(q))
    home(0, everyone)
    visit(0, everyone)
    return best


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(dim, shard, shards, tree)``: about ``shard_rows`` vectors of one length to a shard."""
    sizes = vectors.groupBy(F.size("v").alias("dim")).agg(
        F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    rows = vectors.withColumn("dim", F.size("v")).join(sizes, "dim").withColumn(
        "shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))

    def grow(t: pa.Table) -> pa.Table:
        dim, shard, shards = (t.column(n)[0].as_py() for n in ("dim", "shard", "shards"))
        x = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        tree = build_tree(t.column("vec_id").to_numpy(), x, k)
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()),
                         "shards": pa.array([shards], pa.int32()), "tree": pa.array([tree], pa.binary())})

    ship_package(vectors.sparkSession)
    index = rows.groupBy("dim", "shard").applyInArrow(grow, "dim int, shard int, shards int, tree binary")
    return materialize(index, "vantage-index")


def query_blocks(queries: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(dim, ids, vectors)`` as binary doubles and longs, at most ``block_rows`` queries to a row."""
    def pack(batches):
        for b in batches:
            dims, ids = b.column(0).to_numpy(), b.column(1).to_numpy()
            vs = b.column(2)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for part in np.array_split(at, -(-len(at) // block_rows)):
                    x = vs.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False)
                    yield {"dim": [int(dim)], "ids": [ids[part].tobytes()], "vectors": [x.tobytes()]}

    # blocks come from whole partitions, so neighbours in a small one share a row
    return map_arrow(queries.select(F.size("v").alias("dim"), "vec_id", "v"), pack,
                     "dim int, ids binary, vectors binary")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, factor: float = 1.0,
            shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest vectors of each query.

    Largest cosine first, ties to the smaller id; fewer rows if there are fewer
    candidates. A query is not its own candidate, nor are rows that repeat its
    id; only vectors of its length are compared with it. Rows that
    ``valid_vectors`` leaves out take no part.
    """
    trees = build_index(valid_vectors(vectors), k, shard_rows)
    shards = trees.select("dim", "shards").distinct()
    blocks = (query_blocks(valid_vectors(queries), block_rows).join(shards, "dim")
              .select("dim", "ids", "vectors", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")))

    def search(batches):
        for b in batches:
            for dim, ids, vs, tree in zip(*(b.column(c).to_pylist() for c in ("dim", "ids", "vectors", "tree"))):
                q_ids, q = np.frombuffer(ids, np.int64), np.frombuffer(vs, np.float64).reshape(-1, dim)
                at, found, score = search_tree(tree, q_ids, q, k, factor)
                yield {"query_id": q_ids[at], "vec_id": found, "score": score}

    pairs = blocks.join(trees.drop("shards"), ["dim", "shard"]).select("dim", "ids", "vectors", "tree")
    hits = map_arrow(pairs, search, "query_id bigint, vec_id bigint, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
