"""Near-duplicates by MinHash and an LSH forest, links confirmed on full sets.

1. Documents with equal shingle sets are one class; its smallest doc_id stands
   for it. Every class has a MinHash signature.
2. The forest sorts the classes by their signatures in several orders, each
   beginning at another block of values. Classes that share the first block of an
   order are a region. In a region of bounded size all pairs whose signatures agree
   often enough are candidates, and a spanning forest of them is kept: what matters is
   which classes may be connected. In a dense region the candidates are the
   neighbours with the longest common prefix, that is the next rows of the sorted order,
   also across the edges of tasks. Members outside the largest part that these connect
   are searched deeper, each region on its own: it is split by one more block of
   values, in several orders again, until its parts are of bounded size. After
   ``LEVELS`` blocks the members that are still outside are compared with everything in
   their region, so that depth alone never loses a pair.
3. Classes connected by candidates are a cluster. Clusters are confirmed on the
   full sets in blocks of bounded size: a block finds all its links by an
   inverted index of shingles. A cluster of several blocks shares its first
   member with each block; the members that did not join its largest part are
   then compared with all its blocks. A large group of copies thus costs about
   its size, and no link inside a cluster is lost.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import bounded_broadcast, map_arrow, materialize
from ticketflow.llm.components import components

WIDTH = 5
SIMILARITY_PERCENT = 80
HASHES = 64
# Orders of the forest, each beginning at a block of DEPTH values.
ORDERS = 21
DEPTH = 3
REGION_ROWS = 4096
# Blocks by which a dense region is split, and the blocks after the last one that are tried for that.
LEVELS = 3
SPREAD = 7
# Rows before a row of a sorted order that are its candidates.
NEIGHBOURS = 8
# Agreeing values of 64 below which a pair at the threshold falls once in 10^7.
LEAST_AGREEING = 34
BLOCK_DOCS = 2000
BLOCK_SHINGLES = 2_000_000
# Bytes reckoned for a broadcast row of a few numbers, and of a group name and a number.
REGION_ROW_BYTES = 64
MEMBER_ROW_BYTES = 128

# Words whose hashes a task remembers at once.
KNOWN_WORDS = 250_000

_MULTIPLIERS = np.random.default_rng(20240601).integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S = np.uint64(29)


class _WordHashes(dict):
    """Hashes of words met so far, up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes | None, width: int, hashes: _WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; of a shorter text, of all its words."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(width, len(h))
    acc = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        acc = (acc ^ h[j:j + len(acc)]) * _P1
        acc ^= acc >> _S
        acc *= _P2
    return np.unique(acc)


def signature(shingles: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 4096):
        x = shingles[lo:lo + 4096]
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        out = np.minimum(out, (x[:, None] * _MULTIPLIERS).min(axis=0))
    return (out >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_shingles, digest, sig)``; digest and signature are null without shingles."""
    def run(batches):
        hashes = _WordHashes()
        for b in batches:
            out = {"n_shingles": [], "digest": [], "sig": []}
            for text in b.column(1).cast(pa.binary()).to_pylist():
                s = shingle_set(text, width, hashes)
                out["n_shingles"].append(len(s))
                out["digest"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                out["sig"].append(signature(s).tobytes() if len(s) else None)
            yield {"doc_id": b.column(0), **out}

    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run,
                     "doc_id bigint, n_shingles bigint, digest binary, sig binary")


def _sketch(sig: bytes) -> np.ndarray:
    return np.frombuffer(sig, np.uint32).astype(np.uint8)


def _block(sig: str, block) -> Column:
    """The values of one block of a signature."""
    return F.substr(sig, block * (4 * DEPTH) + 1, F.lit(4 * DEPTH))


def forest_edges(reps: DataFrame, region_rows: int = REGION_ROWS) -> DataFrame:
    """Candidate edges ``(a, b)`` between representatives ``(node, n_shingles, sig)``."""
    block = F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1)))
    members = reps.select("node", "n_shingles", "sig", F.col("node").alias("part"), block.alias("block"))
    key = F.xxhash64("block", _block("sig", F.col("block")))
    return _search(members.withColumn("key", key), None, region_rows, 1)


def _search(members: DataFrame, known: DataFrame | None, region_rows: int, level: int) -> DataFrame:
    """Edges inside the regions ``key`` of ``members`` that connect different parts of ``known`` edges."""
    sizes = materialize(members.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("part").alias("least"),
                                                   F.max("part").alias("most")).where("least <> most")
                        .select("key", (F.col("rows") > region_rows).alias("dense")), "forest-regions")
    regions, _ = bounded_broadcast(sizes, REGION_ROW_BYTES)
    live = members.join(regions, "key")
    sparse = _region_edges(live.where("not dense").withColumn("group", F.col("key"))).distinct()
    if sizes.where("dense").isEmpty():
        return materialize(sparse, "forest-edges")
    dense = materialize(live.where("dense").drop("dense"), "forest-dense")
    edges = materialize(sparse.union(_neighbour_edges(dense)).distinct(), "forest-edges")
    known = edges if known is None else known.union(edges)
    wide, rest = _parts(dense, known)
    if rest.isEmpty():
        return edges
    if level == LEVELS:
        return edges.union(_outside_edges(wide, rest, region_rows))
    # members outside the largest part, and those of it that may meet one of them, one block deeper
    rest, _ = bounded_broadcast(rest, REGION_ROW_BYTES)
    after = F.explode(F.array(*[F.pmod(F.col("block") + i, F.lit(ORDERS)) for i in range(1, SPREAD + 1)]))
    split = (wide.join(rest.select("key", "largest"), "key").withColumn("block", after)
             .withColumn("key", F.xxhash64("key", "block", _block("sig", F.col("block")))))
    outside = split.where("part <> largest").drop("largest")
    met, _ = bounded_broadcast(materialize(outside.select("key").distinct(), "forest-met"), REGION_ROW_BYTES)
    inside = split.where("part = largest").drop("largest").join(met, "key", "left_semi")
    return edges.union(_search(outside.unionByName(inside), known, region_rows, level + 1))


def _parts(dense: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with their part under ``known`` edges; the largest part of each region, and how many rows are outside it."""
    wide = materialize(dense.drop("part").join(components(known), "node", "left")
                       .withColumn("part", F.coalesce("component", "node")).drop("component"), "forest-parts")
    counted = wide.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    rest = (counted.groupBy("key").agg(F.max_by("part", F.struct("n", "part")).alias("largest"), F.sum("n").alias("rows"),
                                       (F.sum("n") - F.max("n")).alias("outside")).where("outside > 0"))
    return wide, materialize(rest, "forest-rest")


def _neighbour_edges(dense: DataFrame) -> DataFrame:
    """Candidates among neighbours of the sorted orders: each row and the ``NEIGHBOURS`` rows before it in its region.

    An order is the signature from the region's block on, then from its start. Rows are
    sorted by range, so a region may lie in many tasks; the rows at the edges of
    tasks are compared with those of the next task.
    """
    at = F.col("block") * (4 * DEPTH) + 1
    turned = F.concat(F.substr("sig", at), F.substr("sig", F.lit(1), at - 1))
    placed = materialize(dense.withColumn("turned", turned).repartitionByRange("key", "turned", "node")
                         .sortWithinPartitions("key", "turned", "node").drop("turned")
                         .withColumn("place", F.monotonically_increasing_id()), "forest-sorted")

    def run(batches):
        keys, nodes, sizes, x = [], np.empty(0, np.int64), np.empty(0, np.int64), None
        for b in batches:
            rows = [_sketch(s) for s in b.column("sig").to_pylist()]
            if not rows:
                continue
            head = len(nodes)
            keys = np.concatenate([np.array(keys, np.int64), b.column("key").to_numpy()])
            nodes = np.concatenate([nodes, b.column("node").to_numpy()])
            sizes = np.concatenate([sizes, b.column("n_shingles").to_numpy()])
            x = np.stack(rows) if x is None else np.concatenate([x, np.stack(rows)])
            left, right = [], []
            for w in range(1, NEIGHBOURS + 1):
                i = np.arange(max(head, w), len(nodes))
                j = i - w
                near = i[(keys[i] == keys[j]) & ((x[i] == x[j]).sum(axis=1) >= LEAST_AGREEING)
                         & (100 * np.minimum(sizes[i], sizes[j]) >= SIMILARITY_PERCENT * np.maximum(sizes[i], sizes[j]))]
                left.append(nodes[near - w])
                right.append(nodes[near])
            yield {"a": np.concatenate(left), "b": np.concatenate(right)}
            keys, nodes, sizes, x = keys[-NEIGHBOURS:], nodes[-NEIGHBOURS:], sizes[-NEIGHBOURS:], x[-NEIGHBOURS:]

    inner = map_arrow(placed.select("key", "node", "n_shingles", "sig"), run, "a bigint, b bigint")
    task, within = F.shiftright("place", 33), F.col("place") - F.shiftleft(F.shiftright("place", 33), 33)
    counts = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect()  # one row a task
    if len(counts) < 2:
        return inner
    numbered = F.broadcast(dense.sparkSession.createDataFrame(
        [(r.task, r.n, i) for i, r in enumerate(counts)], "task bigint, n bigint, number bigint"))
    rows = placed.withColumn("task", task).withColumn("within", within).join(numbered, "task")
    head = rows.where(F.col("within") < NEIGHBOURS).withColumn("group", F.col("number") - 1)
    tail = rows.where(F.col("within") >= F.col("n") - NEIGHBOURS).withColumn("group", F.col("number"))
    return inner.union(_region_edges(head.unionByName(tail)))


def _outside_edges(wide: DataFrame, rest: DataFrame, region_rows: int) -> DataFrame:
    """Members outside the largest part of their region against all of the region, in chunks of bounded size."""
    chunks = rest.select("key", "largest", F.ceil(F.col("rows") / region_rows).alias("chunks"),
                         F.ceil(F.col("outside") / region_rows).alias("batches"))
    chunks, _ = bounded_broadcast(materialize(chunks, "forest-chunks"), REGION_ROW_BYTES)
    wide = wide.join(chunks, "key")

    def every(n):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    outside = (wide.where("part <> largest").withColumn("batch", F.pmod(F.xxhash64("node", "key", F.lit(1)), F.col("batches")))
               .withColumn("chunk", every("chunks")))
    dealt = wide.withColumn("chunk", F.pmod(F.xxhash64("node", "key"), F.col("chunks"))).withColumn("batch", every("batches"))
    both = outside.unionByName(dealt).withColumn("group", F.xxhash64("key", "chunk", "batch"))
    return materialize(_region_edges(both).distinct(), "forest-edges")


def _region_edges(members: DataFrame) -> DataFrame:
    """A spanning forest of the pairs in each ``group`` that agree often enough and differ in ``part``."""
    in_groups = (members.select("group", "node", "n_shingles", "sig", "part").repartition("group")
                 .sortWithinPartitions("group", "n_shingles", "node"))

    def run(batches):
        group, nodes, sizes, sketches, parts = None, [], [], [], []
        for b in batches:
            found_a, found_b = [], []
            for g, node, n, sig, part in zip(*(b.column(c).to_pylist() for c in ("group", "node", "n_shingles", "sig", "part"))):
                if g != group:
                    _spanning(nodes, sizes, sketches, parts, found_a, found_b)
                    group, nodes, sizes, sketches, parts = g, [], [], [], []
                nodes.append(node)
                sizes.append(n)
                sketches.append(_sketch(sig))
                parts.append(part)
            yield {"a": found_a, "b": found_b}
        found_a, found_b = [], []
        _spanning(nodes, sizes, sketches, parts, found_a, found_b)
        yield {"a": found_a, "b": found_b}

    return map_arrow(in_groups, run, "a bigint, b bigint")


def _spanning(nodes: list, sizes: list, sketches: list, parts: list, out_a: list, out_b: list) -> None:
    m = len(nodes)
    if m < 2:
        return
    x, n = np.stack(sketches), np.array(sizes)
    label = np.unique(parts, return_inverse=True)[1]
    # sorted by size: partners of i end where sizes pass the similarity bound
    last = np.searchsorted(n, n * 100 // SIMILARITY_PERCENT, side="right")
    for i in range(m - 1):
        hi = last[i]
        other = np.flatnonzero(label[i + 1:hi] != label[i]) + i + 1
        if not len(other):
            continue
        near = other[(x[other] == x[i]).sum(axis=1) >= LEAST_AGREEING]
        while len(near):
            j = near[0]
            out_a.append(nodes[i])
            out_b.append(nodes[j])
            label[label == label[j]] = label[i]
            near = near[label[near] != label[i]]


def block_links(sets: list[np.ndarray], percent: int = SIMILARITY_PERCENT) -> np.ndarray:
    """Component label (smallest position) of each set under all links between them."""
    m = len(sets)
    label = np.arange(m)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    for i in range(m):
        if (label == label[0]).all():
            break
        lo, hi = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
        n = hi - lo
        at = np.arange(n.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        shared = np.bincount(owner[at], minlength=m)
        union = size[i] + size - shared
        linked = np.flatnonzero(100 * shared >= percent * union)
        joined = np.unique(label[linked])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
    return label


def _confirm(rows: DataFrame, width: int) -> DataFrame:
    """Edges ``(a, b)`` from each member of a group ``g`` to the first of its confirmed part."""
    in_groups = rows.select("g", "node", "text").repartition("g").sortWithinPartitions("g", "node")

    def run(batches):
        hashes, group, nodes, sets = _WordHashes(), None, [], []

        def links():
            if len(nodes) < 2:
                return [], []
            label = block_links(sets)
            at = [i for i in range(len(nodes)) if label[i] != i]
            return [nodes[label[i]] for i in at], [nodes[i] for i in at]

        for b in batches:
            out = {"a": [], "b": []}
            texts = b.column(2).cast(pa.binary()).to_pylist()
            for g, node, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts):
                if g != group:
                    left, right = links()
                    out["a"] += left
                    out["b"] += right
                    group, nodes, sets = g, [], []
                nodes.append(node)
                sets.append(shingle_set(text, width, hashes))
            yield out
        left, right = links()
        yield {"a": left, "b": right}

    return map_arrow(in_groups, run, "a bigint, b bigint")


def _texts(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``(g, node, text)`` for ``(g, node)``."""
    groups, _ = bounded_broadcast(groups, MEMBER_ROW_BYTES)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), "text")
    return texts.join(groups, "node").select("g", "node", "text")


def confirmed_edges(docs: DataFrame, clusters: DataFrame, sizes: DataFrame, width: int = WIDTH,
                    block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Edges that connect each cluster's confirmed parts; ``sizes``: ``(node, n_shingles)``."""
    totals = (clusters.join(sizes, "node").groupBy("component")
              .agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_docs), F.ceil(F.sum("n_shingles") / block_shingles),
                              F.lit(1)).alias("blocks")))
    totals = materialize(totals, "dup-clusters")
    placed = clusters.join(totals, "component").select(
        "component", "blocks", "node", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
    first = totals.where("blocks > 1").select(
        "component", "blocks", F.col("component").alias("node"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    placed = materialize(placed.unionByName(first).distinct(), "dup-blocks")
    group = F.concat_ws(":", "component", "block").alias("g")
    edges = materialize(_confirm(_texts(docs, placed.select(group, "node")), width), "dup-links")
    if totals.where("blocks > 1").isEmpty():
        return edges
    # members outside the largest part of a cluster of several blocks, against all its blocks
    wide = placed.where("blocks > 1")
    parts = components(edges).withColumnRenamed("component", "part")
    wide = materialize(wide.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node")), "dup-parts")
    counted = wide.groupBy("component", "part").agg(F.count(F.lit(1)).alias("n"))
    largest = counted.groupBy("component").agg(F.max_by("part", F.struct("n", "part")).alias("largest"))
    rest = (wide.join(largest, "component").where(F.col("part") != F.col("largest"))
            .select("component", "blocks", "node").distinct())
    chunks = rest.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block_docs).alias("chunks"))
    rest = rest.join(chunks, "component").withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")))
    every = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    left = rest.select("component", "node", "chunk", F.explode(every).alias("block"))
    right = (wide.join(chunks, "component").select(
        "component", "node", "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk")))
    group = F.concat_ws(":", "component", "block", "chunk").alias("g")
    again = materialize(left.unionByName(right).select(group, "node").distinct(), "dup-rest")
    return edges.union(_confirm(_texts(docs, again), width))


def near_duplicates(docs: DataFrame, width: int = WIDTH, region_rows: int = REGION_ROWS,
                    block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``.

    Rows link if their shingle sets have at least 80 % of their union in
    common. A null or empty text has no shingles and links with nothing; a row
    without a doc_id has no component and is kept; rows that share a doc_id are
    one document with several texts. Empty table: no rows.
    """
    own = materialize(signatures(docs, width), "dup-signatures")
    named = own.where("digest is not null and doc_id is not null")
    reps = materialize(named.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "sig")).alias("r"))
                       .select("digest", F.col("r.doc_id").alias("node"), "r.n_shingles", "r.sig"), "dup-classes")
    clusters = components(forest_edges(reps.select("node", "n_shingles", "sig"), region_rows))
    sizes = reps.groupBy("node").agg(F.sum("n_shingles").alias("n_shingles"))
    found = components(confirmed_edges(docs, clusters, sizes, width, block_docs))
    classes = (reps.select("digest", "node").join(found, "node", "left")
               .select("digest", F.coalesce("component", "node").alias("component")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    rows = own.drop("sig").join(classes, "digest", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One text of each group of near-duplicates, with all its columns.

    Where a doc_id repeats with different texts, each text is judged by itself:
    the smallest doc_id of a group stays, and of its texts in the group one.
    Rows that repeat both doc_id and text go or stay together; rows without a
    doc_id stay.
    """
    text_hash = F.xxhash64("text")
    pairs = materialize(docs.where("doc_id is not null").select("doc_id", text_hash.alias("h")).distinct()
                        .orderBy("doc_id", "h").withColumn("n", F.monotonically_increasing_id()), "dup-texts")
    if pairs.groupBy("doc_id").count().where("count > 1").isEmpty():
        gone = near_duplicates(docs, width).where(~F.col("kept")).select("doc_id").distinct()
        return docs.alias("l").join(gone.alias("r"), F.col("l.doc_id") == F.col("r.doc_id"), "left_anti")
    # numbers in the order of doc_id stand for the texts
    texts = (docs.select("doc_id", "text", text_hash.alias("h")).join(pairs, ["doc_id", "h"])
             .select(F.col("n").alias("doc_id"), "text"))
    gone = near_duplicates(materialize(texts, "dup-numbered"), width).where(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias("n")).distinct().join(pairs, "n")
    left, right = docs.alias("l"), gone.alias("r")
    on = (F.col("l.doc_id") == F.col("r.doc_id")) & (F.xxhash64("l.text") == F.col("r.h"))
    return left.join(right, on, "left_anti")
