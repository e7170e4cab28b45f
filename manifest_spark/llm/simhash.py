"""SimHash near-dedup: fingerprints, a vantage-point tree over Hamming distance, exact pairs, connected groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_of, chunks, thinned, written

SHINGLE, MAX_BITS, SEED = 3, 2, 42
#: Most fingerprints that the driver sees, to choose vantage points and radii from.
TREE_SAMPLE = 65_536
#: Fingerprints that a shard should hold, and the most that one task compares by the tree.
SHARD, MOST = 4096, 65_536
LEAF = 512

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ONES = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(data: bytes, k: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text: bits set in over half of its shingles' XXH64 values (no word: zero)."""
    words = data.translate(_FOLD).split()  # blank, \t \n \v \f \r: just the six signs that part words
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = ([0] + (ends[:-1] + 1).tolist())[:n]
    last = ends[min(k, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], SEED) for a, b in zip(first, last)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(_ONES[2 * ones > n].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row's whole text; fp holds the 64 bits as a signed long.  A null text is an empty one."""
    def run(batches):
        for b in chunks(batches):
            fp = np.array([fingerprint(t, k) for t in bytes_of(b)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, fp long")


# ---- the tree ----------------------------------------------------------------------

def grow(points: np.ndarray, weight: float, bits: int, target: int, least: int = 24):
    """A vantage-point tree over sampled fingerprints; each sampled point stands for ``weight`` ones.

    Inner nodes are (vantage point, radius, inside, outside); a leaf is its
    number of sampled points.  A node is a leaf when it should hold ``target``
    fingerprints at most, when too few sampled points are left to split it, or
    when no radius parts it.
    """
    if len(points) * weight <= target or len(points) < least:
        return len(points)
    vantage = points[len(points) // 2]
    d = np.bitwise_count(points ^ vantage).astype(np.int64)
    held = np.cumsum(np.bincount(d, minlength=65))
    # rows sent to the two sides by each radius: up to radius + bits inside, beyond the radius outside
    inside = held[np.minimum(np.arange(65) + bits, 64)]
    outside = len(points) - held
    radius = int(np.argmin(np.maximum(inside, outside) + 0.25 * (inside + outside)))
    if max(inside[radius], outside[radius]) > 0.9 * len(points):
        return len(points)
    return (vantage, radius, grow(points[d <= radius + bits], weight, bits, target, least),
            grow(points[d > radius], weight, bits, target, least))


def numbered(tree, count=None):
    """The tree with its leaves numbered from 0, and their number."""
    count = [0] if count is None else count
    if not isinstance(tree, tuple):
        count[0] += 1
        return count[0] - 1
    v, r, a, b = tree
    return (v, r, numbered(a, count), numbered(b, count))


def route(tree, fp: np.ndarray, bits: int) -> list[tuple[int, np.ndarray]]:
    """(leaf, positions) for fingerprints: outside points within ``bits`` of a boundary also visit the inside.

    For a pair x inside, y outside with d(x, y) <= bits the triangle bound
    gives d(v, y) <= d(v, x) + bits <= radius + bits, so y visits x's side; by
    induction each linked pair meets in a leaf.
    """
    out, todo = [], [(tree, np.arange(len(fp)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if not isinstance(node, tuple):
            out.append((node, rows))
            continue
        v, radius, a, b = node
        d = np.bitwise_count(fp[rows] ^ v)
        todo += [(a, rows[d <= radius + bits]), (b, rows[d > radius])]
    return out


# ---- links inside a shard ----------------------------------------------------------

class Forest:
    """Disjoint sets over positions, the smallest position as root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, a, b) -> None:
        for i, j in zip(a.tolist(), b.tolist()):
            i, j = self.root(i), self.root(j)
            if i != j:
                self.up[max(i, j)] = min(i, j)


def link(fp: np.ndarray, rows: np.ndarray, bits: int, forest: Forest) -> None:
    """Joins all of ``rows`` that are within ``bits`` of each other: vantage points down to small leaves, then all pairs.

    Where no radius parts the points (a dense ball), points that share a
    neighbour at half the distance are joined instead, which is as exact for
    two bits and takes 65 values a point.
    """
    todo = [rows]
    while todo:
        rows = todo.pop()
        x = fp[rows]
        if len(rows) <= LEAF:
            for at in range(0, len(rows), 64):
                near = np.bitwise_count(x[at:at + 64, None] ^ x[None, at:]) <= bits
                i, j = np.nonzero(near)
                far = j > i
                forest.join(rows[at + i[far]], rows[at + j[far]])
            continue
        v = x[len(x) // 2]
        d = np.bitwise_count(x ^ v).astype(np.int64)
        held = np.cumsum(np.bincount(d, minlength=65))
        inside, outside = held[np.minimum(np.arange(65) + bits, 64)], len(x) - held
        radius = int(np.argmin(np.maximum(inside, outside) + 0.25 * (inside + outside)))
        if max(inside[radius], outside[radius]) <= 0.85 * len(x):
            todo += [rows[d <= radius + bits], rows[d > radius]]
        elif bits == 2:
            ball = np.concatenate([x, (x[:, None] ^ _ONES[None, :]).ravel()])
            who = np.concatenate([rows, np.repeat(rows, 64)])
            order = np.argsort(ball, kind="stable")
            same = ball[order][1:] == ball[order][:-1]
            forest.join(who[order][:-1][same], who[order][1:][same])
        else:
            for at in range(0, len(rows), 256):
                i, j = np.nonzero(np.bitwise_count(x[at:at + 256, None] ^ x[None, at:]) <= bits)
                far = j > i
                forest.join(rows[at + i[far]], rows[at + j[far]])


def shard_links(bits: int):
    def run(shard: pa.Table) -> pa.Table:
        signed = np.unique(shard.column("fp").to_numpy())
        forest = Forest(len(signed))
        link(signed.view(np.uint64), np.arange(len(signed)), bits, forest)
        roots = np.array([forest.root(i) for i in range(len(signed))], dtype=np.int64)
        far = np.nonzero(roots != np.arange(len(signed)))[0]
        return pa.table({"a": signed[far], "b": signed[roots[far]]})

    return run


def links(nodes: DataFrame, bits: int = MAX_BITS, shard: int = SHARD, most: int = MOST) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``nodes(fp)`` that connect all pairs within ``bits``.

    A vantage-point tree over a bounded sample cuts the fingerprints into
    shards; boundary points visit both sides.  Each shard's task joins its
    pairs and returns a spanning forest, not the pairs.  A shard of over
    ``most`` fingerprints is not given to one task: its points meet at the 65
    values at most one bit away, which finds the same pairs for two bits
    exactly; for other distances such a shard is refused with an error.
    """
    spark = nodes.sparkSession
    n = nodes.count()
    sample = thinned(nodes.select("fp"), TREE_SAMPLE, "fp").collect()
    points = np.array([r["fp"] for r in sample], dtype=np.int64).view(np.uint64)
    tree = numbered(grow(points, n / max(1, len(points)), bits, shard))
    shipped = spark.sparkContext.broadcast(tree)  # fewer nodes than sampled points

    def deal(batches):
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            for leaf, rows in route(shipped.value, fp.view(np.uint64), bits):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), leaf, np.int64)), pa.array(fp[rows])],
                                                 names=["shard", "fp"])

    dealt = written(nodes.select("fp").mapInArrow(deal, "shard long, fp long"), "simhash-shards")
    # one row a shard, and shards are fewer than sampled points
    large = [r["shard"] for r in dealt.groupBy("shard").count().where(F.col("count") > most).collect()]
    if large and bits != 2:
        raise ValueError("shards beyond the most that a task compares are only cut further for two bits")
    small = dealt.where(~F.col("shard").isin(large)) if large else dealt
    out = small.groupBy("shard").applyInArrow(shard_links(bits), "a long, b long")
    if large:
        hot = dealt.where(F.col("shard").isin(large)).select("fp").distinct()
        flips = F.array(F.lit(0).cast("long"), *[F.lit(int(np.int64(np.uint64(1 << i).view(np.int64)))) for i in range(64)])
        ball = hot.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z"))
        out = out.unionByName(ball.groupBy("z").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("each"))  # 65 at most
                              .where(F.size("each") > 1)
                              .select(F.explode("each").alias("a"), "b").where("a <> b").distinct())
    return out


def groups(edges: DataFrame) -> DataFrame:
    """Connected groups of links (a, b): (node, root), the smallest node as root; single nodes have no row.

    Rounds of large-star and small-star contraction until each group is a
    star, each written to the shared folder.  Minima are pre-aggregated before
    they move, and a hub's links meet its minimum in a join that adaptive
    execution can split.
    """
    cur = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not stars(cur):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = large.join(down, "a").select(F.explode(ends).alias("e")).select("e.*")
        cur = written(small.where("a <> b").distinct(), "links")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))


def stars(edges: DataFrame) -> bool:
    """Whether each node has one root and no root has a root of its own."""
    twice = edges.groupBy("a").count().where("count > 1").limit(1).count()
    chained = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1).count()
    return not twice and not chained


def near_copies(docs: DataFrame, k: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row: ``component_id`` is the smallest id of the row's connected group.

    Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows give repeated rows; a null id gets its group's smallest
    id, which is null only if the whole group has none.  Other columns are
    not read.  Exact copies meet in one fingerprint before anything is
    compared, so groups of copies cost one node each.
    """
    return _in_groups(docs, k, bits).select("doc_id", "fp", "component_id")


def _in_groups(docs: DataFrame, k: int, bits: int) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row; ``root`` tells groups apart, also those with one smallest id."""
    fps = written(fingerprints(docs, k), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    root = groups(links(nodes, bits))
    member = nodes.join(root, nodes["fp"] == root["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(least, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def _with_fingerprint(docs: DataFrame, k: int, name: str) -> DataFrame:
    """``docs`` with all their columns and the fingerprint."""
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, k) for t in bytes_of(pa.RecordBatch.from_arrays([b.column(at)], names=["text"]))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp.view(np.int64))], names=[*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def representatives(docs: DataFrame, k: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row left of each group of near copies: the one with the smallest id.

    Of rows that repeat that id in one group the one with the smallest text
    stays; where an id stands on texts of several groups, each row counts in
    its own group only.  Rows with a null id have no name to be told by and
    stay.  All columns are kept.
    """
    found = written(_in_groups(docs, k, bits), "near-copies")
    first = F.col("doc_id") == F.col("component_id")
    # ids of which rows go: all of them (first = 0), or some, which their fingerprints tell
    lost = written(found.where("doc_id is not null").groupBy("doc_id")
                   .agg(F.count(F.when(first, 1)).alias("first"), F.count(F.lit(1)).alias("n"))
                   .where("first <> 1 or n > 1").select("doc_id", "first"), "near-copy-ids")
    rest = docs.join(lost.select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    several = lost.where("first > 0").select("doc_id")
    if not several.limit(1).count():
        return rest
    fp, root, rank = "__fp_in_copies", "__root_in_copies", "__rank_in_copies"
    rows = _with_fingerprint(docs.join(several, "doc_id", "left_semi").select(docs.columns), k, fp)
    kept = found.where(first).join(several, "doc_id", "left_semi").select("doc_id", F.col("fp").alias(fp), F.col("root").alias(root)).distinct()
    order = Window.partitionBy("doc_id", root).orderBy("text")
    once = rows.join(kept, ["doc_id", fp]).withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    return rest.unionByName(once.select(docs.columns))
