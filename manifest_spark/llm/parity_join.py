"""N-gram Jaccard join by parity sketches: XOR-hashed bit sketches, a pigeonhole join per band of sizes, exact verification.

A document's set holds its distinct ``k``-word shingles.  Each shingle flips
one of 2^24 bits, so that shingles of both documents cancel out and the
Hamming distance of two sketches is at most the size of the sets' symmetric
difference.  With 100 * intersection >= 85 * union and sizes a and b that
difference is at most 3 (a + b) / 37.  Sketches of a band of sizes are cut into
more chunks than this bound, so that two linked documents share a whole chunk;
only documents that share one are compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, bytes_of, chunks, written
from .simhash import groups

SHINGLE, LEAST_PERCENT = 4, 85
#: log2 of the bits of a sketch; a sketch is kept as the sorted places of its set bits.
SKETCH_BITS = 24
#: How much larger than its least size a band's sizes may be.
BAND = 1.5
#: Documents that share a chunk are all compared with each other up to this number; more are compared with one of them first.
FEW = 8
#: Bytes of a word that is kept as it is.
LONG_WORD = 64
#: Names of documents that are sent to all tasks to fetch their texts (32 bytes each).
FETCH = 500_000
#: Documents in a block of the comparison of a chunk shared by many documents of several components.
BLOCK = 4096

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values spread evenly (two rounds of multiplication and shift)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Shingles:
    """Sorted distinct 64-bit hashes of a text's ``k``-word shingles, words hashed once in a while."""

    def __init__(self, k: int = SHINGLE):
        self.k, self.memo = k, Memo()
        self.odd = np.resize(_ODD, k) + np.arange(0, 2 * k, 2, dtype=np.uint64)

    def of(self, data: bytes) -> np.ndarray:
        words = data.translate(_FOLD).split()  # blank, \t \n \v \f \r: just the six signs that part words
        if not words:
            return np.empty(0, dtype=np.uint64)
        if max(map(len, words)) > LONG_WORD:  # kept by a digest, so that the memo's size is bounded in bytes, too
            words = [w if len(w) <= LONG_WORD else b"\0" + xxhash.xxh3_128_digest(w) for w in words]
        for w in self.memo.missing(set(words)):
            self.memo.young[w] = xxhash.xxh64_intdigest(w)
        young = self.memo.young
        h = np.array([young[w] for w in words], dtype=np.uint64)
        take = min(self.k, len(words))
        line = np.full(len(words) - take + 1, take, dtype=np.uint64)
        for i in range(take):
            line += h[i:len(h) - take + 1 + i] * self.odd[i]
        return np.unique(mixed(line))


# ---- sketches and chunks -----------------------------------------------------------

def places(tokens: np.ndarray) -> np.ndarray:
    """The sketch: sorted places of the bits that an odd number of tokens flip (``tokens`` are sorted)."""
    at = (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
    if len(at) < 2 or (at[1:] != at[:-1]).all():
        return at
    at, n = np.unique(at, return_counts=True)
    return at[n % 2 == 1]


def distance_bound(a: int, b: int, percent: int = LEAST_PERCENT) -> int:
    """The most by which linked sets of these sizes differ: union <= 100 (a + b) / (100 + percent)."""
    return (a + b) * (100 - percent) // (100 + percent)


class Bands:
    """Bands of sizes; for each the number of chunks of its sketches, and how many of them may be empty.

    A band's chunks are so many that two linked documents, the larger one in
    the band, share ``shared`` chunks more than ``empty``.  Documents with at
    most ``empty`` empty chunks leave these out: of the shared ones at least
    ``shared`` are not empty then.  Documents with more (few) keep them, to
    meet each other.  So documents with fewer common keys need no comparison.
    """

    def __init__(self, percent: int = LEAST_PERCENT, ratio: float = BAND):
        self.percent, self.ratio, self.edges, self.cuts = percent, ratio, [1], []

    def band(self, n: int) -> int:
        while self.edges[-1] <= n:
            low = self.edges[-1]
            # the band above must take all partners of a size, so that two bands hold them
            high = max(low + 1, int(low * max(self.ratio, 100 / self.percent)))
            differ = distance_bound(high - 1, high - 1, self.percent)
            shared, empty = 2 + differ // 10, 1
            least = max(1, -(-low * self.percent // 100))
            for _ in range(4):
                m = differ + shared + empty
                empty = min(differ + 1, 1 + math.ceil(2 * m * math.exp(-least / m)))
            self.cuts.append((differ, differ + shared + empty, empty, shared))
            self.edges.append(high)
        return int(np.searchsorted(self.edges, n, "right")) - 1

    def of(self, n: int) -> list[int]:
        """The bands in which a document of size ``n`` meets larger and smaller ones."""
        own = self.band(n)
        above = self.band(n * 100 // self.percent)
        return [k for k in range(own, above + 1) if self.cuts[k][0]]  # sets that must be equal need no chunks

    def shared(self, a: int, b: int) -> int:
        """Keys that linked documents of these sizes have in common."""
        return self.cuts[self.band(max(a, b))][3]

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """Hashes of (band, chunk, its set bits) for all chunks of a document that are not left out."""
        out, at = [], places(tokens)
        spread = mixed(at.astype(np.uint64) + _ODD[0])
        for band in self.of(len(tokens)):
            _, m, empty, _ = self.cuts[band]
            chunk = at * m >> SKETCH_BITS
            first = np.concatenate([[0], np.flatnonzero(chunk[1:] != chunk[:-1]) + 1]) if len(at) else np.empty(0, np.int64)
            mine = chunk[first] if len(at) else np.empty(0, np.int64)
            name = (np.uint64(band) << np.uint64(40)) + mine.astype(np.uint64)
            out.append(mixed(np.add.reduceat(spread, first) + mixed(name)) if len(at) else name)
            if m - len(mine) > empty:
                gone = np.setdiff1d(np.arange(m), mine, assume_unique=True).astype(np.uint64)
                out.append(mixed(mixed((np.uint64(band) << np.uint64(40)) + gone) ^ _ODD[1]))
        return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def linked(a: np.ndarray, b: np.ndarray, percent: int = LEAST_PERCENT) -> bool:
    """Whether two sets of hashes link; the sketches' distance refutes most that do not."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    if len(np.setxor1d(places(a), places(b), assume_unique=True)) > distance_bound(len(a), len(b), percent):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


# ---- the join ----------------------------------------------------------------------

def dense(tokens: np.ndarray) -> bytes:
    """A sketch folded to two to four bits a token (a power of two of 64-bit words): still one flip a token."""
    bits = 64 << min(SKETCH_BITS - 6, max(0, math.ceil(math.log2(len(tokens) / 32))))
    return np.packbits((np.bincount(places(tokens) % bits, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes], words: int) -> np.ndarray:
    """Sketches of one width folded further to ``words`` words each: the distance stays a lower bound."""
    return np.bitwise_xor.reduce(np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1, words), axis=1)


def _sets(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """A row per document: (row, doc_id, fetch, n, s1, s2, keys, sketch); s1 and s2 are 128 bits that name its set.

    ``keys`` and ``sketch`` are null where the same task has met the set
    before, so that copies do not meet in the join.
    """
    def run(batches):
        shingles, bands, seen = Shingles(k), Bands(percent), Memo(500_000)
        for b in chunks(batches):
            n, s1, s2, keys, sketch = [], [], [], [], []
            for t in bytes_of(b):
                tokens = shingles.of(t)
                name = xxhash.xxh3_128_digest(tokens.tobytes())
                n.append(len(tokens))
                s1.append(int.from_bytes(name[:8], "little", signed=True))
                s2.append(int.from_bytes(name[8:], "little", signed=True))
                new = len(tokens) and seen.missing([name])
                if new:
                    seen.young[name] = True
                keys.append(bands.keys(tokens).view(np.int64) if new else None)
                sketch.append(dense(tokens) if new else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("fetch"), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                names=["doc_id", "fetch", "n", "s1", "s2", "keys", "sketch"])

    out = _read(docs).mapInArrow(run, "doc_id long, fetch long, n long, s1 long, s2 long, keys array<long>, sketch binary")
    return written(out.withColumn("row", F.monotonically_increasing_id()), "sets")


def _read(docs: DataFrame) -> DataFrame:
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return src.select("doc_id", F.xxhash64("doc_id", "text").alias("fetch"), "text")


def runs(few: int):
    """Candidates from (key, row) sorted by both: pairs of few rows; of more, pairs with the first and the rows themselves.

    A run is never held: of a long one only its first row stays in memory.
    """
    def found(key, row, first):
        """Candidates of whole runs, as lists of (key or None, a, b); ``first`` is the first row of a run that began before."""
        start = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        size, out = np.diff(np.append(start, len(key))), []
        if first is not None:
            out += many(key[:size[0]], row[:size[0]], np.full(size[0], first))
            start, size = start[1:], size[1:]
        for s in range(2, few + 1):
            at = start[size == s]
            if len(at):
                out += [(None, row[at + i], row[at + j]) for i in range(s) for j in range(i)]
        at, n = start[size > few], size[size > few]
        if len(at):
            rows = np.concatenate([np.arange(x, x + y) for x, y in zip(at, n)])
            out += many(key[rows], row[rows], np.repeat(row[at], n))
        return out

    def many(key, row, first):
        other = row != first
        return [(key, row, row), (None, row[other], first[other])]

    def batch(parts):
        keys = [pa.nulls(len(a), pa.int64()) if k is None else pa.array(k) for k, a, _ in parts]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(keys), pa.array(np.concatenate([a for _, a, _ in parts])),
                                           pa.array(np.concatenate([b for *_, b in parts]))], names=["key", "a", "b"])

    def run(batches):
        key, row, first, held = np.empty(0, np.int64), np.empty(0, np.int64), None, None
        for b in batches:
            key = np.concatenate([key, b.column("key").to_numpy(zero_copy_only=False)])
            row = np.concatenate([row, b.column("row").to_numpy(zero_copy_only=False)])
            if not len(key):
                continue
            out = []
            if first is not None and key[0] != held:
                first = None
            last = int(np.searchsorted(key, key[-1], "left"))  # the last run may go on
            if last:
                out += found(key[:last], row[:last], first)
                key, row, first = key[last:], row[last:], None
            if len(key) > few or first is not None:
                first, held = row[0] if first is None else first, key[0]
                out += many(key, row, np.full(len(row), first))
                key, row = key[:0], row[:0]
            if out:
                yield batch(out)
        if len(key):
            out = found(key, row, first if first is not None and key[0] == held else None)
            if out:
                yield batch(out)

    return run


def _candidates(sets: DataFrame, few: int) -> DataFrame:
    """(key, a, b): pairs of rows to compare (null key), and rows (a = b) under a key that many rows share."""
    keys = sets.where("keys is not null").select("row", F.explode("keys").alias("key"))
    return written(keys.repartition("key").sortWithinPartitions("key", "row")
                   .mapInArrow(runs(few), "key long, a long, b long"), "candidates")


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, common) with enough common keys whose sketches are as near as linked sets' are."""
    def run(batches):
        bands = Bands(percent)
        for b in batches:
            keep = []
            for n, m, common, x, y in zip(*(b.column(c).to_pylist() for c in ("na", "nb", "common", "sa", "sb"))):
                if 100 * min(n, m) < percent * max(n, m) or common < bands.shared(n, m):
                    keep.append(False)
                    continue
                words = min(len(x), len(y)) // 8
                keep.append(int(np.bitwise_count(folded([x], words) ^ folded([y], words)).sum()) <= distance_bound(n, m, percent))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("row").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    y = sets.select(F.col("row").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return written(pairs.where("common > 1").join(x, "a").join(y, "b").mapInArrow(run, "a long, b long"), "near-pairs")


def _tokens(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, tokens) of the nodes of ``pairs``, made from the texts again."""
    def run(batches):
        shingles = Shingles(k)
        for b in chunks(batches):
            tokens, fits = [], []
            for t, s1, s2 in zip(bytes_of(b), b.column("s1").to_pylist(), b.column("s2").to_pylist()):
                x = shingles.of(t)
                name = xxhash.xxh3_128_digest(x.tobytes())
                fits.append(name == s1.to_bytes(8, "little", signed=True) + s2.to_bytes(8, "little", signed=True))
                tokens.append(x.tobytes())
            out = pa.RecordBatch.from_arrays([b.column("node"), pa.array(tokens, pa.binary())], names=["node", "tokens"])
            yield out.filter(pa.array(fits, pa.bool_()))

    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    needed = written(nodes.join(wanted, "node").select("node", "fetch", "s1", "s2"), "needed")
    if needed.count() <= FETCH:  # four numbers each; more are fetched by a shuffled join
        needed = F.broadcast(needed)
    rows = _read(docs).join(needed, "fetch").select("node", "s1", "s2", "text")
    # one row a node, and written, so that a join on a node that many others meet can be split
    return written(rows.mapInArrow(run, "node long, tokens binary").dropDuplicates(["node"]), "tokens")


def _verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    def run(batches):
        for b in batches:
            # views of the buffers: the tokens of a batch are not copied
            keep = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(b.column("x"), b.column("y"))]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = tokens.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = tokens.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return written(pairs.select("a", "b").join(x, "a").join(y, "b").mapInArrow(run, "a long, b long"), "verified")


def _apart(pairs: DataFrame, root: DataFrame) -> DataFrame:
    """Pairs whose nodes are not in one component yet."""
    ra, rb = root.select(F.col("node").alias("a"), F.col("root").alias("ra")), root.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    return (pairs.join(ra, "a", "left").join(rb, "b", "left")
            .where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"))


def _crowds(many: DataFrame, sets: DataFrame, root: DataFrame, percent: int, block: int) -> DataFrame | None:
    """Pairs (a, b) across components among rows ``many(key, node)`` of keys that many rows share, by sketches.

    Most such keys belong to one group of near copies, which is one component
    by now, and cost nothing more.  The rest is compared in pairs of blocks;
    rows of one component are not compared, and only pairs within the bound
    leave a task.
    """
    members = many.join(root, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    open_ = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"))
    open_ = written(open_.where("low <> high").select("key", "size"), "open-keys")
    if open_.isEmpty():
        return None
    rows = members.join(open_, "key").withColumn("blocks", F.ceil(F.col("size") / F.lit(block)).cast("int"))
    # a row's block by its hash: blocks are about even and no numbering of a large key is needed
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "node", "root")

    def compare(part: pa.Table) -> pa.Table:
        node, root_, mine, n = (part.column(c).to_numpy() for c in ("node", "root", "mine", "n"))
        raw = part.column("sketch").to_pylist()
        width = np.array([len(x) // 8 for x in raw])
        left = np.flatnonzero(mine == part.column("low")[0].as_py())
        right = np.flatnonzero(mine == part.column("high")[0].as_py())
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for w in np.unique(width[left]):
            i = left[width[left] == w]
            for v in np.unique(width[right]):
                j, c = right[width[right] == v], min(w, v)
                x, y = folded([raw[t] for t in i], c), folded([raw[t] for t in j], c)
                step = max(1, (1 << 20) // (len(j) * c))
                for at in range(0, len(i), step):
                    s = i[at:at + step]
                    near = np.bitwise_count(x[at:at + step, None, :] ^ y[None, :, :]).sum(2, dtype=np.int64)
                    p, q = np.nonzero((near <= distance_bound(n[s][:, None], n[j][None, :], percent)) & (root_[s][:, None] != root_[j][None, :]))
                    a.append(np.maximum(node[s[p]], node[j[q]]))
                    b.append(np.minimum(node[s[p]], node[j[q]]))
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    blocks = rows.join(sets.select(F.col("row").alias("node"), "n", "sketch"), "node").groupBy("key", "low", "high")
    return written(blocks.applyInArrow(compare, "a long, b long").distinct(), "crowd-pairs")


def jaccard_groups(docs: DataFrame, k: int = SHINGLE, percent: int = LEAST_PERCENT, few: int = FEW, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Two documents link when 100 * intersection >= ``percent`` * union of their
    sets of ``k``-word shingles; ``component_id`` is the smallest id reachable,
    the row's own included.  With fewer than ``k`` words the whole sequence is
    one shingle; null, empty and blank texts have no set and link with nothing:
    each such row is a component of its own.  Rows with equal sets are one
    node.  Repeated rows give repeated rows.  A null id is no name: such rows
    get the smallest id of their component, null if it has none.  Other columns
    are not read.  Shingles count as equal when their 64-bit hashes are.
    """
    sets = _sets(docs, k, percent)
    full = sets.where("n > 0")
    first = F.when(F.col("keys").isNotNull(), F.col("row"))
    nodes = written(full.groupBy("s1", "s2").agg(F.min(first).alias("node"), F.min("doc_id").alias("least"), F.min_by("fetch", first).alias("fetch")),
                    "set-nodes")
    ids = written(sets.where("keys is not null").select("row", "s1", "s2").join(nodes.select("s1", "s2", "node"), ["s1", "s2"])
                  .select("row", "node"), "set-ids")
    ia, ib = ids.select(F.col("row").alias("a"), F.col("node").alias("na")), ids.select(F.col("row").alias("b"), F.col("node").alias("nb"))
    cands = _candidates(sets, few)
    met = written(cands.where("key is null").groupBy("a", "b").agg(F.count(F.lit(1)).alias("common")).where("common > 1")
                  .join(ia, "a").join(ib, "b").where("na <> nb")
                  .groupBy(F.greatest("na", "nb").alias("a"), F.least("na", "nb").alias("b")).agg(F.max("common").alias("common")), "pairs")
    pairs = _near(met, sets, percent)

    # the smallest partner of each node first: what is in one component by that need not be verified
    tokens = _tokens(docs, pairs, nodes, k)
    edges = _verified(pairs.groupBy("a").agg(F.min("b").alias("b")), tokens, percent)
    edges = edges.unionByName(_verified(_apart(pairs, groups(edges)), tokens, percent))
    root = groups(edges)
    # pairs that met under a crowded key only
    many = cands.where("key is not null").select("key", "a").join(ia, "a").select("key", F.col("na").alias("node")).distinct()
    crowd = _crowds(many, sets, root, percent, block)
    if crowd is not None:
        edges = edges.unionByName(_verified(crowd, _tokens(docs, crowd, nodes, k), percent))
        root = groups(edges)

    member = nodes.join(root, "node", "left").select("s1", "s2", "least", F.coalesce("root", "node").alias("root"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(least, "root").select("s1", "s2", "component_id")
    out = sets.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
