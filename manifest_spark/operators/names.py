"""Names as a table: all places where one of thousands of site or city names stands in a text.

Short lists travel to the tasks as one Aho-Corasick automaton, which reads each
text once however many names there are.  Lists beyond a checked size are joined
instead: a name is looked for by the hash of its last signs, and only grams of
the texts that pass a filter over these hashes become rows of the join.
Both ways find exactly what a substring search for each name would find.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dialect import SparkX
from ..plans.rules import LOCAL, RuleSet

#: Bytes and number of the names that go into an automaton on every worker (about 100 bytes of it a byte).
MOST_BYTES, MOST_NAMES = 1 << 20, 100_000
#: log2 of the most bits of the filter over the hashes of a longer list.
FILTER_BITS = 27
#: Where the three stretches of FILTER_BITS bits of a gram's hash begin.
PLACES = (0, 18, 37)
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


def _slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20):
    """(row numbers, texts) of a batch, a few megabytes of text at a time."""
    at, held, size = [], [], 0
    for i, t in enumerate(batch.column(column)):
        t = t.as_py()
        if t is not None:
            at.append(i)
            held.append(t)
            size += len(t)
        if size >= most:
            yield at, held
            at, held, size = [], [], 0
    if at:
        yield at, held


def _found_schema(docs: DataFrame, key: str, *more: T.StructField) -> T.StructType:
    return T.StructType([T.StructField(key, docs.schema[key].dataType), *more])


# ---- by an automaton ---------------------------------------------------------------

@lru_cache(maxsize=2)
def _automaton(names: tuple):
    import ahocorasick
    a = ahocorasick.Automaton()
    for i, n in enumerate(names):
        a.add_word(n, (i, len(n)))
    a.make_automaton()
    return a


def by_automaton(docs: DataFrame, names: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, name, place): the first place, counted from 1, of each of ``names`` in each row's text; one pass over each text."""
    shipped = docs.sparkSession.sparkContext.broadcast(tuple(names))

    def run(batches):
        words = shipped.value
        automaton = _automaton(words) if words else None
        for b in batches:
            for at, texts in _slices(b, 1) if words else ():
                row, name, place = [], [], []
                for i, t in zip(at, texts):
                    first = {}
                    for end, (w, size) in automaton.iter(t):
                        if w not in first:
                            first[w] = end - size + 2
                    row += [i] * len(first)
                    name += [words[w] for w in first]
                    place += first.values()
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(name, pa.string()),
                                                  pa.array(place, pa.int32())], names=[key, "name", "place"])

    return docs.select(key, text).mapInArrow(run, _found_schema(docs, key, T.StructField("name", T.StringType()), T.StructField("place", T.IntegerType())))


# ---- by a join of hashes -----------------------------------------------------------

def grams(signs: np.ndarray, m: int) -> np.ndarray:
    """Hashes of all runs of ``m`` signs: sums of signs times powers of an odd base, taken from running sums modulo 2^64."""
    n = len(signs) - m + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    down = np.full(len(signs), _UNBASE, dtype=np.uint64)
    down[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(signs.astype(np.uint64) * np.cumprod(down))])
    up = np.full(n, _BASE, dtype=np.uint64)
    up[0] = 1
    h = (sums[m:] - sums[:-m]) * np.cumprod(up)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _signs(t: str) -> np.ndarray:
    return np.frombuffer(t.encode("utf-32-le"), dtype="<u4")


def _class(n: int) -> int:
    """The largest power of two that is at most a name's length: its gram's length."""
    return 1 << (n.bit_length() - 1)


def _keyed(names: DataFrame) -> DataFrame:
    """(name, m, gram) of distinct names: the hash of the name's last m signs."""
    def run(batches):
        for b in batches:
            name = b.column(0).to_pylist()
            m = [_class(len(n)) for n in name]
            h = np.array([grams(_signs(n[-k:]), k)[0] for n, k in zip(name, m)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m, pa.int32()), pa.array(h.view(np.int64))], names=["name", "m", "gram"])

    return names.mapInArrow(run, "name string, m int, gram long")


def places(grams_, bits: int):
    """The three places of a gram in a filter of 2^``bits`` bits, from three stretches of its hash."""
    if isinstance(grams_, np.ndarray):
        return [(grams_ << np.uint64(at)) >> np.uint64(64 - bits) for at in PLACES]
    return [F.shiftrightunsigned(F.shiftleft(grams_, at), 64 - bits) for at in PLACES]


def candidates(docs: DataFrame, keyed: DataFrame, key: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """(key, m, gram, part, end): the grams of each text that pass the filter over the names' grams, with the signs around them."""
    shape = keyed.groupBy("m").count().collect()  # one row a power of two
    n = sum(r["count"] for r in shape)
    bits = min(filter_bits, FILTER_BITS, max(10, (16 * n).bit_length()))
    # at most 2^(bits - 6) numbers of 64 bits
    words = keyed.select(F.explode(F.array(*places(F.col("gram"), bits))).alias("place"))
    words = words.select(F.shiftright("place", 6).alias("word"), F.pmod("place", F.lit(64)).alias("bit"))
    words = words.groupBy("word").agg(F.collect_set("bit").alias("bits")).toArrow()  # 64 at most each
    table = np.zeros(1 << bits - 6, dtype=np.uint64)
    for w, each in zip(words.column("word").to_pylist(), words.column("bits").to_pylist()):
        table[w] = sum(1 << int(x) for x in each)
    shipped = docs.sparkSession.sparkContext.broadcast((sorted(r["m"] for r in shape), bits, table))

    def passing(h, bits, table):
        """Positions of the hashes all of whose places are set."""
        left = np.arange(len(h))
        for slot in places(h, bits):
            slot = slot[left]
            left = left[(table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)]
        return left

    def run(batches):
        lengths, bits, table = shipped.value
        for b in batches:
            for at, texts in _slices(b, 1, 1 << 19):
                out = {"row": [], "m": [], "gram": [], "part": [], "end": []}
                # all texts of a slice in one array; grams over a border are left out by their ends
                signs = [_signs(t) for t in texts]
                ends = np.cumsum([len(x) for x in signs])
                joined = np.concatenate(signs)
                for m in lengths:
                    h = grams(joined, m)
                    hits = passing(h, bits, table)
                    doc = np.searchsorted(ends, hits, "right")
                    inside = hits + m <= ends[doc]
                    hits, doc = hits[inside], doc[inside]
                    before, seen = -1, set()
                    for d, p, g in zip(doc.tolist(), (hits - (ends[doc] - np.array([len(x) for x in signs])[doc])).tolist(), h[hits].view(np.int64).tolist()):
                        if d != before:
                            before, seen = d, set()
                        part = texts[d][max(0, p - m + 1):p + m]  # a name of this class is shorter than 2 m
                        if part in seen:
                            continue
                        seen.add(part)
                        for c, v in zip(out.values(), (at[d], m, g, part, p + m)):
                            c.append(v)
                row = pa.array(out["row"], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).take(row), pa.array(out["m"], pa.int32()), pa.array(out["gram"], pa.int64()),
                                                  pa.array(out["part"], pa.string()), pa.array(out["end"], pa.int32())],
                                                 names=[key, "m", "gram", "part", "end"])

    fields = [T.StructField("m", T.IntegerType()), T.StructField("gram", T.LongType()), T.StructField("part", T.StringType()), T.StructField("end", T.IntegerType())]
    return docs.select(key, text).mapInArrow(run, _found_schema(docs, key, *fields))


def by_join(docs: DataFrame, names: DataFrame, key: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """As ``by_automaton`` for ``names(name)`` of any number: grams of the texts meet the names' grams in a hash join.

    A filter of at most 2^``filter_bits`` bits, made by an aggregate, keeps most
    grams without a name from the join; false hits end when the name is
    compared with the signs before the gram.
    """
    keyed = _keyed(names.select("name").where("name <> ''").distinct())
    met = candidates(docs, keyed, key, text, filter_bits).join(keyed, ["m", "gram"])
    met = met.where(F.endswith("part", F.col("name")))
    return met.groupBy(key, "name").agg(F.min(F.col("end") - F.length("name") + 1).cast("int").alias("place"))


def find_names(docs: DataFrame, names: DataFrame, key: str = "doc_id", text: str = "text",
               most_bytes: int = MOST_BYTES, most_names: int = MOST_NAMES) -> DataFrame:
    """(key, name, place): the first place, counted from 1, of every name of ``names(name)`` in every text of ``docs(key, text)``.

    Case counts, names may overlap and hold each other.  Empty and null names
    stand nowhere, null texts hold none.  ``key`` must tell rows apart.  The
    list's size decides the way; both give the same rows.
    """
    listed = names.select("name").where("name <> ''").distinct()
    size = listed.agg(F.coalesce(F.sum(F.octet_length("name")), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    if size["b"] <= most_bytes and size["n"] <= most_names:
        return by_automaton(docs, sorted(r["name"] for r in listed.collect()), key, text)
    return by_join(docs, listed, key, text)


# ---- sites -------------------------------------------------------------------------

def site_parties(docs: DataFrame, sites: DataFrame, rules: RuleSet = LOCAL, key: str = "doc_id", **limits) -> DataFrame:
    """(key, site_id, shipper_name, shipper_address) of documents in which a listed site stands.

    ``sites(site_id, name)`` is the list; where several sites stand the one with
    the smallest id counts.  The address is that of the rule set's site rule.
    """
    d = SparkX()
    found = find_names(docs, sites, key, **limits).select(key, "name")
    first = found.join(sites.select("site_id", "name"), "name").groupBy(key).agg(F.min(F.struct("site_id", "name")).alias("site"))
    a1, a2 = d.rx(F.col("text"), rules.site_address, 1), d.rx(F.col("text"), rules.site_address, 2)
    address = F.when(a1 != "", F.concat(d.strip(a1), F.lit(", "), d.strip(a2)))
    return docs.select(key, "text").join(first, key).select(
        key, F.col("site.site_id").alias("site_id"), F.col("site.name").alias("shipper_name"), address.alias("shipper_address"))
