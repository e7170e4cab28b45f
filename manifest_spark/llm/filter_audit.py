"""Filter interaction audit: what each of five filters removes in every order, by an incremental stream with retraction.

All files of a table run through an available-now stream in a few micro-batches.
The state keyed by text holds each one's smallest id so far, for a bounded number
of texts together, as one Python call a text would cost more than all the rest
(milliseconds); when a smaller id arrives,
the mask that the earlier document was counted with is taken back from its
part's counter and the mask with "copy of another" is counted instead.  A
report over all 120 orders of the filters needs the counters only.
"""

from __future__ import annotations

import io
import os
import uuid
from itertools import permutations
from math import factorial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .common import shared_dir, written

FILTERS = "ABCDE"
#: Micro-batches that a table's files are dealt to.
BATCHES = 4
#: Texts that share a state, which a Python call reads and writes as a whole (about 100 bytes a text).
TEXTS = 2048
#: Entries that a task gathers before it hands partial counts on.
HELD = 100_000

_BLANK = r"[\x20\x09-\x0D]+"
_COPY = 1 << FILTERS.index("E")
COUNTS = "part string, mask int, flags int, n long"
STATE = "held binary"


def masks(text) -> F.Column:
    """Bits of the filters that a text fails by itself: A few words, B few distinct words, C capitals, D signs."""
    words = F.filter(F.split(text, _BLANK), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (n < 50, 100 * F.size(F.array_distinct(words)) < 65 * n,
             F.lit(100).cast("long") * capitals > F.lit(5).cast("long") * F.length(text), F.regexp_like(text, F.lit("[#$%&*|]")))
    return sum((f.cast("int") * F.lit(1 << i) for i, f in enumerate(fails)), F.lit(0))


def partials(batches):
    """Rows (key, part, flags, mask, doc_id) pre-aggregated in a task: smallest id, rows with it, rows in all, rows without an id."""
    def batch(held):
        cols = list(zip(*[(*k, *v) for k, v in held.items()]))
        types = (pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=["key", "part", "flags", "mask", "least", "n_least", "n", "n_null"])

    held = {}
    for b in batches:
        for *k, d in zip(*(b.column(c).to_pylist() for c in ("key", "part", "flags", "mask", "doc_id"))):
            k = tuple(k)
            at = held.get(k)
            if at is None:
                at = held[k] = [None, 0, 0, 0]
            if d is None:
                at[3] += 1
                continue
            at[2] += 1
            if at[0] is None or d < at[0]:
                at[0], at[1] = d, 1
            elif d == at[0]:
                at[1] += 1
        if len(held) > HELD:
            yield batch(held)
            held = {}
    if held:
        yield batch(held)


def _packed(held: pd.DataFrame) -> bytes:
    sink = io.BytesIO()
    batch = pa.RecordBatch.from_pandas(held, preserve_index=False)
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue()


_HELD = ["key", "least", "part", "flags", "n"]


def retract(bucket, frames, state):
    """Changes (part, mask, flags, n) of the counters by new rows of a bucket of texts.

    The state holds for each text its smallest id, and the counters in which
    the rows with that id stand (one, unless an id is repeated).  Rows with a
    text's smallest id do not fail E, all others do.  When a smaller id comes,
    the earlier rows move from their mask to the mask with E.  Rows without an
    id have no smaller one and are smaller than none.
    """
    new = pd.concat(list(frames), ignore_index=True)
    held = (pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists
            else pd.DataFrame({"key": pd.Series(dtype=object), "least": pd.Series(dtype="int64"), "part": pd.Series(dtype=object),
                               "flags": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64")}))
    nameless = new[new.n_null > 0]
    new = new[new.n > 0].astype({"least": "int64"})
    low = new.groupby("key").least.min()
    if len(held):
        low = pd.concat([low, held[held.key.isin(low.index)].groupby("key").least.first()]).groupby(level=0).min()
    own = new.n_least.where(new.least.to_numpy() == new.key.map(low).to_numpy(), 0)
    now_low = held.key.map(low)  # only texts with new rows
    lost = held[now_low.notna() & (now_low < held.least)]
    mask = new.groupby("key")["mask"].first()  # a text's own filters are those of every row of it
    lost = lost.assign(mask=lost.key.map(mask))
    change = pd.concat([
        nameless.assign(n=nameless.n_null), new.assign(n=own), new.assign(mask=new["mask"] | _COPY, n=new.n - own),
        lost.assign(n=-lost.n), lost.assign(mask=lost["mask"].astype("int64") | _COPY)])[["part", "mask", "flags", "n"]]
    change = change.astype({"mask": "int32", "flags": "int32", "n": "int64"}).groupby(["part", "mask", "flags"], as_index=False).n.sum()
    firsts = new.assign(n=own)[own > 0]
    held = pd.concat([held.drop(lost.index), firsts[_HELD]]).astype({"least": "int64", "flags": "int64", "n": "int64"})
    state.update((_packed(held.groupby(["key", "least", "part", "flags"], as_index=False, sort=False).n.sum()),))
    yield change[change.n != 0]


def label_flags(labels: DataFrame) -> DataFrame:
    """(doc_id, flags) of documents labelled good (1) or toxic (2); of several labels of an id each counts."""
    bit = lambda c, v: F.max(F.when(F.col(c).cast("int") == 1, v).otherwise(0))
    each = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return each.agg((bit("quality", 1) + bit("toxic", 2)).alias("flags"))


def _buckets(spark: SparkSession, place: str, table: DataFrame, texts: int) -> int:
    """The number of states, fixed by the first run and kept in ``place``."""
    path = os.path.join(place, "start")
    try:
        return spark.read.schema("buckets long").parquet(path).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    n = max(1, -(-table.count() // texts))  # rows by the files' footers
    spark.createDataFrame([], COUNTS).write.mode("overwrite").parquet(os.path.join(place, "counts", "none"))
    spark.createDataFrame([(n,)], "buckets long").write.mode("overwrite").parquet(path)
    return n


def counters(spark: SparkSession, path: str, labels: DataFrame, place: str | None = None, batches: int = BATCHES, texts: int = TEXTS) -> DataFrame:
    """(part, mask, flags, n): documents of the table at ``path`` by source, failed filters and labels.

    ``path`` names a Parquet file or a folder of such.  ``place`` is a shared
    folder for state, progress and counts; a run that ended early goes on from
    there, and a repeated micro-batch writes its changes over again, not twice.
    Files that have come since are added; states are as many as ``texts`` rows
    each of the first run's table need.
    """
    place = place or os.path.join(shared_dir(spark), f"filter-audit-{uuid.uuid4().hex}")
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    out = os.path.join(place, "counts")
    buckets = _buckets(spark, place, table, texts)
    src = (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, -(-files // batches))).parquet(path + "*"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = src.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                      F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("key"), masks(text).alias("mask"),
                      # rows without an id find no label; dealt by text, so that they do not gather in one task
                      F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64(text), F.lit(1024))).otherwise(F.lit(0)).alias("deal"))
    known = written(label_flags(labels), "label-flags").withColumn("deal", F.lit(0).cast("long"))
    flagged = docs.join(known, ["doc_id", "deal"], "left").select(
        "key", "part", F.coalesce("flags", F.lit(0)).cast("int").alias("flags"), "mask", "doc_id")
    few = flagged.mapInArrow(partials, "key binary, part string, flags int, mask int, least long, n_least long, n long, n_null long")
    few = few.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    changes = few.groupBy("bucket").applyInPandasWithState(retract, COUNTS, STATE, "update", "NoTimeout")

    def keep(batch: DataFrame, number: int) -> None:
        total = batch.groupBy("part", "mask", "flags").agg(F.sum("n").alias("n"))
        total.write.mode("overwrite").parquet(os.path.join(out, f"batch-{number}"))

    # the session chooses the state store (spark.sql.streaming.stateStore.providerClass)
    run = (changes.writeStream.outputMode("update").option("checkpointLocation", os.path.join(place, "progress"))
           .foreachBatch(keep).trigger(availableNow=True).start())
    run.awaitTermination()
    each = spark.read.schema(COUNTS).parquet(os.path.join(out, "*"))
    return each.groupBy("part", "mask", "flags").agg(F.sum("n").alias("n")).where("n <> 0")


def report(counts: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step, from ``counts`` (part, mask, flags, n).

    What is kept after a set of filters is the sum over the masks that miss the
    set; all columns are differences of such sums.
    """
    n_sets = 1 << len(FILTERS)
    weight = {"n": F.lit(True), "good": F.col("flags").bitwiseAND(1) > 0, "toxic": F.col("flags").bitwiseAND(2) > 0}
    wide = counts.groupBy("part").agg(*[F.sum(F.when((F.col("mask") == m) & w, F.col("n")).otherwise(0)).alias(f"{name}{m}")
                                        for name, w in weight.items() for m in range(n_sets)])
    total = lambda name, s: sum((F.col(f"{name}{m}") for m in range(1, n_sets) if not m & s), F.col(f"{name}0"))
    per = wide.select("part", *[F.array(*[total(name, s) for s in range(n_sets)]).alias(name) for name in weight],
                      F.array(*[F.col(f"n{1 << i}") for i in range(len(FILTERS))]).alias("alone"))
    others = lambda i: [s for s in range(n_sets) if not s >> i & 1]
    share = F.array(*[sum((F.lit(factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count())).cast("long")
                           * (F.col("n")[s] - F.col("n")[s | 1 << i]) for s in others(i)), F.lit(0).cast("long")) for i in range(len(FILTERS))])
    steps = []
    for order in permutations(range(len(FILTERS))):
        for k, i in enumerate(order):
            steps.append(("".join(FILTERS[x] for x in order), k + 1, i, 1 << i, sum(1 << x for x in order[:k])))
    names, numbers, letters, bits, before = (F.array(*[F.lit(x) for x in col]) for col in zip(*steps))
    at = per.withColumn("share", share).withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))))
    at = at.select("part", "n", "good", "toxic", "alone", "share", names[F.col("at")].alias("filter_order"), numbers[F.col("at")].alias("step"),
                   letters[F.col("at")].alias("i"), bits[F.col("at")].alias("bit"), before[F.col("at")].alias("p"))
    after = F.col("p") + F.col("bit")  # the filter is not among those before it
    lost = lambda name: F.col(name)[F.col("p")] - F.col(name)[after]
    return at.select("part", "filter_order", "step", F.col("n")[after].alias("kept"), lost("n").alias("removed"),
                     (F.col("n")[0] - F.col("n")[F.col("bit")] - lost("n")).alias("redundant"), F.col("alone")[F.col("i")].alias("unique_fails"),
                     lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.col("share")[F.col("i")].alias("shapley"))


def audit(spark: SparkSession, path: str, labels: DataFrame, place: str | None = None, batches: int = BATCHES) -> DataFrame:
    """The report over the table at ``path`` with columns doc_id, text and source; others are not read.

    Null texts are empty ones and so are null sources (part ''); an empty table
    has no parts and no rows.  Texts are equal if the first 128 bits of their SHA-256
    values are.
    Rows that repeat a text's smallest id do not fail E, as no id is smaller;
    rows without an id never do and have no label.  Order of arrival, ties and
    the cut into micro-batches do not change the result.
    """
    return report(counters(spark, path, labels, place, batches))
