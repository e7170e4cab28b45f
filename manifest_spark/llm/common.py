"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares; where none is named, a scratch one in local mode only."""
    return ensure_checkpoint_dir(spark)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with at most ``max_bytes`` of text each (a longer single text stands alone)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False), "i8")
        at = 0
        total = np.concatenate([[0], np.cumsum(size)])
        while at < b.num_rows:
            to = int(np.searchsorted(total, total[at] + max_bytes, "right")) - 1
            to = min(max(to, at + 1), b.num_rows)
            yield b.slice(at, to - at)
            at = to


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return [b"" if t is None else t for t in batch.column(column).cast(pa.binary()).to_pylist()]


def thinned(df: DataFrame, limit: int, *keys: str) -> DataFrame:
    """At most ``limit`` distinct rows by ``keys``, the first in the order of a hash of them.

    Only rows with hashes below a bound that about twice ``limit`` rows meet
    go into the sort, so that no partition hands on ``limit`` rows of its own.
    """
    n, h = df.count(), F.xxhash64(*keys)
    if n > 2 * limit:
        df = df.where(F.shiftrightunsigned(h, 32) < int(2**32 * 2.0 * limit / n))
    return df.dropDuplicates(list(keys)).orderBy(h, *keys).limit(limit)


def fold(doc_id: str, mod: int):
    """crc32 of the id as text modulo ``mod``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod


def held_out(doc_id: str, mod: int, rest: int):
    """Whether a row is held out; a null id counts as not held out (and is never learned from)."""
    return F.coalesce(fold(doc_id, mod) == rest, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, mod: int, rest: int) -> DataFrame:
    """All labelled documents outside the held-out fold, as (doc_id, text, y).

    Null and other labels than 0 and 1 are left out; of several labels of an id
    the largest counts, of several texts the smallest.
    """
    return _texts_with(docs, _labels(labels, label, mod, rest))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, rest: int, limit: int) -> DataFrame:
    """At most ``limit`` of ``labelled_rows``: the first ids in the order of a hash of the id."""
    # the broadcast side holds `limit` rows of two numbers at most
    return _texts_with(docs, F.broadcast(thinned(_labels(labels, label, mod, rest), limit, "doc_id")))


def _labels(labels: DataFrame, label: str, mod: int, rest: int) -> DataFrame:
    return (labels.select("doc_id", F.col(label).cast("int").alias("y"))
           .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", mod) != rest))
           .groupBy("doc_id").agg(F.max("y").alias("y")))


def _texts_with(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    return (docs.select("doc_id", "text").join(wanted, "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")))


class Memo:
    """A bounded cache of two generations: when the young one is full it becomes the old one."""

    def __init__(self, size: int = 250_000):
        self.size, self.young, self.old = size, {}, {}

    def missing(self, keys) -> list:
        """Keys known to neither generation; those of the old one move to the young one."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old, out = self.young, self.old, []
        for k in keys:
            if k not in young:
                if k in old:
                    young[k] = old[k]
                else:
                    out.append(k)
        return out
