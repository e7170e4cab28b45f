"""The most frequent texts without shuffling texts: mergeable summaries of hashes, then an exact count of the candidates.

Each task keeps a Misra-Gries summary of the texts' hashes: a bounded number of
counters, and the sum by which they were lowered to stay so few.  Summaries
merge by adding.  A hash that no summary holds occurs at most as often as the
counters were lowered in all, which tells whether the candidates are complete.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counters of a task's summary.
COUNTERS = 1024
#: Candidates that are sent to the tasks, 8 bytes each; more are joined.
MOST_CANDIDATES = 100_000


def lowered(hashes: np.ndarray, counts: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray, int]:
    """At most ``counters`` of the counters left, all lowered by the largest one that goes."""
    if len(hashes) <= counters:
        return hashes, counts, 0
    by = int(np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1])
    left = counts > by
    return hashes[left], counts[left] - by, by


def summaries(counters: int = COUNTERS):
    """(hash, count, lost): a task's counters, and with a null hash the sum by which they were lowered."""
    def run(batches):
        hashes, counts, lost = np.empty(0, np.int64), np.empty(0, np.int64), 0
        for b in batches:
            new, n = np.unique(b.column("hash").to_numpy(zero_copy_only=False), return_counts=True)
            every, at = np.unique(np.concatenate([hashes, new]), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate([counts, n]), minlength=len(every)).astype(np.int64)
            hashes, counts, by = lowered(every, total, counters)
            lost += by
        yield pa.RecordBatch.from_arrays(
            [pa.array([*hashes.tolist(), None], pa.int64()), pa.array([*counts.tolist(), 0], pa.int64()), pa.array([0] * len(hashes) + [lost], pa.int64())],
            names=["hash", "count", "lost"])

    return run


def most_frequent(texts: DataFrame, k: int, column: str, counters: int = COUNTERS, most_candidates: int = MOST_CANDIDATES) -> DataFrame:
    """(column, n): the ``k`` most frequent values of a string column with their exact counts, ties by the value; nulls do not count.

    A value's count is at least its summed counter and at most that plus the
    loss of all tasks.  Candidates are the hashes whose upper bound reaches the
    ``k``-th largest counter; they hold all winners if that counter is beyond
    the loss.  If it is not (many values, none of them frequent), the hashes
    of all values are counted, which is exact as well and costs a shuffle of
    16 bytes a value.  Only rows with a candidate's hash are then counted by
    their texts, so that two texts of one hash stay apart.
    """
    rows = texts.where(F.col(column).isNotNull()).select(column, F.xxhash64(column).alias("hash"))
    merged = (rows.select("hash").mapInArrow(summaries(counters), "hash long, count long, lost long")
              .groupBy("hash").agg(F.sum("count").alias("count"), F.sum("lost").alias("lost")))
    # the k-th largest counter and the loss: k + 1 rows
    top = merged.orderBy(F.col("hash").isNull().desc(), F.col("count").desc()).limit(k + 1).collect()
    lost = next((r["lost"] for r in top if r["hash"] is None), 0)
    best = [r["count"] for r in top if r["hash"] is not None]
    least = best[k - 1] if len(best) >= k else 0
    if lost and least <= lost:
        counted = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("count"))
        kth = counted.orderBy(F.col("count").desc()).limit(k).agg(F.min("count").alias("least"))
        wanted = counted.where(F.col("count") >= kth.scalar()).select("hash")
    else:
        wanted = merged.where(F.col("hash").isNotNull() & (F.col("count") + lost >= least)).select("hash")
        if wanted.count() <= most_candidates:
            wanted = F.broadcast(wanted)
    found = rows.join(wanted, "hash", "left_semi").groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return found.orderBy(F.col("n").desc(), F.col(column)).limit(k)
