"""Loads that can be run again: staged files, and a manifest that names the files of committed runs.

A run writes its rows under a fresh folder and then appends one line to the
table's manifest.  Readers take only the files that the manifest names.  So a
run that died on the way leaves nothing that is read, and can simply be run
again; a run that is already committed is not loaded a second time.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import ensure_columns, existing_table

MANIFEST = "run_id string, attempt string, first_id long, row_count long"
_PLACE = 33  # bits of a row's place in its partition in monotonically_increasing_id


def dense_ids(df: DataFrame, order: list[str], start: int, path: str, id_col: str = "id") -> DataFrame:
    """``df`` with the ids start, start + 1, ... in the order of ``order``, without gaps; rows are staged under ``path``.

    A distributed prefix sum: rows are dealt to ranges and sorted there, and
    staged with their partition's number and their place in it; the counts of
    the partitions (one row each) are summed up, and each partition's offset
    joins its rows.  No task holds more than its range.  Nulls come first; rows
    equal in all of ``order`` are numbered in any order, once.
    """
    spark = df.sparkSession
    at = "__place"
    (df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
     .write.mode("overwrite").parquet(path))
    staged = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(at, T.LongType())])).parquet(path)
    part = F.shiftright(at, _PLACE)
    counts = staged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # one row a partition: the number of partitions bounds this window and the broadcast
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    place = F.col(at) - F.shiftleft(part, _PLACE)
    return (staged.withColumn("__part", part).join(F.broadcast(offsets), "__part")
            .select((F.lit(start) + F.col("__before") + place).cast("bigint").alias(id_col), *df.columns))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, attempt, first_id, row_count) of the committed runs; of several attempts of a run one counts for all readers."""
    lines = existing_table(spark, os.path.join(path, "manifest"))
    if lines is None:
        return spark.createDataFrame([], MANIFEST)
    return lines.groupBy("run_id").agg(F.min(F.struct("attempt", "first_id", "row_count")).alias("x")).select("run_id", "x.*")


def stage(df: DataFrame, path: str, schema: T.StructType, run_id: str, order: list[str], start: int, id_col: str = "id") -> str:
    """Writes a run's rows, with their ids, to a fresh folder; returns the attempt's name.  No reader sees it yet."""
    attempt = uuid.uuid4().hex
    wide, _ = ensure_columns(df.drop(id_col), T.StructType([f for f in schema.fields if f.name != id_col]))
    rows = dense_ids(wide.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields if f.name != id_col]), order, start,
                     os.path.join(path, "sorted", attempt), id_col)
    rows.select(*[f.name for f in schema.fields]).write.parquet(os.path.join(path, "data", run_id, attempt))
    return attempt


def load(df: DataFrame, path: str, schema: T.StructType, run_id: str, order: list[str], id_col: str = "id") -> bool:
    """Loads ``df`` as run ``run_id`` into the table at ``path``; False if that run is already in it.

    Ids go on from the last run's, in the order of ``order``.  Columns follow
    ``schema``; missing ones are NULL.  The manifest's line is the commit: a
    single file, which comes into sight at once.  One writer at a time, as ids
    follow each other.
    """
    spark = df.sparkSession
    done = manifest(spark, path).collect()  # one row a run
    if any(r["run_id"] == run_id for r in done):
        return False
    start = max((r["first_id"] + r["row_count"] for r in done), default=1)
    attempt = stage(df, path, schema, run_id, order, start, id_col)
    n = spark.read.schema(schema).parquet(os.path.join(path, "data", run_id, attempt)).count()
    spark.createDataFrame([(run_id, attempt, start, n)], MANIFEST).coalesce(1).write.mode("append").parquet(os.path.join(path, "manifest"))
    return True


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed runs, with their ``run_id``."""
    out = None
    for r in manifest(spark, path).orderBy("first_id").collect():  # one row a run
        one = spark.read.schema(schema).parquet(os.path.join(path, "data", r["run_id"], r["attempt"])).withColumn("run_id", F.lit(r["run_id"]))
        out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])) if out is None else out
