"""Table sources and sinks (parquet tables of the given data set)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; column pruning and filters reach the parquet scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# --- S9: surrogate keys ----------------------------------------------------------
def assign_ids(df: DataFrame, start=1, id_col: str = "id") -> DataFrame:
    """Unique ascending ids from ``start`` on: the partition's number and the row's place in it, as one number.

    A lazy projection without a sort, shuffle or checkpoint.  Ids have gaps,
    as those of an identity column may; they are fixed once the rows are
    written.
    """
    return df.withColumn(id_col, (F.lit(start) + F.monotonically_increasing_id()).cast("bigint"))


def next_id(existing: DataFrame | None, id_col: str = "id") -> int:
    """First free id of a table (1 for an empty or absent one)."""
    if existing is None:
        return 1
    return (existing.agg(F.max(id_col)).first()[0] or 0) + 1


# --- S10 / S11: idempotent schema setup -------------------------------------------
def ensure_columns(df: DataFrame, required, defaults: dict | None = None) -> tuple[DataFrame, int]:
    """Add every column of ``required`` (a StructType) missing from ``df``.

    Returns the widened DataFrame and the number of columns added.  Added
    columns take ``defaults[name]`` (cast to the column type) or NULL.
    """
    defaults = defaults or {}
    have = {c.lower() for c in df.columns}
    added = 0
    for f in required.fields:
        if f.name.lower() not in have:
            v = defaults.get(f.name)
            df = df.withColumn(f.name, (F.lit(v) if v is not None else F.lit(None)).cast(f.dataType))
            added += 1
    return df, added


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Column defaults for values not supplied (NULL → default)."""
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c)
                       if c in defaults else F.col(c) for c in df.columns])


# --- S5 / S6 / S7: sinks ---------------------------------------------------------
def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, None if there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``; created empty with ``schema`` if absent, columns that it lacks are read as NULL (S10)."""
    have = existing_table(spark, path)
    if have is None:
        spark.createDataFrame([], schema).write.mode("append").parquet(path)
        return spark.read.schema(schema).parquet(path)
    missing = [f for f in schema.fields if f.name.lower() not in {c.lower() for c in have.columns}]
    return spark.read.schema(T.StructType(have.schema.fields + missing)).parquet(path)


def append_table(df: DataFrame, path: str, schema: T.StructType, id_col: str = "id") -> int:
    """Append ``df`` with ids that go on from the table's last run; creates the table if absent.

    Returns the first id of this run.  One commit per call, written by all
    partitions at once; columns follow ``schema``, missing ones are NULL.
    """
    start = next_id(ensure_table(df.sparkSession, path, schema), id_col)
    full, _ = ensure_columns(assign_ids(df, start, id_col), schema)
    full.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode("append").parquet(path)
    return start


_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}


def append_csv_log(df: DataFrame, path: str) -> None:
    """CSV log: append; every part file carries its header line; values are quoted, with line breaks kept."""
    df.write.mode("append").options(**_CSV, quoteAll=True).csv(path)


def read_csv_log(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.options(**_CSV).schema(schema).csv(path)


def schema_audit(df: DataFrame, expected) -> DataFrame:
    """Of each expected column whether the table has it, and its non-null values: one aggregate over the table's rows."""
    have = {c.lower(): c for c in df.columns}
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(have[c.lower()]).alias("c_" + c) for c in expected if c.lower() in have])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(c.lower() in have).alias("present"),
                              (F.col("c_" + c) if c.lower() in have else F.lit(None).cast("bigint")).alias("filled"),
                              F.col("n").alias("row_count")) for c in expected])
    return counts.select(F.inline(rows))
