"""A log kept by day, with mergeable partial results of each day, so that reports read only the days they need.

``keep`` adds a batch of log rows: the rows go to their days' folders, and one
partial row a day (counts, a sum, the extent) beside them.  Partials of a day
add up over batches.  A report over whole days reads partials; days that a
report cuts are read as rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .reports import _rate

PARTIAL = ("total long, ok long, failed long, fields_sum long, fields_n long, first_entry timestamp_ntz, last_entry timestamp_ntz, day date")
ROWS = "id long, status string, log_timestamp timestamp_ntz, extracted_fields int, error_message string, day date"


def _sums(rows):
    """The counters of a group of log rows; all of them add up."""
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "processed").alias("ok"),
                    F.count_if(F.col("status") == "rejected").alias("failed"), F.sum(F.col("extracted_fields").cast("long")).alias("fields_sum"),
                    F.count("extracted_fields").alias("fields_n"), F.min("log_timestamp").alias("first_entry"), F.max("log_timestamp").alias("last_entry"))


def keep(log: DataFrame, path: str) -> None:
    """Adds rows of a log (id, status, log_timestamp, extracted_fields, error_message); rows without a time belong to no day and are left out."""
    rows = log.where("log_timestamp is not null").withColumn("day", F.to_date("log_timestamp"))
    names = [c.split()[0] for c in ROWS.split(", ")]
    # rows of a day meet in a few files; a large day is split by adaptive execution
    rows.select(*names).hint("rebalance", F.col("day")).write.mode("append").partitionBy("day").parquet(os.path.join(path, "rows"))
    partial = _sums(rows.groupBy("day"))
    partial.select(*[c.split()[0] for c in PARTIAL.split(", ")]).write.mode("append").partitionBy("day").parquet(os.path.join(path, "days"))


def days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARTIAL).parquet(os.path.join(path, "days"))


def rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROWS).parquet(os.path.join(path, "rows"))


def last_entry(spark: SparkSession, path: str):
    """The time of the latest row: the last day's partials."""
    latest = days(spark, path).agg(F.max("day")).first()[0]  # the folders' names
    return None if latest is None else days(spark, path).where(F.col("day") == F.lit(latest)).agg(F.max("last_entry")).first()[0]


def _added(partials: DataFrame) -> DataFrame:
    none = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return partials.agg(*[none(c).alias(c) for c in ("total", "ok", "failed", "fields_sum", "fields_n")])


def _average():
    return F.coalesce(F.round(F.col("fields_sum").cast("double") / F.nullif(F.col("fields_n"), F.lit(0)), 1), F.lit(0.0))


def daily_report(spark: SparkSession, path: str, day=None) -> DataFrame:
    """The report of one day (by default the last one): reads that day's partials."""
    last = last_entry(spark, path) if day is None else None
    day = F.lit(day).cast("date") if day is not None else F.lit(last.date() if last is not None else None).cast("date")
    g = _added(days(spark, path).where(F.col("day") == day))
    return g.select(F.col("total").alias("total_processed"), F.col("ok").alias("successful"), "failed", _average().alias("avg_fields_extracted"),
                    _rate(F.col("ok"), F.col("total")).alias("success_rate"))


def daily_report_all(spark: SparkSession, path: str) -> DataFrame:
    """The report of every day, from partials alone."""
    g = _added(days(spark, path).groupBy("day"))
    return g.select("day", F.col("total").alias("total_processed"), F.col("ok").alias("successful"), "failed", _average().alias("avg_fields_extracted"),
                    _rate(F.col("ok"), F.col("total")).alias("success_rate"))


def last_days(spark: SparkSession, path: str, n: int = 7, as_of=None) -> DataFrame:
    """Totals of the ``n`` times 24 hours up to ``as_of`` and after (by default the latest entry): whole days from partials, the cut day from rows."""
    as_of = as_of or last_entry(spark, path)
    since = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {n} DAYS")
    first = F.to_date(since)
    whole = days(spark, path).where(F.col("day") > first).drop("day")
    cut = _sums(rows(spark, path).where((F.col("day") == first) & (F.col("log_timestamp") >= since)))
    g = _added(whole.unionByName(cut))
    return g.select(F.col("total").alias("total_documents"), F.col("ok").alias("successful"), _average().alias("avg_fields"))
