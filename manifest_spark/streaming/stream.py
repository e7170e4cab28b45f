"""Incremental runs with Structured Streaming.

* ``start_ingest`` (ST1): a file stream over the landing directory; a message
  that is delivered again, in another file or batch, is dropped by its id,
  which the stream's state keeps; each micro-batch of new messages is parsed
  once, validated and written to the orders, log and outbox
  tables by ``foreachBatch``.  Every sink is partitioned by ``batch_id`` and
  written with dynamic partition overwrite, so a replayed batch (after a
  failure, before its offsets were committed) rewrites the same partition
  instead of appending twice.  The checkpoint records which files were
  processed — the "unread" state of the original inbox, but only advanced
  after the batch's writes succeeded.
* ``start_daily_report`` (ST2): the daily report over a growing log, a
  windowed aggregate in update mode that takes rows however late they are;
  each batch upserts its updated days (dynamic overwrite of the ``day``
  partitions).
"""

from __future__ import annotations

import datetime as dt
import os
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import route
from ..plans.rules import LOCAL, RuleSet
from ..sources.ingest import all_parts, attachment_text, attachments_of, message_id, unreadable_of

from ..sources.tables import existing_table


#: Folder of the rows of the batch in hand; the next batch, or the batch's replay, overwrites it.
STAGED = "_batch"
_STATE = "spark.sql.streaming.stateStore."
#: The ingest's state has a row for each message ever seen: on local disks, with bounded memory, where the session names nothing else.
STATE_STORE = {
    _STATE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _STATE + "rocksdb.boundedMemoryUsage": "true",
    _STATE + "rocksdb.changelogCheckpointing.enabled": "true",  # a batch stores its new ids, not the whole state
    _STATE + "rocksdb.trackTotalNumberOfRows": "false",  # else another look-up a message
}


@contextmanager
def _unless_set(spark: SparkSession, settings: dict):
    """Settings for queries that start here, which keep them; those that the session has stay."""
    added = {k: v for k, v in settings.items() if spark.conf.get(k, None) is None}
    try:
        for k, v in added.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k in added:
            spark.conf.unset(k)


def _overwrite_partitions(df: DataFrame, path: str, by: list) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def utf8_page(content: bytes) -> list[str]:
    """The decoder for attachments that are plain text: one page."""
    return [content.decode("utf-8", errors="replace")]


def process_batch(batch: DataFrame, batch_id: int, out_dir: str, rules: RuleSet = LOCAL,
                  run_ts: str | None = None, decoder=utf8_page) -> None:
    """One micro-batch: messages → attachments → pages → records → orders, log, notices and unreadable messages.

    The run is stamped with the time at which the batch starts unless a time is
    given.  Ids are the batch number and the row's place: unique over batches,
    the same when a batch is replayed on the same partitions.
    """
    run_ts = run_ts or dt.datetime.now().isoformat(sep=" ", timespec="seconds")
    tag = lambda df: df.withColumn("batch_id", F.lit(batch_id))
    # each message is parsed once: unreadable ones go along as rows with an error, and six sinks read what is stored
    att = attachments_of(all_parts(batch), with_unreadable=True).withColumn("doc_id", F.concat_ws("#", "path", F.col("part_no").cast("string")))
    docs = attachment_text(att, decoder).select("doc_id", "email_from", "email_subject", "attachment_name", "text", "path", "error")
    done = route.process(docs, rules, run_ts, keep=("path", "error"))
    staged = os.path.join(out_dir, STAGED)
    done.write.mode("overwrite").option("parquet.enable.dictionary", "false").parquet(staged)  # read a few times only
    done = batch.sparkSession.read.schema(done.schema).parquet(staged)
    p = done.where("error is null")
    ids = F.concat_ws("-", F.lit(str(batch_id)), "doc_id")
    for name, df in (("orders", route.route_accept(p).withColumn("id", ids)),
                     ("order_log", route.status_log(p).withColumn("id", ids)),
                     ("outbox", route.rejection_outbox(p)),
                     ("notices", route.success_outbox(p)),
                     ("notice_lines", route.success_lines(p)),
                     ("unreadable", unreadable_of(done))):
        _overwrite_partitions(tag(df), os.path.join(out_dir, name), ["batch_id"])


def start_ingest(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str,
                 rules: RuleSet = LOCAL, run_ts: str | None = None, available_now: bool = True, decoder=utf8_page):
    """Start (and for ``available_now`` run to completion) the ingest stream."""
    schema = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
    src = (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.eml")
           .load(landing_dir))
    return ingest_stream(src, out_dir, checkpoint, rules, run_ts, available_now, decoder)


def ingest_stream(messages: DataFrame, out_dir: str, checkpoint: str, rules: RuleSet = LOCAL, run_ts: str | None = None,
                  available_now: bool = True, decoder=utf8_page):
    """Start the ingest of a stream of ``messages(path, content)``.

    Message ids are keyed state: one row for each message ever seen, in
    RocksDB unless the session or the checkpoint names another state store.
    """
    new = messages.select("path", "content", message_id(F.col("content")).alias("message_id")).dropDuplicates(["message_id"])
    w = (new.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda b, i: process_batch(b, i, out_dir, rules, run_ts, decoder)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    with _unless_set(messages.sparkSession, STATE_STORE):
        return w.start()


DAILY_SCHEMA = "total_processed BIGINT, successful BIGINT, failed BIGINT, _fields_sum DOUBLE, day DATE"


def daily_counts(log: DataFrame, watermark: str | None = None) -> DataFrame:
    """Streaming form of the per-day report (same columns as ``daily_report_all``).

    The state is one row a day, so rows may come late without bound; a caller
    who wants old days dropped from the state gives a watermark.
    """
    if watermark is not None:
        log = log.withWatermark("log_timestamp", watermark)
    g = (log.groupBy(F.window("log_timestamp", "1 day").alias("w"))
         .agg(F.count(F.lit(1)).alias("total_processed"),
              F.count_if(F.col("status") == "processed").alias("successful"),
              F.count_if(F.col("status") == "rejected").alias("failed"),
              F.sum(F.col("extracted_fields").cast("double")).alias("_fields_sum")))
    return g.select(F.to_date(F.col("w.start")).alias("day"), "total_processed", "successful",
                    "failed", "_fields_sum")


def finish_daily(df: DataFrame) -> DataFrame:
    """Averages and rates from the upserted per-day counts."""
    avg = F.col("_fields_sum") / F.col("total_processed")
    return df.select(
        "day", "total_processed", "successful", "failed",
        F.coalesce(F.round(avg, 1), F.lit(0.0)).alias("avg_fields_extracted"),
        F.when(F.col("total_processed") > 0,
               F.round(F.lit(100.0) * F.col("successful") / F.col("total_processed"), 1))
        .otherwise(F.lit(0.0)).alias("success_rate"))


def start_daily_report(spark: SparkSession, log_stream: DataFrame, out_dir: str, checkpoint: str,
                       available_now: bool = True, watermark: str | None = None):
    def upsert(batch: DataFrame, batch_id: int) -> None:
        _overwrite_partitions(batch, out_dir, ["day"])

    w = (daily_counts(log_stream, watermark).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint).foreachBatch(upsert))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_daily_report(spark: SparkSession, out_dir: str) -> DataFrame:
    """The upserted days with their averages and rates; no rows if the stream had none."""
    days = existing_table(spark, out_dir)  # the schema is given: the folder may hold no file yet
    empty = spark.createDataFrame([], DAILY_SCHEMA)
    return finish_daily(empty if days is None else spark.read.schema(DAILY_SCHEMA).parquet(out_dir))
