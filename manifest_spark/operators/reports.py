"""Processing reports over the log and orders tables.

Every ``now()`` of the original reports is an explicit ``as_of`` here; by
default it is the latest log timestamp, computed as a scalar subquery (one
global max, a partial + final aggregate) rather than collected to the driver.
Top-k reports use ``orderBy(...).limit(k)`` which Spark plans as
``TakeOrderedAndProject`` (per-partition top-k, then a k-row merge), with an
``id`` tie-break so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table


def process_log_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A processing log derived from ``events`` (see FIXTURES §4)."""
    e = read_table(spark, sf_dir, "events")
    err = F.col("event_type") == "error"
    return e.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email_from"),
        F.concat(F.lit("Load "), F.col("event_id").cast("string")).alias("email_subject"),
        F.concat(F.lit("doc_"), F.col("event_id").cast("string"), F.lit(".pdf")).alias("attachment_name"),
        F.when(err, "rejected").otherwise("processed").alias("status"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("log_timestamp"),
        F.when(err, F.repeat(F.col("props"), (F.col("event_id") % 8 + 1).cast("int")))
        .otherwise(F.lit("")).alias("error_message"),
        F.when(err, F.lit(0)).otherwise((F.floor(F.col("value")) % 16).cast("int"))
        .cast("int").alias("extracted_fields"),
    )


PROCESS_LOG_SQL = """SELECT event_id AS id,
    'user' || CAST(user_id AS VARCHAR) || '@example.com' AS email_from,
    'Load ' || CAST(event_id AS VARCHAR) AS email_subject,
    'doc_' || CAST(event_id AS VARCHAR) || '.pdf' AS attachment_name,
    CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'processed' END AS status,
    date_trunc('second', ts) AS log_timestamp,
    CASE WHEN event_type = 'error' THEN repeat(props, CAST(event_id % 8 + 1 AS INTEGER)) ELSE '' END AS error_message,
    CAST(CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS BIGINT) % 16 END AS INTEGER) AS extracted_fields
    FROM events"""


def _rate(ok, total):
    return F.when(total > 0, F.round(F.lit(100.0) * ok / total, 1)).otherwise(F.lit(0.0))


def _as_of(log: DataFrame, as_of=None):
    if as_of is not None:
        return F.lit(as_of).cast("timestamp_ntz")
    return log.select(F.max("log_timestamp")).scalar()


# --- R1 ----------------------------------------------------------------------
def overall_stats(log: DataFrame) -> DataFrame:
    g = log.agg(F.count(F.lit(1)).alias("total_documents"),
                F.count_if(F.col("status") == "processed").alias("successful"),
                F.count_if(F.col("status") == "rejected").alias("failed"))
    return g.select("*", _rate(F.col("successful"), F.col("total_documents")).alias("success_rate"))


OVERALL_STATS_SQL = """SELECT *, CASE WHEN total_documents > 0
    THEN round(100.0 * successful / total_documents, 1) ELSE 0.0 END AS success_rate
    FROM (SELECT count(*) AS total_documents,
      count(*) FILTER (WHERE status = 'processed') AS successful,
      count(*) FILTER (WHERE status = 'rejected') AS failed FROM ({log}) l) g"""


# --- R2 ----------------------------------------------------------------------
def last_7_days(log: DataFrame, as_of=None) -> DataFrame:
    since = _as_of(log, as_of) - F.expr("INTERVAL 7 DAYS")
    w = log.where(F.col("log_timestamp") >= since)
    return w.agg(F.count(F.lit(1)).alias("total_documents"),
                 F.count_if(F.col("status") == "processed").alias("successful"),
                 F.coalesce(F.round(F.avg(F.col("extracted_fields").cast("double")), 1),
                            F.lit(0.0)).alias("avg_fields"))


LAST_7_DAYS_SQL = """SELECT count(*) AS total_documents,
    count(*) FILTER (WHERE status = 'processed') AS successful,
    COALESCE(round(avg(CAST(extracted_fields AS DOUBLE)), 1), 0.0) AS avg_fields
    FROM ({log}) l
    WHERE log_timestamp >= (SELECT max(log_timestamp) FROM ({log}) m) - INTERVAL 7 DAYS"""


# --- R3 ----------------------------------------------------------------------
def short_error(e, n=50):
    """T-SQL ``CASE WHEN LEN(e) > n THEN LEFT(e, n) + '...' ELSE e END`` (LEN ignores trailing blanks)."""
    return F.when(F.length(F.rtrim(e)) > n, F.concat(F.substring(e, 1, n), F.lit("..."))) \
        .otherwise(F.coalesce(e, F.lit("")))


def recent_activity(log: DataFrame, k: int = 10) -> DataFrame:
    top = log.orderBy(F.col("log_timestamp").desc(), F.col("id").desc()).limit(k)
    return top.select(
        "id",
        F.date_format("log_timestamp", "yyyy-MM-dd HH:mm").alias("timestamp"),
        F.substring(F.coalesce("attachment_name", F.lit("")), 1, 24).alias("file"),
        "status",
        F.coalesce("extracted_fields", F.lit(0)).alias("fields"),
        short_error(F.col("error_message")).alias("short_error"))


RECENT_ACTIVITY_SQL = """SELECT id, strftime(log_timestamp, '%Y-%m-%d %H:%M') AS timestamp,
    substring(COALESCE(attachment_name, ''), 1, 24) AS file, status,
    COALESCE(extracted_fields, 0) AS fields,
    CASE WHEN length(rtrim(error_message)) > 50 THEN substring(error_message, 1, 50) || '...'
         ELSE COALESCE(error_message, '') END AS short_error
    FROM ({log}) l ORDER BY log_timestamp DESC, id DESC LIMIT 10"""


# --- R4 ----------------------------------------------------------------------
def common_errors(log: DataFrame, k: int = 5) -> DataFrame:
    g = (log.where((F.col("status") == "rejected") & F.col("error_message").isNotNull())
         .groupBy("error_message").agg(F.count(F.lit(1)).alias("error_count"))
         .orderBy(F.col("error_count").desc(), F.col("error_message")).limit(k))
    e = F.col("error_message")
    return g.select(F.when(F.length(e) > 100, F.concat(F.substring(e, 1, 100), F.lit("...")))
                    .otherwise(e).alias("message"), "error_count")


COMMON_ERRORS_SQL = """SELECT CASE WHEN length(error_message) > 100
      THEN substring(error_message, 1, 100) || '...' ELSE error_message END AS message, error_count
    FROM (SELECT error_message, count(*) AS error_count FROM ({log}) l
          WHERE status = 'rejected' AND error_message IS NOT NULL
          GROUP BY error_message ORDER BY error_count DESC, error_message LIMIT 5) g"""


# --- R5 ----------------------------------------------------------------------
def recent_orders(orders: DataFrame, k: int = 10, key: str = "id") -> DataFrame:
    """The latest ``k`` orders with a BOL number, ties by falling ``key``: a top-k, no global sort.

    The BOL number is whole; the other names are cut to the display's widths.
    """
    top = (orders.where(F.col("bol_number").isNotNull())
           .orderBy(F.col("created_date").desc(), F.col(key).desc()).limit(k))
    w = F.col("total_weight")
    return top.select(
        key,
        F.col("bol_number").alias("bol"),
        F.substring(F.coalesce("shipper_name", F.lit("")), 1, 19).alias("shipper"),
        F.substring(F.coalesce("consignee_name", F.lit("")), 1, 19).alias("consignee"),
        F.substring(F.coalesce("carrier_name", F.lit("")), 1, 14).alias("carrier"),
        F.when((w.isNotNull()) & (w != 0), F.format_number(w, 0)).otherwise(F.lit("")).alias("weight"),
        F.col("total_pieces").alias("pieces"),
        F.date_format("created_date", "MM/dd HH:mm").alias("date"))


RECENT_ORDERS_SQL = """SELECT doc_id, bol_number AS bol,
    substring(COALESCE(shipper_name, ''), 1, 19) AS shipper,
    substring(COALESCE(consignee_name, ''), 1, 19) AS consignee,
    substring(COALESCE(carrier_name, ''), 1, 14) AS carrier,
    CASE WHEN total_weight IS NOT NULL AND total_weight <> 0
         THEN format('{{:,}}', CAST(round(total_weight) AS BIGINT)) ELSE '' END AS weight,
    total_pieces AS pieces, strftime(created_date, '%m/%d %H:%M') AS date
    FROM ({orders}) o WHERE bol_number IS NOT NULL
    ORDER BY created_date DESC, doc_id DESC LIMIT 10"""


# --- R6 / R7 -----------------------------------------------------------------
def _day_stats(g):
    return g.agg(F.count(F.lit(1)).alias("total_processed"),
                 F.count_if(F.col("status") == "processed").alias("successful"),
                 F.count_if(F.col("status") == "rejected").alias("failed"),
                 F.coalesce(F.round(F.avg(F.col("extracted_fields").cast("double")), 1),
                            F.lit(0.0)).alias("avg_fields_extracted"))


def daily_report(log: DataFrame, day=None) -> DataFrame:
    """Stats for one calendar day (default: the day of the latest log row)."""
    d = F.to_date(_as_of(log, None)) if day is None else F.to_date(F.lit(day))
    start, t = d.cast("timestamp_ntz"), F.col("log_timestamp")
    # a range of the raw time, which statistics of files and row groups can tell
    g = _day_stats(log.where((t >= start) & (t < start + F.expr("INTERVAL 1 DAY"))))
    return g.select("*", _rate(F.col("successful"), F.col("total_processed")).alias("success_rate"))


DAY_STATS = """count(*) AS total_processed,
    count(*) FILTER (WHERE status = 'processed') AS successful,
    count(*) FILTER (WHERE status = 'rejected') AS failed,
    COALESCE(round(avg(CAST(extracted_fields AS DOUBLE)), 1), 0.0) AS avg_fields_extracted"""
RATE = """CASE WHEN total_processed > 0 THEN round(100.0 * successful / total_processed, 1)
    ELSE 0.0 END AS success_rate"""

DAILY_REPORT_SQL = f"""SELECT *, {RATE} FROM (SELECT {DAY_STATS} FROM ({{log}}) l
    WHERE CAST(log_timestamp AS DATE) = (SELECT CAST(max(log_timestamp) AS DATE) FROM ({{log}}) m)) g"""


def daily_report_all(log: DataFrame) -> DataFrame:
    """The daily report for every day: one shuffle on the (small) day key."""
    g = _day_stats(log.groupBy(F.to_date("log_timestamp").alias("day")))
    return g.select("*", _rate(F.col("successful"), F.col("total_processed")).alias("success_rate"))


DAILY_REPORT_ALL_SQL = f"""SELECT *, {RATE} FROM (SELECT CAST(log_timestamp AS DATE) AS day, {DAY_STATS}
    FROM ({{log}}) l GROUP BY 1) g"""


# --- R8 ----------------------------------------------------------------------
def report_header(log: DataFrame, generated_at=None) -> DataFrame:
    """The "generated at" stamp of a report, with the log's extent."""
    g = log.agg(F.min("log_timestamp").alias("first_entry"),
                F.max("log_timestamp").alias("last_entry"),
                F.count(F.lit(1)).alias("entries"))
    stamp = F.col("last_entry") if generated_at is None else F.lit(generated_at).cast("timestamp_ntz")
    return g.select(F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("generated_at"),
                    "first_entry", "last_entry", "entries")


REPORT_HEADER_SQL = """SELECT strftime(last_entry, '%Y-%m-%d %H:%M:%S') AS generated_at,
    first_entry, last_entry, entries FROM (SELECT min(log_timestamp) AS first_entry,
    max(log_timestamp) AS last_entry, count(*) AS entries FROM ({log}) l) g"""
