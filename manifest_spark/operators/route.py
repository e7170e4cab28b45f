"""Validation, accept/reject routing, run accounting and notices.

The target table's insert is the only validator of the system we reproduce:
a value longer than its column width makes the insert fail and the document
is rejected.  Here that is a column expression (first violated width, in
column order), and routing is two filters over one processed DataFrame.
Everything stays a narrow projection except the run summary (a global
two-phase aggregate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import SparkX, SqlX, q
from ..plans.rules import (
    FIELDS,
    LOCAL,
    ORDER_WIDTHS,
    REJECTION_BODY,
    REJECTION_SUBJECT_PREFIX,
    SUCCESS_BODY,
    SUCCESS_SUBJECT,
    RuleSet,
)
from .extract import parse, parse_sql

RUN_TS = "2025-06-11 09:00:00"
REJECTION_RECIPIENT = "rejections@example.com"
NOTICE_RECIPIENT = "operations@example.com"
DOC_COLUMNS = ("doc_id", "email_from", "email_subject", "attachment_name")


def _violation(d):
    """First width violation as a message, NULL when the record fits."""
    return d.coalesce(*[
        d.when([(d.gt(d.length(d.col(c)), d.lit(n)), d.lit(f"value too long for {c}({n})"))])
        for c, n in ORDER_WIDTHS])


def process(docs: DataFrame, rules: RuleSet = LOCAL, run_ts: str = RUN_TS, keep: tuple = ()) -> DataFrame:
    """Parse + validate: one row per document with record, status and log fields, and the columns named by ``keep``.

    Filters on the result stay above the extraction (see ``extract.settled``),
    so that nothing has to be stored for the several sinks that read it.
    """
    d = SparkX()
    docs = docs.withColumn("blank_text", d.is_blank(F.col("text")))
    rec = parse(docs, rules, keep=[*DOC_COLUMNS, "blank_text", *keep])
    ts = F.lit(run_ts).cast("timestamp_ntz")
    v = _violation(d)
    return rec.select(
        "*",
        v.alias("violation"),
    ).select(
        "*",
        F.when(F.col("violation").isNull(), "processed").otherwise("rejected").alias("status"),
        F.coalesce(F.col("violation"), F.lit("")).alias("error_message"),
        F.when(F.col("violation").isNull(), F.col("extracted_fields")).otherwise(0)
        .cast("int").alias("log_fields"),
        F.date_trunc("second", ts).alias("log_timestamp"),
        ts.alias("created_date"),
        ts.alias("updated_date"),
    )


def process_sql(source_sql: str, rules: RuleSet = LOCAL, run_ts: str = RUN_TS) -> str:
    d = SqlX()
    src = f"SELECT *, regexp_full_match(text, {q(chr(92) + 's*')}) AS blank_text FROM ({source_sql}) b"
    rec = parse_sql(src, rules, keep=DOC_COLUMNS + ("blank_text",))
    ts = f"TIMESTAMP {q(run_ts)}"
    return f"""
    SELECT *,
           CASE WHEN violation IS NULL THEN 'processed' ELSE 'rejected' END AS status,
           COALESCE(violation, '') AS error_message,
           CAST(CASE WHEN violation IS NULL THEN extracted_fields ELSE 0 END AS INTEGER) AS log_fields,
           date_trunc('second', {ts}) AS log_timestamp,
           {ts} AS created_date, {ts} AS updated_date
    FROM (SELECT *, {_violation(d)} AS violation FROM ({rec}) r) v"""


# --- V1 / V2 -----------------------------------------------------------------
def validate_widths(p: DataFrame) -> DataFrame:
    return p.select("doc_id", (F.col("violation").isNull()).alias("valid"), "violation")


VALIDATE_WIDTHS_SQL = "SELECT doc_id, violation IS NULL AS valid, violation FROM ({p})"


def status_log(p: DataFrame) -> DataFrame:
    """The log row written for every document, accepted or not."""
    return p.select("doc_id", "email_from", "email_subject", "attachment_name", "status",
                    "log_timestamp", "error_message",
                    F.col("log_fields").alias("extracted_fields"))


STATUS_LOG_SQL = """SELECT doc_id, email_from, email_subject, attachment_name, status,
    log_timestamp, error_message, log_fields AS extracted_fields FROM ({p})"""


# --- V3 ----------------------------------------------------------------------
ORDER_COLUMNS = FIELDS + ("raw_text", "created_date", "updated_date")


def route_accept(p: DataFrame) -> DataFrame:
    return p.where(F.col("status") == "processed").select("doc_id", *ORDER_COLUMNS)


ROUTE_ACCEPT_SQL = ("SELECT doc_id, " + ", ".join(ORDER_COLUMNS)
                    + " FROM ({p}) WHERE status = 'processed'")


def route_reject(p: DataFrame) -> DataFrame:
    return p.where(F.col("status") == "rejected").select(
        "doc_id", "attachment_name", "error_message")


ROUTE_REJECT_SQL = ("SELECT doc_id, attachment_name, error_message FROM ({p}) "
                    "WHERE status = 'rejected'")


# --- V4 ----------------------------------------------------------------------
def run_summary(p: DataFrame) -> DataFrame:
    """processed / successful / failed; a global aggregate is one row even when empty."""
    return p.agg(F.count(F.lit(1)).alias("processed"),
                 F.count_if(F.col("status") == "processed").alias("successful"),
                 F.count_if(F.col("status") == "rejected").alias("failed"))


RUN_SUMMARY_SQL = """SELECT count(*) AS processed,
    count(*) FILTER (WHERE status = 'processed') AS successful,
    count(*) FILTER (WHERE status = 'rejected') AS failed FROM ({p})"""


# --- V5 / V6 -------------------------------------------------------------------
def rejection_outbox(p: DataFrame, recipient: str = REJECTION_RECIPIENT) -> DataFrame:
    """One notice per rejected document, carrying its attachment name."""
    return p.where(F.col("status") == "rejected").select(
        F.lit("rejection").alias("kind"), F.lit(recipient).alias("recipient"),
        F.concat(F.lit(REJECTION_SUBJECT_PREFIX), F.col("email_subject")).alias("subject"),
        F.lit(REJECTION_BODY).alias("body"), "attachment_name", "doc_id")


REJECTION_OUTBOX_SQL = f"""SELECT 'rejection' AS kind, {{recipient}} AS recipient,
    {q(REJECTION_SUBJECT_PREFIX)} || email_subject AS subject, {q(REJECTION_BODY)} AS body,
    attachment_name, doc_id FROM ({{p}}) WHERE status = 'rejected'"""

OK_LINE = "✅ {name}: {n} fields extracted"
FAIL_LINE = "❌ {name}: Processing failed"


def success_outbox(p: DataFrame, recipient: str = NOTICE_RECIPIENT) -> DataFrame:
    """Header of the run's success notice: zero rows unless ≥1 document succeeded.

    The subject counts *processed* documents, failures included.  ``body`` is
    the notice's text around its lines; the lines, which stand at ``{lines}``,
    are a separate table (:func:`success_lines`), so no single group or string
    has to hold the whole run.
    """
    s = run_summary(p)
    return s.where(F.col("successful") > 0).select(
        F.lit("success").alias("kind"), F.lit(recipient).alias("recipient"),
        F.replace(F.lit(SUCCESS_SUBJECT), F.lit("{n}"), F.col("processed").cast("string")).alias("subject"),
        F.replace(F.lit("\n\n".join(SUCCESS_BODY)), F.lit("{n}"), F.col("processed").cast("string")).alias("body"),
        F.col("processed").alias("n_lines"))


SUCCESS_OUTBOX_SQL = """SELECT 'success' AS kind, {recipient} AS recipient,
    'BOL Processing Success - ' || CAST(processed AS VARCHAR) || ' documents processed' AS subject,
    '✅ BOL Automation Success Report' || chr(10) || chr(10) || 'Successfully processed '
    || CAST(processed AS VARCHAR) || ' PDF document(s).' || chr(10) || chr(10) || 'Processing Summary:' || chr(10) || chr(10)
    || chr(123) || 'lines' || chr(125) || chr(10) || chr(10) || 'All data has been inserted into the database and logged.' || chr(10) || chr(10)
    || 'This is an automated message from your BOL processing system.' AS body,
    processed AS n_lines FROM (""" + RUN_SUMMARY_SQL + ") s WHERE successful > 0"


def success_lines(p: DataFrame) -> DataFrame:
    """Body lines of the success notice, one per document, ordered by ``seq``."""
    ok, bad = OK_LINE.split("{name}"), FAIL_LINE.split("{name}")
    ok_tail = ok[1].split("{n}")
    line = F.when(F.col("status") == "processed",
                  F.concat(F.lit(ok[0]), F.col("attachment_name"), F.lit(ok_tail[0]),
                           F.col("log_fields").cast("string"), F.lit(ok_tail[1])))\
        .otherwise(F.concat(F.lit(bad[0]), F.col("attachment_name"), F.lit(bad[1])))
    return p.select(F.col("doc_id").alias("seq"), line.alias("line"))


SUCCESS_LINES_SQL = ("SELECT doc_id AS seq, CASE WHEN status = 'processed' THEN "
                     + q(OK_LINE.split("{name}")[0]) + " || attachment_name || "
                     + q(OK_LINE.split("{name}")[1].split("{n}")[0])
                     + " || CAST(log_fields AS VARCHAR) || "
                     + q(OK_LINE.split("{n}")[1]) + " ELSE "
                     + q(FAIL_LINE.split("{name}")[0]) + " || attachment_name || "
                     + q(FAIL_LINE.split("{name}")[1]) + " END AS line FROM ({p})")


# --- V7 ----------------------------------------------------------------------
def empty_documents(p: DataFrame) -> DataFrame:
    """Documents without text: still processed, every field NULL, 0 fields."""
    return p.where(F.col("blank_text")).select(
        "doc_id", "status", F.col("log_fields").alias("extracted_fields"))


EMPTY_DOCUMENTS_SQL = """SELECT doc_id, status, log_fields AS extracted_fields FROM ({p})
    WHERE blank_text"""
