"""Named queries over a data-set folder, with their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)``, reads the given tables (or data Spark
derives from them) and returns a DataFrame; ``ORACLE`` holds the equivalent
DuckDB SQL over the same tables.  Column names match between the two.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.dialect import SparkX, SqlX, q
from .functions import regex as rx
from .operators import coverage as D
from .operators import hitters as H
from .operators import names as N
from .operators import partials as Pt
from .operators import reports as Rp
from .operators import route as V
from .operators.extract import parse, parse_sql, settled, staged, with_words
from .plans import rules as R
from .plans.fixtures import document_text, document_text_sql
from .plans.rules import CLOUD, FIELDS, LOCAL, catalog_rows
from .session import ensure_checkpoint_dir
from .sources import ingest as S
from .sources import loads as Ld
from .sources import tables as Tb

DOCS = document_text_sql()
RECORDS = parse_sql(DOCS, LOCAL)
PROCESSED = V.process_sql(DOCS, LOCAL)
LOG = Rp.PROCESS_LOG_SQL

QUERIES: dict = {}
ORACLE: dict = {}


def query(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{tag}-{uuid.uuid4().hex}")


def _docs(spark, sf):
    return document_text(spark, sf)


def _records(spark, sf, rules=LOCAL):
    return parse(_docs(spark, sf), rules, keep=["doc_id"])


def _processed(spark, sf):
    return V.process(_docs(spark, sf), LOCAL)


def _log(spark, sf):
    return Rp.process_log_from_events(spark, sf)


# ---- P: field extraction --------------------------------------------------------
ALL_COLS = ("doc_id",) + FIELDS + ("raw_text", "extracted_fields")


@query("parse_all", f"SELECT {', '.join(ALL_COLS)} FROM ({RECORDS})")
def parse_all(spark, sf):
    return _records(spark, sf).select(*ALL_COLS)


def _field_query(name, cols):
    sel = ("doc_id",) + cols

    def fn(spark, sf):
        known = tuple(c for c in cols if c in FIELDS)
        return parse(_docs(spark, sf), LOCAL, keep=["doc_id"], fields=known or FIELDS).select(*sel)
    QUERIES[name] = fn
    ORACLE[name] = f"SELECT {', '.join(sel)} FROM ({RECORDS})"


_field_query("parse_bol_number", ("bol_number",))
_field_query("parse_shipper", ("shipper_name", "shipper_address"))
_field_query("parse_consignee", ("consignee_name", "consignee_address"))
_field_query("parse_carrier", ("carrier_name",))
_field_query("assign_dates", ("shipment_date", "delivery_date"))
_field_query("parse_weight", ("total_weight",))
_field_query("parse_pieces", ("total_pieces",))
_field_query("parse_freight", ("freight_charges",))
_field_query("parse_cities", ("origin_city", "destination_city"))
_field_query("parse_commodity", ("commodity_description",))
_field_query("parse_reference", ("reference_number",))
_field_query("extracted_fields", ("extracted_fields",))


@query("parse_shipper_site",
       f"SELECT r.doc_id, shipper_name, shipper_address FROM ({RECORDS}) r JOIN ({DOCS}) d "
       f"ON r.doc_id = d.doc_id WHERE strpos(d.text, {q(R.SITE_NAME)}) > 0")
def parse_shipper_site(spark, sf):
    docs = _docs(spark, sf).where(F.instr("text", R.SITE_NAME) > 0)
    return parse(docs, LOCAL, keep=["doc_id"], fields=("shipper_name", "shipper_address")).select(
        "doc_id", "shipper_name", "shipper_address")


@query("raw_text", f"SELECT doc_id, raw_text, CAST(length(raw_text) AS INTEGER) AS raw_chars FROM ({RECORDS})")
def raw_text(spark, sf):
    raw = F.substring("text", 1, LOCAL.raw_text_chars)
    return _docs(spark, sf).select("doc_id", raw.alias("raw_text"), F.length(raw).alias("raw_chars"))


def _dates(d, rs=LOCAL):
    return d.concat_arrays(*[d.rx_all(d.col("text"), p, 1) for p in rs.dates])


_sx, _qx = SparkX(), SqlX()


@query("find_dates", f"SELECT doc_id, CAST(len(a) AS INTEGER) AS n_dates, array_to_string(a, '|') AS dates "
                     f"FROM (SELECT doc_id, {_dates(_qx)} AS a FROM ({DOCS}) s) x")
def find_dates(spark, sf):
    a = _dates(_sx)
    return _docs(spark, sf).select("doc_id", F.size(a).alias("n_dates"), F.array_join(a, "|").alias("dates"))


@query("single_date_context",
       f"SELECT r.doc_id, shipment_date, delivery_date FROM ({RECORDS}) r JOIN ({DOCS}) d "
       f"ON r.doc_id = d.doc_id WHERE len({_dates(_qx)}) = 1")
def single_date_context(spark, sf):
    found = parse(_docs(spark, sf), LOCAL, keep=["doc_id"], fields=("shipment_date", "delivery_date"), extra=("_ndates",))
    return found.where("ndates = 1").select("doc_id", "shipment_date", "delivery_date")


@query("parse_cloud", f"SELECT {', '.join(ALL_COLS)} FROM ({parse_sql(DOCS, CLOUD)})")
def parse_cloud(spark, sf):
    return _records(spark, sf, CLOUD).select(*ALL_COLS)


# names of parties as tables: as registered, and as they stand on the paper; many hold each other ("Customer 1", "Customer 12")
NAMES_SQL = ("SELECT s_name AS name FROM supplier UNION SELECT 'Supplier ' || CAST(s_suppkey AS VARCHAR) FROM supplier "
             "UNION SELECT c_name FROM customer UNION SELECT 'Customer ' || CAST(c_custkey AS VARCHAR) FROM customer")
NAMED_SQL = (f"SELECT doc_id, name, CAST(strpos(text, name) AS INTEGER) AS place FROM ({DOCS}) d, ({NAMES_SQL}) n "
             "WHERE strpos(text, name) > 0")


def _names(spark, sf):
    s, c = Tb.read_table(spark, sf, "supplier"), Tb.read_table(spark, sf, "customer")
    each = (s.select(F.col("s_name").alias("name")), s.select(F.concat(F.lit("Supplier "), F.col("s_suppkey").cast("string")).alias("name")),
            c.select(F.col("c_name").alias("name")), c.select(F.concat(F.lit("Customer "), F.col("c_custkey").cast("string")).alias("name")))
    return each[0].union(each[1]).union(each[2]).union(each[3]).distinct()


@query("names_in_documents", NAMED_SQL)
def names_in_documents(spark, sf):
    """Where each supplier's and customer's name stands in each document."""
    return N.find_names(_docs(spark, sf), _names(spark, sf))


@query("names_in_documents_joined", NAMED_SQL)
def names_in_documents_joined(spark, sf):
    """The same by the way of lists too long for an automaton."""
    return N.by_join(_docs(spark, sf), _names(spark, sf))


_SITE_A = [SqlX().rx("text", R.SITE_ADDRESS, g) for g in (1, 2)]


@query("parse_listed_sites",
       f"SELECT d.doc_id, s.site_id, s.name AS shipper_name, CASE WHEN {_SITE_A[0]} <> '' THEN "
       f"{SqlX().strip(_SITE_A[0])} || ', ' || {SqlX().strip(_SITE_A[1])} END AS shipper_address FROM ({DOCS}) d JOIN ("
       f"SELECT n.doc_id, min(p.s_suppkey) AS site_id FROM ({DOCS}) n, supplier p WHERE strpos(n.text, p.s_name) > 0 GROUP BY n.doc_id) f "
       f"ON d.doc_id = f.doc_id JOIN (SELECT s_suppkey AS site_id, s_name AS name FROM supplier) s ON s.site_id = f.site_id")
def parse_listed_sites(spark, sf):
    """The shipper of documents that name a site of a table of sites."""
    sites = Tb.read_table(spark, sf, "supplier").select(F.col("s_suppkey").alias("site_id"), F.col("s_name").alias("name"))
    return N.site_parties(_docs(spark, sf), sites)


def _diff_count(d, a_prefix, b_prefix):
    return d.add(*[d.to_int(d.not_(f"({a_prefix}{f} IS NOT DISTINCT FROM {b_prefix}{f})"))
                   if d.name == "duckdb" else
                   (~F.col(a_prefix + f).eqNullSafe(F.col(b_prefix + f))).cast("int")
                   for f in FIELDS])


@query("parse_all_documents", f"SELECT {', '.join(ALL_COLS)} FROM ({parse_sql('SELECT doc_id, text FROM documents', LOCAL)})")
def parse_all_documents(spark, sf):
    """The rules over real prose: long texts in several languages, few of them bills."""
    docs = Tb.read_table(spark, sf, "documents").select("doc_id", "text")
    return parse(docs, LOCAL, keep=["doc_id"]).select(*ALL_COLS)


@query("rule_set_diff",
       "SELECT l.doc_id, " + _diff_count(_qx, "l.", "c.") + " AS n_diff FROM (" + RECORDS
       + ") l JOIN (" + parse_sql(DOCS, CLOUD) + ") c ON l.doc_id = c.doc_id")
def rule_set_diff(spark, sf):
    """Both rule sets over one pass: steps and patterns that both have are evaluated once (no join, no shuffle)."""
    from .plans import extract as pe
    cur, d = with_words(_docs(spark, sf).select("doc_id", "text"), [p for rules in (LOCAL, CLOUD) for _, p in pe.steps(rules)])
    shared = pe.Shared(LOCAL, CLOUD)
    for rules, prefix in ((LOCAL, "l_"), (CLOUD, "c_")):
        plan = pe.build(d, rules, "text", prefix, shared=shared)
        cur = settled(staged(cur, plan), [e.alias(a) for a, e in plan.final])
    return cur.select("doc_id", _diff_count(_sx, "l_", "c_").alias("n_diff"))


@query("batch_parse_summary",
       f"SELECT r.doc_id, d.attachment_name, COALESCE(r.extracted_fields, 0) AS extracted_fields "
       f"FROM ({RECORDS}) r JOIN ({DOCS}) d ON r.doc_id = d.doc_id")
def batch_parse_summary(spark, sf):
    return parse(_docs(spark, sf), LOCAL, keep=["doc_id", "attachment_name"]).select(
        "doc_id", "attachment_name", F.coalesce("extracted_fields", F.lit(0)).alias("extracted_fields"))


def _catalog():
    rows = []
    for rs in (LOCAL, CLOUD):
        for r in catalog_rows(rs):
            rows.append(r)
    return rows


def _catalog_hit(d, row, text):
    rule_set, field, prio, pattern, stop = row
    if stop.startswith("contains:"):
        return d.contains(text, pattern)
    return d.rx_test(text, pattern)


@query("rule_catalog", " UNION ALL ".join(
    f"SELECT {q(r[0])} AS rule_set, {q(r[1])} AS field, {r[2]} AS priority, {q(r[3])} AS pattern, "
    f"{q(r[4])} AS stop_rule, count(*) FILTER (WHERE {_catalog_hit(_qx, r, 'text')}) AS docs_hit "
    f"FROM ({DOCS}) s" for r in _catalog()))
def rule_catalog(spark, sf):
    """Every rule of both rule sets with the number of documents it matches."""
    rows = _catalog()
    patterns = [r[3] for r in rows if not r[4].startswith("contains:")]
    cur, d = with_words(_docs(spark, sf).select("text"), patterns)
    # a pattern of several rules and rule sets is tried once a text, and only where its words stand
    names = {p: f"_t{i}" for i, p in enumerate(dict.fromkeys(patterns))}
    cur = settled(cur, [d.rx_test_guarded(F.col("text"), p).alias(name) for p, name in names.items()])
    hits = cur.agg(*[F.count_if(F.col(names[r[3]]) if r[3] in names else _catalog_hit(_sx, r, F.col("text"))).alias(f"h{i}")
                     for i, r in enumerate(rows)])
    arr = F.array(*[F.struct(F.lit(r[0]).alias("rule_set"), F.lit(r[1]).alias("field"),
                             F.lit(r[2]).alias("priority"), F.lit(r[3]).alias("pattern"),
                             F.lit(r[4]).alias("stop_rule"), F.col(f"h{i}").alias("docs_hit"))
                    for i, r in enumerate(rows)])
    return hits.select(F.inline(arr))


# ---- V: validation, routing, notices ------------------------------------------------
for _name, _fn, _sql in (
        ("validate_widths", V.validate_widths, V.VALIDATE_WIDTHS_SQL),
        ("status_log", V.status_log, V.STATUS_LOG_SQL),
        ("route_accept", V.route_accept, V.ROUTE_ACCEPT_SQL),
        ("route_reject", V.route_reject, V.ROUTE_REJECT_SQL),
        ("run_summary", V.run_summary, V.RUN_SUMMARY_SQL),
        ("success_lines", V.success_lines, V.SUCCESS_LINES_SQL),
        ("empty_documents", V.empty_documents, V.EMPTY_DOCUMENTS_SQL)):
    QUERIES[_name] = (lambda fn: lambda spark, sf: fn(_processed(spark, sf)))(_fn)
    ORACLE[_name] = _sql.format(p=PROCESSED)

QUERIES["rejection_outbox"] = lambda spark, sf: V.rejection_outbox(_processed(spark, sf))
ORACLE["rejection_outbox"] = V.REJECTION_OUTBOX_SQL.format(p=PROCESSED, recipient=q(V.REJECTION_RECIPIENT))
QUERIES["success_outbox"] = lambda spark, sf: V.success_outbox(_processed(spark, sf))
ORACLE["success_outbox"] = V.SUCCESS_OUTBOX_SQL.format(p=PROCESSED, recipient=q(V.NOTICE_RECIPIENT))


# ---- S: sources, sinks, schema ------------------------------------------------------
@query("document_text", S.DOCUMENT_TEXT_SQL.format(pages=S.PAGES_SQL))
def document_text_q(spark, sf):
    return S.document_text(S.pages_from_conversations(spark, sf))


@query("ingest_messages",
       f"SELECT 'msg_' || CAST(doc_id AS VARCHAR) || '.eml' AS path, 2 AS part_no, email_from, email_subject, "
       f"CASE WHEN doc_id % 4 = 2 THEN substring(attachment_name, 1, length(attachment_name) - 4) || '.PDF' "
       f"ELSE attachment_name END AS attachment_name, text FROM ({DOCS}) d")
def ingest_messages(spark, sf):
    msgs = S.messages_from_documents(_docs(spark, sf))
    att = S.pdf_attachments(msgs)
    return att.select("path", "part_no", "email_from", "email_subject", "attachment_name",
                      F.col("content").cast("string").alias("text"))


ORDER_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("doc_id", T.LongType())]
    + [T.StructField(f, {"total_weight": T.DoubleType(), "freight_charges": T.DoubleType(),
                         "total_pieces": T.IntegerType()}.get(f, T.StringType())) for f in FIELDS]
    + [T.StructField("raw_text", T.StringType()), T.StructField("created_date", T.TimestampNTZType()),
       T.StructField("updated_date", T.TimestampNTZType())])
ORDER_LOG_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("email_from", T.StringType()),
    T.StructField("email_subject", T.StringType()), T.StructField("attachment_name", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("log_timestamp", T.TimestampNTZType()),
    T.StructField("error_message", T.StringType()), T.StructField("extracted_fields", T.IntegerType())])


def _loaded(spark, sf, sink, schema, tag):
    """Two runs (even and odd documents) appended to one new table, read back with the run that each id tells."""
    path = _scratch(spark, tag)
    docs = _docs(spark, sf)
    for rest in (0, 1):
        start = Tb.append_table(sink(V.process(docs.where(F.coalesce(F.pmod("doc_id", F.lit(2)), F.lit(0)) == rest), LOCAL)), path, schema)
    return spark.read.schema(schema).parquet(path).withColumn("run", F.when(F.col("id") < start, 1).otherwise(2))


def _run_sql(sql, columns):
    return f"SELECT {', '.join(columns)}, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 2 END AS run FROM ({sql}) t"


ORDER_NAMES = [f.name for f in ORDER_SCHEMA.fields if f.name != "id"]
LOG_NAMES = [f.name for f in ORDER_LOG_SCHEMA.fields if f.name != "id"]


@query("load_orders", _run_sql(V.ROUTE_ACCEPT_SQL.format(p=PROCESSED), ORDER_NAMES))
def load_orders(spark, sf):
    """All 18 order columns of two runs, appended to a table and read back; ids tell the runs apart."""
    return _loaded(spark, sf, V.route_accept, ORDER_SCHEMA, "orders").select(*ORDER_NAMES, "run")


@query("load_log", _run_sql(V.STATUS_LOG_SQL.format(p=PROCESSED), LOG_NAMES))
def load_log(spark, sf):
    return _loaded(spark, sf, V.status_log, ORDER_LOG_SCHEMA, "order-log").select(*LOG_NAMES, "run")


def _runs(spark, sf, tag):
    """The processed documents of two runs (even and odd documents), each parsed once and stored: loads sort and repeat them."""
    docs, runs = _docs(spark, sf), []
    for rest in (0, 1):
        done = V.process(docs.where(F.coalesce(F.pmod("doc_id", F.lit(2)), F.lit(0)) == rest), LOCAL)
        path = _scratch(spark, f"{tag}-processed-{rest}")
        done.write.parquet(path)
        runs.append(spark.read.schema(done.schema).parquet(path))
    return runs


def _rerun(spark, runs, sink, schema, tag):
    """Two runs into one table; the second died once before its commit, and both are repeated."""
    path = _scratch(spark, tag)
    rows = {f"run-{rest}": sink(done) for rest, done in enumerate(runs)}
    Ld.load(rows["run-0"], path, schema, "run-0", ["doc_id"])
    Ld.stage(rows["run-1"], path, schema, "run-1", ["doc_id"], 1)  # staged, but never committed
    for run in ("run-1", "run-0", "run-1"):
        Ld.load(rows[run], path, schema, run, ["doc_id"])
    return Ld.read(spark, path, schema)


def _rerun_sql(sql, columns):
    return (f"SELECT row_number() OVER (ORDER BY doc_id % 2, doc_id) AS id, {', '.join(columns)}, "
            f"'run-' || CAST(doc_id % 2 AS VARCHAR) AS run_id FROM ({sql}) t")


@query("rerun_load_orders", _rerun_sql(V.ROUTE_ACCEPT_SQL.format(p=PROCESSED), ORDER_NAMES))
def rerun_load_orders(spark, sf):
    """All order columns and dense ids of two runs, one of them killed and repeated."""
    return _rerun(spark, _runs(spark, sf, "orders-again"), V.route_accept, ORDER_SCHEMA, "orders-again")


@query("rerun_load_log", _rerun_sql(V.STATUS_LOG_SQL.format(p=PROCESSED), LOG_NAMES))
def rerun_load_log(spark, sf):
    return _rerun(spark, _runs(spark, sf, "order-log-again"), V.status_log, ORDER_LOG_SCHEMA, "order-log-again")


@query("dense_ids", f"SELECT id AS event_id, status, 1000 + row_number() OVER (ORDER BY id) AS id FROM ({LOG}) l")
def dense_ids_q(spark, sf):
    """Ids without gaps over the whole log, in the order of its events."""
    log = _log(spark, sf).select(F.col("id").alias("event_id"), "status")
    return Ld.dense_ids(log, ["event_id"], 1001, _scratch(spark, "dense-ids")).select("event_id", "status", "id")


@query("table_row_counts", "SELECT 'orders' AS table_name, run_id, count(*) AS row_count FROM ("
       + _rerun_sql(V.ROUTE_ACCEPT_SQL.format(p=PROCESSED), ("doc_id",)) + ") o GROUP BY run_id UNION ALL SELECT 'order_log', run_id, count(*) FROM ("
       + _rerun_sql(V.STATUS_LOG_SQL.format(p=PROCESSED), ("doc_id",)) + ") l GROUP BY run_id")
def table_row_counts(spark, sf):
    """Rows of the loaded tables by run, counted in the tables."""
    runs = _runs(spark, sf, "counted")
    counts = [_rerun(spark, runs, sink, schema, tag).groupBy("run_id").agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "run_id", "row_count")
              for name, sink, schema, tag in (("orders", V.route_accept, ORDER_SCHEMA, "orders-counted"),
                                              ("order_log", V.status_log, ORDER_LOG_SCHEMA, "log-counted"))]
    return counts[0].unionByName(counts[1])


@query("assign_ids", f"SELECT count(*) AS row_count, count(*) AS distinct_ids, TRUE AS from_start FROM ({LOG}) l")
def assign_ids_q(spark, sf):
    ids = Tb.assign_ids(_log(spark, sf).select("status"), 1001)
    return ids.agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("id").alias("distinct_ids"),
                   (F.min("id") >= 1001).alias("from_start"))


LOG_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("email_from", T.StringType()),
    T.StructField("email_subject", T.StringType()), T.StructField("attachment_name", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("log_timestamp", T.TimestampNTZType()),
    T.StructField("error_message", T.StringType()), T.StructField("extracted_fields", T.IntegerType())])


def _csv_round_trip(spark, sf):
    path = _scratch(spark, "csv-log")
    Tb.append_csv_log(_log(spark, sf), path)
    return Tb.read_csv_log(spark, path, LOG_SCHEMA)


@query("csv_log", f"SELECT id, status, log_timestamp, COALESCE(error_message, '') AS error_message, "
                  f"extracted_fields FROM ({LOG}) l")
def csv_log(spark, sf):
    # CSV has no NULL/empty distinction for strings: '' reads back as NULL
    return _csv_round_trip(spark, sf).select("id", "status", "log_timestamp",
                                             F.coalesce("error_message", F.lit("")).alias("error_message"),
                                             "extracted_fields")


@query("tail_csv_log", f"SELECT id, status, log_timestamp FROM ({LOG}) l ORDER BY log_timestamp DESC, id DESC LIMIT 10")
def tail_csv_log(spark, sf):
    return (_csv_round_trip(spark, sf).orderBy(F.col("log_timestamp").desc(), F.col("id").desc())
            .limit(10).select("id", "status", "log_timestamp"))


@query("ensure_columns", f"SELECT id, status, CAST(NULL AS VARCHAR) AS error_message, 0 AS extracted_fields, "
                         f"2 AS columns_added FROM ({LOG}) l")
def ensure_columns_q(spark, sf):
    old = _log(spark, sf).drop("error_message", "extracted_fields")
    new, added = Tb.ensure_columns(old, LOG_SCHEMA, {"extracted_fields": 0})
    return new.select("id", "status", "error_message", "extracted_fields", F.lit(added).alias("columns_added"))


@query("column_defaults", f"SELECT id, CAST(CASE WHEN status = 'rejected' THEN 0 ELSE extracted_fields END AS INTEGER) "
                          f"AS extracted_fields, TIMESTAMP {q(V.RUN_TS)} AS created_date FROM ({LOG}) l")
def column_defaults(spark, sf):
    log = _log(spark, sf).select(
        "id", F.when(F.col("status") == "rejected", F.lit(None)).otherwise(F.col("extracted_fields"))
        .cast("int").alias("extracted_fields"), F.lit(None).cast("timestamp_ntz").alias("created_date"))
    return Tb.apply_defaults(log, {"extracted_fields": 0, "created_date": V.RUN_TS})


_ACCEPTED = V.ROUTE_ACCEPT_SQL.format(p=PROCESSED)


@query("schema_audit", "SELECT unnest([" + ", ".join(q(c) for c in R.SCHEMA_AUDIT_COLUMNS) + "]) AS column_name, TRUE AS present, unnest(["
       + ", ".join(f"count({c})" for c in R.SCHEMA_AUDIT_COLUMNS) + f"]) AS filled, count(*) AS row_count FROM ({_ACCEPTED}) o")
def schema_audit(spark, sf):
    """The audited columns of a loaded orders table, with how many of its rows fill them."""
    path = _scratch(spark, "audited")
    Tb.append_table(V.route_accept(_processed(spark, sf)), path, ORDER_SCHEMA)
    return Tb.schema_audit(spark.read.parquet(path), R.SCHEMA_AUDIT_COLUMNS)


@query("table_counts", f"SELECT 'orders' AS table_name, count(*) AS row_count FROM ("
       + V.ROUTE_ACCEPT_SQL.format(p=PROCESSED) + ") o UNION ALL SELECT 'order_log', count(*) FROM ("
       + V.STATUS_LOG_SQL.format(p=PROCESSED) + ") l")
def table_counts(spark, sf):
    """Rows of both tables of a run: one pass over the processed documents."""
    counts = V.run_summary(_processed(spark, sf))
    row = lambda name, n: F.struct(F.lit(name).alias("table_name"), F.col(n).alias("row_count"))
    return counts.select(F.inline(F.array(row("orders", "successful"), row("order_log", "processed"))))


# ---- R: reports --------------------------------------------------------------------
for _name, _fn, _sql in (
        ("overall_stats", Rp.overall_stats, Rp.OVERALL_STATS_SQL),
        ("last_7_days", Rp.last_7_days, Rp.LAST_7_DAYS_SQL),
        ("recent_activity", Rp.recent_activity, Rp.RECENT_ACTIVITY_SQL),
        ("common_errors", Rp.common_errors, Rp.COMMON_ERRORS_SQL),
        ("daily_report", Rp.daily_report, Rp.DAILY_REPORT_SQL),
        ("daily_report_all", Rp.daily_report_all, Rp.DAILY_REPORT_ALL_SQL),
        ("report_header", Rp.report_header, Rp.REPORT_HEADER_SQL)):
    QUERIES[_name] = (lambda fn: lambda spark, sf: fn(_log(spark, sf)))(_fn)
    ORACLE[_name] = _sql.format(log=LOG)


def _kept(spark, sf):
    """The log kept by day, in two batches that share days."""
    path, log = _scratch(spark, "kept-log"), _log(spark, sf)
    for rest in (0, 1):
        Pt.keep(log.where(F.pmod("id", F.lit(2)) == rest), path)
    return path


@query("kept_daily_report", Rp.DAILY_REPORT_SQL.format(log=LOG))
def kept_daily_report(spark, sf):
    return Pt.daily_report(spark, _kept(spark, sf))


@query("kept_daily_report_all", Rp.DAILY_REPORT_ALL_SQL.format(log=LOG))
def kept_daily_report_all(spark, sf):
    return Pt.daily_report_all(spark, _kept(spark, sf))


@query("kept_last_7_days", Rp.LAST_7_DAYS_SQL.format(log=LOG))
def kept_last_7_days(spark, sf):
    return Pt.last_days(spark, _kept(spark, sf))


@query("frequent_errors", Rp.COMMON_ERRORS_SQL.format(log=LOG))
def frequent_errors(spark, sf):
    """The commonest error messages, found by summaries of hashes."""
    errors = _log(spark, sf).where(F.col("status") == "rejected").select("error_message")
    e = F.col("error_message")
    return H.most_frequent(errors, 5, "error_message").select(
        F.when(F.length(e) > 100, F.concat(F.substring(e, 1, 100), F.lit("..."))).otherwise(e).alias("message"), F.col("n").alias("error_count"))


@query("frequent_lines",
       "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) l WHERE line <> '' "
       "GROUP BY line ORDER BY n DESC, line LIMIT 20")
def frequent_lines(spark, sf):
    """The lines that stand most often in all documents."""
    lines = _documents(spark, sf).select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    return H.most_frequent(lines, 20, "line")


@query("recent_orders", Rp.RECENT_ORDERS_SQL.format(orders=V.ROUTE_ACCEPT_SQL.format(p=PROCESSED)))
def recent_orders(spark, sf):
    return Rp.recent_orders(V.route_accept(_processed(spark, sf)), key="doc_id")


# ---- D: rule-coverage analytics -----------------------------------------------------
DOCUMENTS = "SELECT doc_id, text FROM documents"


def _documents(spark, sf):
    return Tb.read_table(spark, sf, "documents").select("doc_id", "text")


QUERIES["pattern_matches"] = lambda spark, sf: D.pattern_matches(_docs(spark, sf))
ORACLE["pattern_matches"] = D.pattern_matches_sql(DOCS)
QUERIES["pattern_coverage"] = lambda spark, sf: D.pattern_coverage(_docs(spark, sf))
ORACLE["pattern_coverage"] = D.pattern_coverage_sql(DOCS)
QUERIES["pattern_coverage_documents"] = lambda spark, sf: D.pattern_coverage(_documents(spark, sf))
ORACLE["pattern_coverage_documents"] = D.pattern_coverage_sql(DOCUMENTS)
QUERIES["address_pairs"] = lambda spark, sf: D.address_pairs(_docs(spark, sf))
ORACLE["address_pairs"] = D.address_pairs_sql(DOCS)
QUERIES["date_format_census"] = lambda spark, sf: D.date_format_census(_docs(spark, sf))
ORACLE["date_format_census"] = D.date_format_census_sql(DOCS)
QUERIES["candidate_fields"] = lambda spark, sf: D.candidate_fields(_docs(spark, sf))
ORACLE["candidate_fields"] = D.candidate_fields_sql(DOCS)
QUERIES["keyword_census"] = lambda spark, sf: D.keyword_census(_docs(spark, sf))
ORACLE["keyword_census"] = D.keyword_census_sql(DOCS)
QUERIES["keyword_census_documents"] = lambda spark, sf: D.keyword_census(_documents(spark, sf))
ORACLE["keyword_census_documents"] = D.keyword_census_sql(DOCUMENTS)
QUERIES["page_profile"] = lambda spark, sf: D.page_profile(S.pages_from_conversations(spark, sf))
ORACLE["page_profile"] = D.PAGE_PROFILE_SQL.format(pages=S.PAGES_SQL)
QUERIES["text_preview"] = lambda spark, sf: D.text_preview(_documents(spark, sf))
ORACLE["text_preview"] = D.TEXT_PREVIEW_SQL.format(src=DOCUMENTS)
QUERIES["field_fill"] = lambda spark, sf: D.field_fill(_processed(spark, sf))
ORACLE["field_fill"] = D.field_fill_sql(RECORDS)
QUERIES["rule_attribution"] = lambda spark, sf: D.rule_attribution(_docs(spark, sf))
ORACLE["rule_attribution"] = D.rule_attribution_sql(DOCS)


# ---- ST: streaming --------------------------------------------------------------------
@query("stream_daily_report", Rp.DAILY_REPORT_ALL_SQL.format(log=LOG))
def stream_daily_report(spark, sf):
    """The daily report computed by a streaming aggregate over the files of ``events``, in any order."""
    from .streaming import stream as St
    ev_schema = Tb.read_table(spark, sf, "events").schema
    # a table is a file or a folder of files
    ev = spark.readStream.schema(ev_schema).parquet(os.path.join(sf, "events.parquet*"))
    err = F.col("event_type") == "error"
    log = ev.select(
        F.date_trunc("second", F.col("ts")).cast("timestamp").alias("log_timestamp"),
        F.when(err, "rejected").otherwise("processed").alias("status"),
        F.when(err, F.lit(0)).otherwise((F.floor(F.col("value")) % 16).cast("int")).alias("extracted_fields"))
    out = _scratch(spark, "daily")
    q_ = St.start_daily_report(spark, log, out, _scratch(spark, "daily-ckpt"))
    q_.awaitTermination()
    return St.read_daily_report(spark, out)


@query("ingest_once",
       "SELECT email_from, email_subject, CASE WHEN doc_id % 4 = 2 THEN substring(attachment_name, 1, length(attachment_name) - 4) || '.PDF' "
       f"ELSE attachment_name END AS attachment_name, status, error_message, extracted_fields FROM ({V.STATUS_LOG_SQL.format(p=PROCESSED)}) l")
def ingest_once(spark, sf):
    """From stored messages to the log by a stream; each message is delivered twice, the second time over a relay."""
    from .streaming import stream as St
    inbox, out = _scratch(spark, "inbox"), _scratch(spark, "ingested")
    messages = S.messages_from_documents(_docs(spark, sf))
    messages.write.parquet(inbox)
    again = spark.read.parquet(inbox).select(F.concat(F.lit("again_"), "path").alias("path"),
                                             F.concat(F.encode(F.lit("Received: by relay\n"), "UTF-8"), F.col("content")).alias("content"))
    again.write.mode("append").parquet(inbox)
    stored = spark.read.parquet(inbox)
    files = len(stored.inputFiles())
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", max(1, -(-files // 3))).parquet(inbox)
    St.ingest_stream(stream, out, _scratch(spark, "ingested-progress"), run_ts=V.RUN_TS).awaitTermination()
    return spark.read.parquet(os.path.join(out, "order_log")).select(
        "email_from", "email_subject", "attachment_name", "status", "error_message", "extracted_fields")
