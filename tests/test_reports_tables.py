import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from manifest_spark.operators import reports as Rp
from manifest_spark.sources import tables as Tb

SCHEMA = "id long, attachment_name string, status string, log_timestamp timestamp_ntz, error_message string, extracted_fields int"


def _log(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_empty_log_reports_zeros(spark):
    e = _log(spark, [])
    r = Rp.overall_stats(e).collect()[0]
    assert (r.total_documents, r.successful, r.failed, r.success_rate) == (0, 0, 0, 0.0)


def test_short_error_ignores_trailing_blanks(spark):
    ts = dt.datetime(2024, 1, 1)
    rows = [(1, "a.pdf", "rejected", ts, "x" * 50 + "   ", 0),
            (2, "b.pdf", "rejected", ts, "y" * 51, 0),
            (3, "c.pdf", "rejected", ts, None, None)]
    got = {r.id: r.short_error for r in Rp.recent_activity(_log(spark, rows)).collect()}
    assert got == {1: "x" * 50 + "   ", 2: "y" * 50 + "...", 3: ""}


def test_all_rejected_rate_zero(spark):
    ts = dt.datetime(2024, 1, 1)
    r = Rp.overall_stats(_log(spark, [(1, "a", "rejected", ts, "e", 0)])).collect()[0]
    assert r.success_rate == 0.0


def test_ids_are_unique_over_runs(spark, tmp_path):
    path, schema = str(tmp_path / "t"), T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.LongType()), T.StructField("note", T.StringType())])
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("k"))
    starts = [Tb.append_table(df, path, schema) for _ in range(3)]
    t = spark.read.parquet(path)
    assert t.count() == 3000 and t.select("id").distinct().count() == 3000
    assert starts[0] == 1 and starts == sorted(starts) and t.agg(F.min("id")).first()[0] == 1
    assert t.where(F.col("id") < starts[1]).count() == 1000 and t.columns == ["id", "k", "note"]
    wider = T.StructType([*schema.fields, T.StructField("more", T.IntegerType())])
    assert Tb.ensure_table(spark, path, wider).where("more is null").count() == 3000
    assert Tb.ensure_table(spark, str(tmp_path / "new"), schema).count() == 0


def test_csv_keeps_line_breaks_and_quotes(spark, tmp_path):
    rows = [(1, 'two\nlines, "quoted"'), (2, "plain"), (3, "back\\slash")]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("error_message", T.StringType())])
    path = str(tmp_path / "log")
    Tb.append_csv_log(spark.createDataFrame(rows, schema), path)
    Tb.append_csv_log(spark.createDataFrame([(4, "x\r\ny")], schema), path)
    got = {r.id: r.error_message for r in Tb.read_csv_log(spark, path, schema).collect()}
    assert {k: v for k, v in got.items() if k < 4} == dict(rows) and got[4].split() == ["x", "y"]


def test_long_bol_numbers_stay_whole(spark):
    rows = [(i, "B" * 100 + str(i), dt.datetime(2024, 1, 1)) for i in range(12)]
    orders = spark.createDataFrame(rows, "id long, bol_number string, created_date timestamp_ntz").selectExpr(
        "*", "'s' as shipper_name", "'c' as consignee_name", "'r' as carrier_name", "1.0D as total_weight", "1 as total_pieces")
    got = Rp.recent_orders(orders).collect()
    assert [r.id for r in got] == list(range(11, 1, -1)) and got[0].bol == "B" * 100 + "11"


def test_audit_reads_the_table(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "bol_number string, other string")
    got = {r.column_name: (r.present, r.filled, r.row_count) for r in Tb.schema_audit(df, ("bol_number", "raw_text")).collect()}
    assert got == {"bol_number": (True, 1, 2), "raw_text": (False, None, 2)}


def test_blank_documents_are_empty(spark):
    from manifest_spark.operators import route
    docs = spark.createDataFrame([(1, "\n\t \u2003"), (2, ""), (3, "x")], "doc_id long, text string").selectExpr(
        "doc_id", "'f' as email_from", "'s' as email_subject", "'a.pdf' as attachment_name", "text")
    assert sorted(r.doc_id for r in route.empty_documents(route.process(docs)).collect()) == [1, 2]


def test_ensure_columns_counts_and_defaults(spark):
    df = spark.createDataFrame([(1,)], "id long")
    req = T.StructType([T.StructField("id", T.LongType()), T.StructField("extracted_fields", T.IntegerType()),
                        T.StructField("error_message", T.StringType())])
    out, n = Tb.ensure_columns(df, req, {"extracted_fields": 0})
    assert n == 2
    r = out.collect()[0]
    assert (r.extracted_fields, r.error_message) == (0, None)
    out2, n2 = Tb.ensure_columns(out, req)
    assert n2 == 0
