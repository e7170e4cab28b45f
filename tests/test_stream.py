import os
import tempfile

from conftest import SF_SMALL
from manifest_spark.operators import reports as Rp
from manifest_spark.registry import QUERIES
from manifest_spark.sources.ingest import render_message
from manifest_spark.streaming import stream as St


def _write(d, i, text):
    with open(os.path.join(d, f"m{i}.eml"), "wb") as f:
        f.write(render_message(i, f"u{i}@example.com", f"Load {i}", f"doc_{i}.pdf", text.encode()))


def test_stream_ingest_processes_only_new_files(spark):
    base = tempfile.mkdtemp(prefix="st1-", dir="/tmp")
    land, out, ck = (os.path.join(base, x) for x in ("landing", "out", "ckpt"))
    os.makedirs(land)
    _write(land, 0, "Load ID: 12345678\nWeight: 5,000 lbs")
    _write(land, 2, "Load ID: " + "9" * 120)
    St.start_ingest(spark, land, out, ck).awaitTermination()
    log1 = spark.read.parquet(os.path.join(out, "order_log"))
    assert log1.count() == 2
    assert spark.read.parquet(os.path.join(out, "orders")).count() == 1
    assert spark.read.parquet(os.path.join(out, "outbox")).count() == 1
    _write(land, 4, "Order: 5-01")
    St.start_ingest(spark, land, out, ck).awaitTermination()
    log2 = spark.read.parquet(os.path.join(out, "order_log"))
    assert log2.count() == 3
    assert sorted(r.batch_id for r in log2.select("batch_id").distinct().collect()) == [0, 1]
    assert spark.read.parquet(os.path.join(out, "order_log")).select("id").distinct().count() == 3
    assert spark.read.parquet(os.path.join(out, "notices")).count() == 2
    assert spark.read.parquet(os.path.join(out, "notice_lines")).count() == 3
    # a restart with nothing new adds nothing
    St.start_ingest(spark, land, out, ck).awaitTermination()
    assert spark.read.parquet(os.path.join(out, "order_log")).count() == 3


def test_stream_daily_report_equals_batch(spark):
    s = {tuple(r) for r in QUERIES["stream_daily_report"](spark, SF_SMALL)
         .select("day", "total_processed", "successful", "failed", "avg_fields_extracted", "success_rate").collect()}
    b = {tuple(r) for r in Rp.daily_report_all(Rp.process_log_from_events(spark, SF_SMALL))
         .select("day", "total_processed", "successful", "failed", "avg_fields_extracted", "success_rate").collect()}
    assert s == b


def test_late_rows_and_folder_tables_are_counted(spark, tmp_path):
    """Four files of a folder-shaped table, the newest days first."""
    sf, events = str(tmp_path / "sf"), spark.read.parquet(SF_SMALL + "/events.parquet")
    parts = events.orderBy(events.ts.desc()).toPandas()
    for k in range(4):
        piece = spark.createDataFrame(parts.iloc[k * 250:(k + 1) * 250], events.schema).coalesce(1)
        piece.write.mode("append").parquet(sf + "/events.parquet")
    got = QUERIES["stream_daily_report"](spark, sf)
    assert got.count() == 30 and got.groupBy().sum("total_processed").first()[0] == events.count()


def test_empty_stream_gives_an_empty_report(spark, tmp_path):
    sf = str(tmp_path / "sf")
    spark.read.parquet(SF_SMALL + "/events.parquet").limit(0).write.parquet(sf + "/events.parquet")
    assert QUERIES["stream_daily_report"](spark, sf).count() == 0
