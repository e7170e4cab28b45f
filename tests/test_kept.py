"""Daily partials, frequent texts, loads that can be run again, dense ids, messages handled once."""

import datetime as dt
import random
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import ROOT
from manifest_spark.operators import hitters as H
from manifest_spark.operators import partials as Pt
from manifest_spark.operators import reports as Rp
from manifest_spark.sources import ingest as S
from manifest_spark.sources import loads as Ld
from manifest_spark.streaming import stream as St

LOG = "id long, status string, log_timestamp timestamp_ntz, error_message string, extracted_fields int"


def log_rows(n=400, days=12, seed=1):
    rng, t0 = random.Random(seed), dt.datetime(2024, 3, 1)
    return [(i, rng.choice(["processed", "rejected", None]), t0 + dt.timedelta(seconds=rng.randrange(days * 86400)), "e", rng.choice([None, 0, 3, 15]))
            for i in range(n)]


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    path, rows = str(tmp_path_factory.mktemp("kept")), log_rows()
    for i in range(3):
        Pt.keep(spark.createDataFrame(rows[i::3], LOG), path)
    Pt.keep(spark.createDataFrame([(900, "processed", None, "e", 1)], LOG), path)
    return path, spark.createDataFrame(rows, LOG)


def test_reports_from_partials(spark, kept):
    path, log = kept
    assert Pt.daily_report(spark, path).collect() == Rp.daily_report(log).collect()
    assert sorted(Pt.daily_report_all(spark, path).collect()) == sorted(Rp.daily_report_all(log).collect())
    for day in ("2024-03-05", "2031-01-01"):
        assert Pt.daily_report(spark, path, day).collect() == Rp.daily_report(log, day).collect()
    for as_of in (None, dt.datetime(2024, 3, 9, 11, 30), dt.datetime(2024, 3, 9), dt.datetime(2024, 2, 1), dt.datetime(2025, 1, 1)):
        assert Pt.last_days(spark, path, 7, as_of).collect() == Rp.last_7_days(log, as_of).collect(), as_of


def test_a_report_reads_its_days_only(spark, kept):
    path, _ = kept
    day = Pt.daily_report(spark, path, "2024-03-05")._jdf.queryExecution().executedPlan().toString()
    assert day.count("FileScan") == 1 and "rows" not in day.split("Location:")[1][:200] and "PartitionFilters: [isnotnull(day" in day
    week = Pt.last_days(spark, path, 7, dt.datetime(2024, 3, 9, 11, 30))._jdf.queryExecution().executedPlan().toString()
    assert week.count("FileScan") == 2 and "(day#" in week.split("PartitionFilters:")[1] and "= 2024-03-02" in week


def frequent(texts, k):
    return sorted(((t, n) for t, n in Counter(t for t in texts if t is not None).items()), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("counters", [2, 8, 1024])
@pytest.mark.parametrize("shape", ["half", "flat", "steps", "few", "none"])
def test_most_frequent(spark, counters, shape):
    rng = random.Random(counters)
    texts = {"half": ["one long message " * 20] * 600 + [f"m{rng.randrange(500)}" for _ in range(600)], "flat": [f"m{i % 300}" for i in range(900)],
             "steps": [f"m{i}" for i in range(60) for _ in range(i)], "few": ["a", "b", "a", None, ""], "none": [None]}[shape]
    rng.shuffle(texts)
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(5)
    assert [tuple(r) for r in H.most_frequent(df, 5, "t", counters).collect()] == frequent(texts, 5)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 99), st.integers(1, 50), min_size=1), st.integers(1, 8))
def test_lowered_counters_stay_within_the_loss(counts, counters):
    h, c = np.array(list(counts), np.int64), np.array(list(counts.values()), np.int64)
    left, n, by = H.lowered(h, c, counters)
    kept = dict(zip(left.tolist(), n.tolist()))
    assert len(kept) <= counters and all(v > 0 for v in kept.values())
    assert all(kept.get(x, 0) <= y <= kept.get(x, 0) + by for x, y in counts.items())


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.LongType()), T.StructField("note", T.StringType())])


def test_a_killed_run_leaves_nothing_and_a_repeated_one_loads_once(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = spark.range(0, 50, 1, 4).select((F.col("id") * 7 % 50).alias("k")), spark.range(100, 130, 1, 3).select(F.col("id").alias("k"))
    assert Ld.read(spark, path, SCHEMA).count() == 0
    Ld.stage(first, path, SCHEMA, "a", ["k"], 1)  # died before its commit
    assert Ld.read(spark, path, SCHEMA).count() == 0
    assert Ld.load(first, path, SCHEMA, "a", ["k"]) and not Ld.load(first, path, SCHEMA, "a", ["k"])
    Ld.stage(second, path, SCHEMA, "b", ["k"], 1)
    # a writer that died between its data and the manifest's line, and another that wrote the line twice
    assert Ld.load(second, path, SCHEMA, "b", ["k"]) and not Ld.load(second, path, SCHEMA, "b", ["k"])
    twice = Ld.manifest(spark, path).where("run_id = 'b'").withColumn("attempt", F.lit("zzz"))
    twice.write.mode("append").parquet(path + "/manifest")
    rows = Ld.read(spark, path, SCHEMA).orderBy("id").collect()
    assert [(r.id, r.k, r.run_id) for r in rows] == [(i + 1, i, "a") for i in range(50)] + [(51 + i, 100 + i, "b") for i in range(30)]
    assert Ld.load(first.limit(0), path, SCHEMA, "c", ["k"]) and Ld.read(spark, path, SCHEMA).count() == 80


def test_dense_ids(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(20)]), rng.choice("abc")) for _ in range(500)]
    df = spark.createDataFrame(rows, "k long, t string").repartition(6)
    got = Ld.dense_ids(df, ["k", "t"], 11, str(tmp_path / "s")).orderBy("id").collect()
    assert [r.id for r in got] == list(range(11, 511))
    assert [(r.k, r.t) for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert Ld.dense_ids(df.limit(0), ["k"], 1, str(tmp_path / "e")).count() == 0


def message(i, text, head=b"", name=True):
    raw = S.render_message(i, "a@example.com", f"Load {i}", f"d{i}.pdf", text.encode())
    return head + (raw if name else raw.replace(f"Message-ID: <{i}@example.com>\n".encode(), b""))


def test_message_ids(spark):
    msgs = [message(1, "x"), message(1, "x", b"Received: r\n"), message(2, "x", name=False), b"message-id:\r\n <a@b> \r\n\r\nbody", b"\r\n\r\nMessage-ID: <c@d>", b""]
    got = [r[0] for r in spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "i int, content binary").orderBy("i")
           .select(S.message_id(F.col("content"))).collect()]
    assert got[0] == got[1] == "<1@example.com>" and got[3] == "<a@b>"
    assert all(len(x) == 64 for x in (got[2], got[4], got[5])) and len(set(got)) == 5


def test_messages_are_handled_once(spark, tmp_path):
    inbox, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def deliver(*msgs):
        spark.createDataFrame([(f"{len(m)}-{i}.eml", m) for i, m in enumerate(msgs)], "path string, content binary").coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("path string, content binary").option("maxFilesPerTrigger", 1).parquet(inbox)
        St.ingest_stream(stream, out, ck, run_ts="2025-01-01 00:00:00").awaitTermination()
        return sorted(r.email_subject for r in spark.read.parquet(out + "/order_log").collect())

    one, two, bare = message(1, "Load ID: 12345678\n"), message(2, "none"), message(5, "y", name=False)
    assert deliver(one, one, bare) == ["Load 1", "Load 5"]
    assert deliver(message(1, "Load ID: 12345678\n", b"Received: relay\n"), two, bare) == ["Load 1", "Load 2", "Load 5"]
    assert deliver(two, one) == ["Load 1", "Load 2", "Load 5"]


def test_session_without_a_shared_folder(tmp_path):
    """An empty Spark conf folder: a scratch folder in local mode."""
    code = ("from manifest_spark.session import get_spark, ensure_checkpoint_dir\n"
            "s = get_spark(master='local[1]', shuffle_partitions=1)\n"
            "a = ensure_checkpoint_dir(s)\nassert a == ensure_checkpoint_dir(s) and 'manifest-ckpt' in a\n"
            "assert s.range(3).checkpoint().count() == 3\nprint('fine')")
    import os
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=200)
    assert "fine" in done.stdout, done.stderr[-2000:]
