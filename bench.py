"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Each query is run to completion with the ``noop``
sink (full execution, no collect).  ``baseline_*`` entries time a plain
single-process Python ``re`` loop over the same rules and the same text (the
sequential design we replace); they are reference points, not part of the
headline value.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
sys.path.insert(0, os.path.join(HERE, "tests"))

HEADLINE = (
    "parse_all", "parse_cloud", "rule_set_diff", "status_log", "route_accept", "run_summary",
    "load_orders", "document_text", "pattern_coverage", "pattern_coverage_documents",
    "keyword_census_documents", "date_format_census", "field_fill", "rule_attribution",
    "overall_stats", "daily_report_all", "recent_activity", "common_errors",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    from manifest_spark.registry import QUERIES, DOCS
    from manifest_spark.session import get_spark

    spark = get_spark()
    times = {}
    # warm-up: JIT and codegen caches, not timed
    QUERIES["parse_all"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        spark.catalog.clearCache()

    # baseline: sequential Python over the same rendered text
    import duckdb
    from pyref import parse_text
    from manifest_spark.plans.rules import LOCAL
    con = duckdb.connect()
    for t in ("orders", "lineitem", "customer", "supplier", "part", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    texts = [r[0] for r in con.execute(f"SELECT text FROM ({DOCS})").fetchall()]
    t0 = time.perf_counter()
    for t in texts:
        parse_text(t, LOCAL)
    base = time.perf_counter() - t0

    # the reports by DuckDB over the same tables, as a second reference point
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    from manifest_spark.registry import ORACLE
    duck = {}
    for name in ("overall_stats", "last_7_days", "recent_activity", "common_errors", "daily_report", "daily_report_all"):
        t0 = time.perf_counter()
        con.execute(ORACLE[name]).fetchall()
        duck[name] = round(time.perf_counter() - t0, 3)

    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
        "documents": len(texts),
        "parse_all_docs_per_sec": round(len(texts) / times["parse_all"], 1),
        "baseline_python_parse_all_sec": round(base, 3),
        "baseline_python_docs_per_sec": round(len(texts) / base, 1),
        "parse_all_docs_per_sec_per_core": round(len(texts) / times["parse_all"] / cpus, 1),
        "duckdb_reports_sec": duck,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
