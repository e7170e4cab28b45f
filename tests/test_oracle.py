import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

FAST = ["parse_all", "parse_cloud", "rule_set_diff", "status_log", "route_reject", "run_summary",
        "success_outbox", "empty_documents", "document_text", "load_orders", "overall_stats",
        "last_7_days", "recent_activity", "common_errors", "daily_report_all", "recent_orders",
        "pattern_coverage", "address_pairs", "date_format_census", "keyword_census_documents",
        "page_profile", "field_fill", "rule_attribution", "tail_csv_log", "ensure_columns",
        "names_in_documents", "names_in_documents_joined", "parse_listed_sites", "rule_catalog", "rerun_load_orders", "dense_ids",
        "kept_daily_report", "kept_last_7_days", "frequent_errors", "frequent_lines", "daily_report"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_oracle_or_is_declared():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


@pytest.mark.parametrize("name", FAST)
def test_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(cols, res.fetchall())
