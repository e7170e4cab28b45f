"""Rule sets evaluated together: patterns and steps that they have in common stand once in the plan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from manifest_spark.functions import regex as rx
from manifest_spark.functions.dialect import SparkX
from manifest_spark.operators import coverage as D
from manifest_spark.operators.extract import parse, settled, staged, with_words
from manifest_spark.plans import extract as pe
from manifest_spark.plans.fixtures import document_text
from manifest_spark.plans.rules import CLOUD, FIELDS, LOCAL
from test_extract import QUIRKS


def together(docs, sets):
    cur, d = with_words(docs.select("doc_id", "text"), [p for rules in sets for _, p in pe.steps(rules)])
    shared, out = pe.Shared(*sets), []
    for i, rules in enumerate(sets):
        plan = pe.build(d, rules, "text", f"s{i}_", shared=shared)
        cur = settled(staged(cur, plan), [e.alias(a) for a, e in plan.final])
        out.append([f"s{i}_{f}" for f in FIELDS])
    return cur, out


@pytest.fixture(scope="module")
def docs(spark):
    extra = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(QUIRKS)], "doc_id long, text string")
    return document_text(spark, SF_SMALL).select("doc_id", "text").unionByName(extra)


def variants():
    """Rule sets that share beginnings, parts out of order, or nothing, of each cascade."""
    rng = random.Random(3)
    sets = [LOCAL, CLOUD]
    for _ in range(3):
        change = {}
        for f in ("bol", "shipper", "consignee", "carrier", "dates", "weight", "pieces", "freight", "commodity", "reference"):
            rules = list(getattr(LOCAL, f))
            if rng.random() < 0.5:
                rng.shuffle(rules)
            change[f] = tuple(rules[:rng.randint(0, len(rules))])
        sets.append(LOCAL.with_(name="v", site_names=rng.choice([(), LOCAL.site_names]), **change))
    return sets


def test_together_equals_apart(docs):
    sets = variants()
    cur, names = together(docs, sets)
    for rules, cols in zip(sets, names):
        got = cur.select("doc_id", *[F.col(c).alias(f) for c, f in zip(cols, FIELDS)])
        want = parse(docs, rules, keep=["doc_id"]).select("doc_id", *FIELDS)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def scans(df):
    """How often each pattern is tried on the whole text, in the optimized plan."""
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", 100_000)
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_pattern_once_in_the_plan(spark):
    import __spark_entry__ as E
    plan = scans(E.queries()["rule_set_diff"](spark, SF_SMALL))
    patterns = {p for rules in (LOCAL, CLOUD) for _, p in pe.steps(rules)}
    assert len(patterns) > 40
    text = re.search(r"length\((\w+#\d+)\) = octet_length", plan)[1]
    for p in patterns:
        form = rx.java(p, first_match=p not in LOCAL.dates)
        for f in (form, rx.for_ascii(form)):
            assert len(re.findall(r"\(text#\d+, " + re.escape(f), plan)) == 1, (text, p)


@pytest.mark.parametrize("name", ["rule_attribution", "rule_set_diff", "rule_catalog", "pattern_coverage"])
def test_generated_methods_stay_compilable(spark, name):
    import __spark_entry__ as E
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        shown = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", shown)]
    assert sizes and max(sizes) < 8000


@pytest.mark.parametrize("rules", [LOCAL, CLOUD], ids=["local", "cloud"])
def test_attribution_equals_the_eager_form(docs, rules):
    got = D.rule_attribution(docs, rules)
    plan = pe.build(SparkX(), rules, "text", lazy=False)
    cur = docs.select("doc_id", "text")
    for stage in plan.stages:
        cur = cur.select("*", *[e.alias(a) for a, e in stage])
    want = None
    for f, e in plan.attribution.items():
        one = cur.select(F.lit(f).alias("field"), e.cast("int").alias("rule_no")).groupBy("field", "rule_no").agg(F.count(F.lit(1)).alias("documents"))
        want = one if want is None else want.union(one)
    key = lambda r: (r.field, r.rule_no is None, r.rule_no, r.documents)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
