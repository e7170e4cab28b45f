"""Seek rules in linear form and the literal index, against Python's ``re``."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from manifest_spark.functions import regex as rx
from manifest_spark.functions.dialect import SparkX
from manifest_spark.functions.literals import LiteralIndex, folded, needed
from manifest_spark.operators import coverage as D
from manifest_spark.plans import rules as R

ALL = list(dict.fromkeys([p for _, _, p, _ in D.diag_rules()] + [r[3] for rs in (R.LOCAL, R.CLOUD) for r in R.catalog_rows(rs) if not r[4].startswith("contains")]
                         + list(R.ADDRESS_PAIR_RULES) + [p for _, p in R.CANDIDATE_FIELDS]))
SEEK = [p for p in ALL if rx.seek_parts(p)]
PIECES = ["Ship", "Ship From", "ship", "To", "From", "Origin", "origin ", "Bill", "BOL", "bill ", "B/L", "Weight", "weight ", "Date", "date ", ":", " ", "\n", "\n",
          "\n\n", "\x1c", " \n ", "123456", "12", "7,1.5", "lbs", "4 lb", "1-Jan-2024", "x", "É", "ſhip", "Kilo", "Weıght", "BİLL", "a line, of words", "Part#",
          "description", "carrier:", "Total", "pieces", "Ref", "No.", "#", "count 5", "ordeR: 9-9", "Delıvery Date", "Grade Desc:"]


def texts(n=1500, seed=4):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 24))) for _ in range(n)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(list(enumerate(texts())), "i int, text string").repartition(4).cache()


def test_which_rules_seek():
    heads = {rx.seek_parts(p) for p in SEEK}
    assert heads == {("(?:Ship From|Origin)", ".*?"), ("Date", "[^:]*"), ("(?:Bill|BOL)", ".*?"), (r"Ship\s*To", ".*?"), ("(?:Ship|From)", ".*?"), ("Weight", ".*?")}
    assert rx.seek_parts(r"Date.*?(\d*)") is None and rx.seek_parts(r"\d+.*?(x)") is None and rx.seek_parts("a(b)") is None


@pytest.mark.parametrize("pattern", SEEK)
def test_seek_rules_equal_the_rule(frame, pattern):
    T, d = F.col("text"), SparkX()
    rows = frame.select("text", d.rx(T, pattern).alias("first"), d.rx_all(T, pattern).alias("every"), d.rx_count(T, pattern).alias("n"),
                        d.rx_test(T, pattern).alias("hit")).collect()
    for r in rows:
        m, every = re.search(pattern, r.text, re.I), [x[1] for x in re.finditer(pattern, r.text, re.I)]
        assert (r.first, r.every, r.n, r.hit) == (m[1] if m else "", every, len(every), bool(m)), r.text


def test_index_never_hides_a_match(frame):
    index = LiteralIndex(ALL)
    f = frame.select("text", folded(F.col("text")).alias("f"))
    f = f.select("text", "f", *index.columns(F.col("f")))
    stands = [index.stands(p) for p in ALL]
    assert sum(s is None for s in stands) <= 7
    rows = f.select("text", F.array(*[F.lit(True) if s is None else s for s in stands]).alias("ok")).collect()
    for r in rows:
        for p, ok in zip(ALL, r.ok):
            assert ok or not re.search(p, r.text, re.I), (p, r.text)
    assert sum(not x for r in rows for x in r.ok) > 0.3 * len(rows) * len(ALL)


def test_needed_words():
    one = lambda p: [set(s) for s in needed(p)]
    assert one(R.BOL_RULES[3]) == [{"bol", "b/l", "bill of lading"}] and one(R.SHIPPER_RULES[4]) == [{"shipper"}, {"consignee"}]
    assert one(r"(\d{8,})") == [] and one(r"(?:a|\d)x") == []
    assert one(r"(?:foo|bar\d+)?baz") == [{"baz"}] and one(r"(?:foo|bar\d+)") == [{"foo", "bar"}]
    assert one(r"(x)(?=\nEnd)") == [{"\nend"}] and one(r"(x)(?!\nEnd)") == []
    assert one(r"(?:LONGER WORD)+(\d)") == [{"longer word"}] and one(r"Stop\s*\n\s*Here") == [{"stop"}, {"here"}]


@pytest.mark.parametrize("word", ["origin ", "bill ", "weight ", "date ", "ship ", "ship to ", "from "])
def test_long_lines_take_time_in_proportion(spark, word):
    """80 and 160 kB of heads without a target: a quadratic scan would take four times as long, and tens of seconds."""
    def seconds(n):
        t = (word * (n // len(word) + 1))[:n].replace("m ", "m\x00 ") if word == "never" else (word * (n // len(word) + 1))[:n]
        docs = spark.createDataFrame([(1, t)], "doc_id long, text string")
        began = time.time()
        D.pattern_matches(docs).collect()
        docs.select(SparkX().rx(F.col("text"), R.SHIPPER_RULES[2])).collect()
        return time.time() - began
    seconds(1000)
    one, two = min(seconds(80_000), seconds(80_000)), min(seconds(160_000), seconds(160_000))
    assert two < 2.6 * one + 1 and two < 8


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_pattern_once_in_the_plan(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", 5000)
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = plan_of(D.pattern_coverage(docs))
    for _, _, p, _ in D.diag_rules():
        form = rx.java(p)
        for f in (form, rx.for_ascii(form)):
            assert plan.count(f"{f},") + plan.count(f"{f})") == 1, f


def test_keywords_counted_in_any_case(spark):
    t = "Total TOTAL toTal shipper ſhipper FREıGHT freİght weight Weights oriGin"
    docs = spark.createDataFrame([(1, t), (2, None), (3, "")], "doc_id long, text string")
    got = {(r.doc_id, r.keyword): r.occurrences for r in D.keyword_census(docs).collect()}
    for k in R.KEYWORDS:
        assert got[1, k] == len(re.findall(k, t, re.I)) and got[2, k] is None and got[3, k] == 0
