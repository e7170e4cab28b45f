import re

from hypothesis import given, settings
from hypothesis import strategies as st

from manifest_spark.functions import regex as rx
from manifest_spark.plans import rules as R


BLOCK_RULES = [p for p in (*R.SHIPPER_RULES, *R.CONSIGNEE_RULES, *R.COMMODITY_RULES) if rx.block_parts(p)]


def scanned(p, text):
    """The block rule by its find-all form, read back as a Python pattern."""
    return "".join(m[1] or "" for m in re.finditer(rx.block_scan(p), text, re.I))


def test_block_rules_are_known():
    assert len(BLOCK_RULES) == 5


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["From", "To", "to ", "Shipper:", "SHIPPER", "CONSIGNEE", "Consignee", "Carrier", "CARRIER", "Date", "Grade Desc:",
                                 "Width", "PO#", "photo", "a", "long words in a line of over twenty four signs", ":", " ", "\n", "\n", "\n\n", "\t", " \n "]),
                max_size=28))
def test_block_scan_equals_the_rule(pieces):
    text = "".join(pieces)
    for p in BLOCK_RULES:
        m = re.search(p, text, re.I)
        assert scanned(p, text) == (m[1] if m else ""), p


def test_anchor_only_for_leading_class_runs():
    assert rx.anchor_run_start(R.GENERAL_CITY_RULE).startswith("(?<![A-Z\\s])")
    assert rx.anchor_run_start(R.CARRIER_RULES[1]).startswith("(?<![A-Z\\s,])")
    assert rx.anchor_run_start(R.BOL_RULES[0]) == R.BOL_RULES[0]


def test_python_whitespace_added_inside_and_outside_classes():
    j = rx.java(r"a\s*[A-Z\s]")
    assert "[\\s\\x1c-\\x1f]*" in j and "[A-Z\\s\\x1c-\\x1f]" in j


def test_re2_form_drops_lookahead():
    assert "(?=" not in rx.re2(R.SHIPPER_RULES[3])


def test_block_ends_are_looked_for_at_line_breaks_only():
    """A lazy step a sign, with a look ahead at each, took nine tenths of a block rule's time."""
    for p in BLOCK_RULES:
        assert "*?" not in rx.block_scan(p), p


def test_ascii_classes_are_listed():
    """Java asks each range and set of a class in turn; signs listed one by one are looked up in one table."""
    assert rx.for_ascii(rx.java(r"[A-C\s,]+([^\n]+)")) == r"(?id)[\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x2cabc]+(.+)"
    assert rx.for_ascii(rx.java(r"[A-C]\[a-z]", False)) == r"(?d)[ABC]\[a-z]"
    for kept in (r"x[^:]*:", r"[]x]", r"[\s&&[^\n]]", r"\[\^\n]"):
        assert rx.for_ascii("(?idU)" + kept) == "(?id)" + kept
    assert rx.for_ascii(r"(?idU)(?s)[^\n].") == r"(?id)(?s)[^\n]."


def test_ascii_forms_match_the_same(spark):
    import random

    from pyspark.sql import functions as F
    rng = random.Random(11)
    words = ["To", "From", "\n", "\n\n", " ", "\t", "\x1c", "\x1f", "A,", "NY 12345", "Carrier", "TRUCKING", "12-Jun-2025 08:00", "1/2/2025", "44,000 lbs", "[", "]", "-", "_", "&", "K"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(0, 20))) for _ in range(400)] + ["".join(map(chr, range(128)))]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2).cache()
    patterns = [p for each in (R.BOL_RULES, R.SHIPPER_RULES, R.CONSIGNEE_RULES, R.CARRIER_RULES, R.DATE_RULES, R.WEIGHT_RULES, R.REFERENCE_RULES) for p in each]
    patterns += [R.GENERAL_CITY_RULE, r"([A-Z\-\]]+)", r"([^A-Z]+)", r"([\w.]+)"]
    same = [F.regexp_extract_all("text", F.lit(j), F.lit(1)) == F.regexp_extract_all("text", F.lit(rx.for_ascii(j)), F.lit(1)) for j in map(rx.java, patterns)]
    assert frame.where(~F.array_min(F.array(*same))).count() == 0


def test_strip_removes_what_python_strips(spark):
    from pyspark.sql import functions as F

    from manifest_spark.functions.dialect import SparkX
    every = "".join(c for c in map(chr, range(0xd800)) if c.isspace())
    texts = ["", " ", "a", every, every + "a" + every + "b" + every, "​x​ ", "\x00 x", "é ü　", "\n\n a\n b\n", "\x1fa\x85"]
    d, frame = SparkX(), spark.createDataFrame([(t,) for t in texts], "text string")
    plan = frame.select(d.strip(F.col("text")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan  # a regex call for each of some thirty short captures a text
    for r in frame.select("text", d.strip(F.col("text")).alias("s"), d.lines(d.strip(F.col("text"))).alias("l")).collect():
        assert (r.s, r.l) == (r.text.strip(), [x.strip() for x in r.text.strip().split("\n") if x.strip()]), r.text


NUMBERED = [R.DIAG_WEIGHT_RULES[3], R.PIECES_RULES[4], R.ADDRESS_PAIR_RULES[0], R.ADDRESS_PAIR_RULES[2], R.CONSIGNEE_RULES[0]]


def test_numbers_are_tried_once_a_run(spark):
    import random

    from pyspark.sql import functions as F
    assert all(rx.anchor_number(p) != p for p in NUMBERED)
    for p in (r"(\d+)\s*(?:lbs|\d)", r"(\d+)\s*(?:lbs)?", r"(\d+)\s*x?", r"(\d+)(\d)", r"(\d+)\s*(?:a|lbs)", R.DIAG_BOL_RULES[5]):
        assert rx.anchor_number(p) == p
    rng = random.Random(5)
    words = ["1", "12", "12345", "123456", "7", " ", " ", "\n", "\n", "\x1c", "lbs", "LB", "pieces", "piece", "MAIN", "A", "DRIVE", "ST", "NY", ",", ", NJ ", "INDUSTRIES", ".", "é", "٣"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(0, 24))) for _ in range(1500)]
    texts += ["1 A DRIVE\nNY 123456 A DRIVE\nNY 12345", "1 AB ST\nNY, NY 123457 CD ST\nNY, NY 54321", "5lbs5lbs 55 lbs"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    forms = [f for p in NUMBERED for f in (rx.java(p),)]
    every = lambda f: F.regexp_extract_all("text", F.lit(f), F.lit(1))
    rows = frame.select("text", F.array(*map(every, forms)).alias("u"), F.when(F.length("text") == F.octet_length("text"), F.array(*[every(rx.for_ascii(f)) for f in forms])).alias("a")).collect()
    for r in rows:
        wanted = [[m[1] for m in re.finditer(p, r.text, re.I)] for p in NUMBERED]
        assert r.u == wanted and r.a in (None, wanted), r.text


def test_long_runs_of_digits_take_time_in_proportion(spark):
    import time

    from pyspark.sql import functions as F

    from manifest_spark.functions.dialect import SparkX
    frame = spark.createDataFrame([("7" * 60_000 + " lb",)], "text string")
    for p in NUMBERED:
        began = time.time()
        frame.select(SparkX().rx_all(F.col("text"), p)).collect()
        assert time.time() - began < 2, p  # from each digit to the end and back: billions of steps
