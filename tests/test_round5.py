"""Fewer words looked up a text, ends trimmed and texts tested for blanks without a full pass."""

import re

from pyspark.sql import functions as F

from manifest_spark.functions.dialect import SparkX
from manifest_spark.functions.literals import LiteralIndex, key_of, needed, signs
from manifest_spark.operators.extract import parse, with_ascii
from manifest_spark.plans import extract as pe
from manifest_spark.plans import rules as R
from test_literals import frame, plan_of, texts  # noqa: F401


def test_words_of_one_rule_are_looked_up_where_it_is_tried():
    index = LiteralIndex([p for _, p in pe.steps(R.LOCAL)])
    assert len(index.place) <= 20  # 62 words were looked up in every text
    assert not any(o != w and o in w for sets in index.words.values() for each in sets for w in each for o in each)


def test_keys_are_ends_from_the_rarest_sign():
    assert [key_of(w) for w in ("delivery date:", "customer & comments", "weight", "to", "bol", "\nto")] == ["very date:", "& comments", "weight", "to", "bol", "\nto"]
    assert signs(R.DATE_RULES[4]) == [{"/"}] and signs(R.FREIGHT_RULES[1]) == [{"$"}] and signs(r"[/$](x)|a") == []


def test_alternatives_tell_what_all_of_them_hold():
    assert {"date"} in needed(R.DATE_RULES[5]) and {"ship", "shipped"} not in needed(r"(?:a(x)|b)")
    assert needed(r"(?:one\s+two|two\s+six)") == [{"one", "two"}, {"one", "six"}, {"two"}, {"two", "six"}]


def test_guarded_rules_equal_the_rules(frame):  # noqa: F811
    rows = [r[0] for r in frame.select("text").collect()] + ["$5 total 1/2/2024, NY 12345", "Date Shipped: 1/2/24", "delivery date 3-4-2025 date", "120,000 lbs"]
    docs = frame.sparkSession.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    from manifest_spark.operators.extract import with_words
    rules = list(dict.fromkeys(p for _, p in pe.steps(R.LOCAL)))
    cur, d = with_words(docs, rules)
    got = cur.select("text", F.array(*[d.rx_test_guarded(F.col("text"), p) for p in rules]).alias("hit")).collect()
    for r in got:
        assert r.hit == [bool(re.search(p, r.text, re.I)) for p in rules], r.text


def test_blanks_are_those_of_python(spark):
    blanks = [c for c in map(chr, range(0x3001)) if c.isspace()]
    rows = [""] + [b + x + b for b in blanks for x in ("", "a", "a " + b + "é", b, "​", "\x00")]
    d = SparkX("__ascii")
    got = with_ascii(spark.createDataFrame([(x,) for x in rows], "text string")).select("text", d.strip(F.col("text")).alias("s"), d.is_blank(F.col("text")).alias("b"))
    for r in got.collect():
        assert (r.s, r.b) == (r.text.strip(), r.text.strip() == ""), repr(r.text)
    assert spark.range(1).select(d.is_blank(F.lit(None).cast("string"))).first()[0] is None


def test_the_site_is_looked_for_once(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", 5000)
    plan = plan_of(parse(spark.createDataFrame([(1, "x")], "doc_id long, text string"), R.LOCAL, keep=["doc_id"]))
    assert plan.count(f", {R.SITE_NAME})") == 1


def test_raw_text_counts_signs_not_bytes(spark):
    rows = ["é" * 3000, "é" * 5000, "a" * 4000, "a" * 4001, "", None]
    got = parse(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), R.LOCAL, keep=["doc_id"], fields=("bol_number",)).collect()
    assert {r.doc_id: r.raw_text for r in got} == {i: x and x[:4000] for i, x in enumerate(rows)}
