"""Rules tried at their first signs only, numbers that keep their digits, and the deal of the text work."""

import re

from pyspark.sql import functions as F

from manifest_spark.functions import regex as rx
from manifest_spark.functions.dialect import SparkX
from manifest_spark.operators.extract import with_words
from manifest_spark.plans import fixtures
from manifest_spark.plans.fixtures import document_text
from manifest_spark.plans.rules import DATE_CONTEXT_SHIP, DIAG_SHIPPER_RULES, LOCAL

TEXTS = (
    "", "\n", "ſhip From dock\nNorth\nto\nA\nDate", "TO: B\nC\nCarrier", "custTOmer x\ny\nDescription", "Mo Carrier 1", "motor carrier: Load", "ſHIPPER\nS 1\nCONSIGNEE\nC\nDATE",
    "12,345 lbs 123,456\x1clbs", "1234,567 lbs", "1234567 lbs", "12 345lb 1,234,567.5 pounds", "12345\n", "1234567", "123456 ", "x ٣٤٥ lbs", "Total  Weight: 12 lbs", "total\nweight 7", "WEIGHT55",
    "Ref. No: A-1 reference # b", "REF9", "ship date 1/2/24 date shipped: 3-4-2024", "shipment\xa0Date : 1/2/2024", "Content Contents: a\nDescription b", "ACME FREIGHTLOGISTICS co", "tRUCKiNG, TRUCKING",
    "Freight  Charge $1,2 Total Charges: 5.00", "count 5 Total Count: 6", "pieces:7", "Bill 123456 BOL", "Deıscription: ı", "A CITY, NY 12345\nB, NJ  54321", "1,234 and X,\xa0NY 1234",
)


def test_first_signs():
    assert rx.first_signs(r"(?:Consignee|To)\s*:?") == "ct"
    assert rx.first_signs(r"(?:Total\s*)?Weight") == "tw"
    assert rx.first_signs(r"(?:Reference|Ref\.?)") == "r"
    assert rx.first_signs(r"(?:Ab|cd)", False) == "Ac"
    assert not any(map(rx.first_signs, (r"(?:a|\d)", r"(?:a)?", r"[ab]c", r"(?:a|#)", r"(?:é|a)", r"(?=a)b", r"(?i:a)b", "")))
    assert rx.java(r"(?:Consignee|To)(x)").startswith(rx.JAVA_FLAGS_CI + "(?=[ct])")


def test_numbers_keep_their_digits():
    assert rx.kept_digits(r"(\d{1,3}(?:,\d{3})*)\s*(?:lb|oz)") == r"(\d{1,3}+(?:,\d{3})*)\s*(?:lb|oz)"
    assert rx.kept_digits(r"(\d{5,6})\s*(?:\n|$)") == r"(\d{5,6}+)\s*(?:\n|$)"
    for p in (r"(\d{1,3}\d)", r"(\d{1,3})[^x]", r"(\d{1,3}).", r"(\d{1,3})\s*[0-9]", r"(\d{1,3}),?5", r"(\d{1,3})\b1", r"(\d{1,3})(?:a|7)", r"(\d{2})x"):
        assert rx.kept_digits(p) == p


def test_rules_find_the_same(spark):
    rules = [p for name in ("bol", "shipper", "consignee", "carrier", "weight", "pieces", "freight", "commodity", "reference", "dates") for p in getattr(LOCAL, name)]
    rules += [LOCAL.general_city, *DIAG_SHIPPER_RULES]
    rules = list(dict.fromkeys(rules))
    df, d = with_words(spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string"), rules)
    got = df.select("id", F.array(*[d.rx_guarded(F.col("text"), p) for p in rules]).alias("a")).collect()
    for row in got:
        want = [(lambda m: (m[1] or "") if m else "")(re.search(p, TEXTS[row.id], re.I)) for p in rules]
        assert list(row.a) == want, (TEXTS[row.id], [(p, g, w) for p, g, w in zip(rules, row.a, want) if g != w])


def test_value_before_a_word(spark):
    rows = [("on 1-Jan-24 SHIP", True), ("1-JAN-24\nship", False), ("x", False), ("a 1-jan-24 b 1-Jan-24 Departure", True), ("ship 1-Jan-24", False), ("é 1-Jan-24 ſhip", True)]
    df, d = with_words(spark.createDataFrame(rows, "text string, want boolean"), [DATE_CONTEXT_SHIP])
    for x in (d, SparkX()):
        assert df.where(x.literal_then(F.col("text"), F.lit("1-Jan-24"), DATE_CONTEXT_SHIP) != F.col("want")).count() == 0


def test_text_work_is_dealt_to_many_tasks(spark):
    """As many rounds of tasks as make a half-empty last one a small part."""
    docs = document_text(spark, "/root/testdata/sf0.001").select("doc_id", "text")
    sizes = [r["n"] for r in docs.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= fixtures.TASKS_A_CORE * spark.sparkContext.defaultParallelism and sum(sizes) == 1500
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)
