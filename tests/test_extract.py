import math
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from manifest_spark.operators.extract import parse
from manifest_spark.plans.fixtures import document_text
from manifest_spark.plans.rules import CLOUD, LOCAL
from pyref import parse_text

QUIRKS = [
    "Reference",
    "Shipper: address 12 Main\nConsignee: X",
    "Carrier:\nLoad ID 5\nACME TRUCKING co\n",
    "Site:\n   \t\n",
    "Foo BAR, NY 12345\nLITTLE FALLS, NY 13365",
    "a\r\nLoad ID: 1234\u0085x y\nShip Date: 1/2/2024 ship\n",
    "Grade Desc: a\n b\n\nWidth", "Grade Desc: a\n b\nWidth: 1",
    "\x1cLoad ID:\x1c 99\x1c", "CARRIER\n  \x1f\nfoo",
    "Weight: 1,2 lbs 44,000 lbs", "12-Jun-2025 00:00 departure\n", "Appt 12-Jun-2025 00:00 x\nship",
    "ſhipper: X\nTo", "Total Charges: ,\n$1,234.50 freight", "Pieces: 0\nCount: 12000\n7 pieces",
    "From\n" + "l.\n" * 2000 + "Consignee", "SHIPPER\n" + "x.\n" * 2000 + "\n  CONSIGNEE",
    "LITTLE FALLS DISTRIBUTION CENT\nAddress:\n 1 Mill Rd \n Town, NY 12345\n",
    "", "   ",
]


def _compare(rows, texts, rs):
    bad = []
    for k, t in texts.items():
        exp, got = parse_text(t, rs), rows[k]
        for f, v in exp.items():
            g = got[f]
            if isinstance(v, float) and g is not None and math.isclose(v, g):
                continue
            if v != g:
                bad.append((k, f, v, g))
    return bad


@pytest.mark.parametrize("rs", [LOCAL, CLOUD], ids=["local", "cloud"])
def test_differential_against_python_rules(spark, rs):
    docs = document_text(spark, SF_SMALL).select("doc_id", "text")
    extra = spark.createDataFrame(pd.DataFrame({"doc_id": range(10**9, 10**9 + len(QUIRKS)), "text": QUIRKS}))
    allr = docs.unionByName(extra)
    texts = {r.doc_id: r.text for r in allr.collect()}
    rows = {r["doc_id"]: r.asDict() for r in parse(allr, rs, keep=["doc_id"]).collect()}
    assert _compare(rows, texts, rs) == []


def _one(spark, text, rs=LOCAL):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return parse(df, rs, keep=["doc_id"]).collect()[0]


def test_quirk_reference_word(spark):
    assert _one(spark, "Reference")["reference_number"] == "erence"


def test_quirk_shipper_address_stops_cascade(spark):
    r = _one(spark, "Site: address 1 Road\nShip From\nACME\n")
    assert r["shipper_name"] is None


def test_quirk_carrier_load_id_falls_through(spark):
    r = _one(spark, "Carrier:\nLoad ID 5\nACME TRUCKING co\n")
    assert r["carrier_name"] == "ACME TRUCKING co"


def test_quirk_general_city_copies_origin(spark):
    r = _one(spark, "LITTLE FALLS, NY 13365\n")
    assert (r["origin_city"], r["destination_city"]) == ("LITTLE FALLS, NY", "LITTLE FALLS, NY")


def test_quirk_blank_capture_counts(spark):
    r = _one(spark, "Consignee:\n \nCarrier: X")
    e = parse_text("Consignee:\n \nCarrier: X", LOCAL)
    assert r["consignee_name"] == e["consignee_name"]
    assert r["extracted_fields"] == e["extracted_fields"]


def test_fifty_thousand_lines_do_not_kill_the_jvm(spark):
    text = "From\n" + "line\n" * 50000 + "Consignee\n" + "SHIPPER\n" + "x\n" * 50000
    t0 = time.time()
    r = _one(spark, text)
    assert time.time() - t0 < 120
    assert r["shipper_name"] == "line"
    assert r["shipper_address"] == " ".join(["line"] * 49999)
    # the session is still alive
    assert spark.range(3).count() == 3


def test_plan_is_narrow_and_jvm_only(spark):
    df = spark.createDataFrame([(1, "Load ID: 1")], "doc_id long, text string")
    plan = parse(df, LOCAL, keep=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "extracted_fields" in df.columns


@pytest.mark.parametrize("rs", [LOCAL, CLOUD], ids=["local", "cloud"])
def test_lazy_cascades_equal_eager(spark, rs):
    docs = document_text(spark, SF_SMALL).select("doc_id", "text")
    extra = spark.createDataFrame(pd.DataFrame({"doc_id": range(10**9, 10**9 + len(QUIRKS)), "text": QUIRKS}))
    allr = docs.unionByName(extra)
    lazy = parse(allr, rs, keep=["doc_id"], lazy=True)
    eager = parse(allr, rs, keep=["doc_id"], lazy=False)
    assert lazy.exceptAll(eager).count() == 0 and eager.exceptAll(lazy).count() == 0


@pytest.mark.parametrize("unit", ["go to the\n", "go to the ", "to", "To\n\n", "From \n\t\n", "1 A DRIVE\n", "Grade Desc: x\n"])
def test_long_texts_without_an_end_take_linear_time(spark, unit):
    def seconds(size):
        df = spark.createDataFrame([(1, unit * (size // len(unit)) + "\n\nCarrier")], "doc_id long, text string")
        t0 = time.time()
        parse(df, LOCAL, keep=["doc_id"], fields=("shipper_name", "consignee_name", "commodity_description")).collect()
        return time.time() - t0

    seconds(1000)
    assert seconds(160_000) < 4


def test_fewer_fields_are_the_same_fields(spark):
    docs = document_text(spark, SF_SMALL).select("doc_id", "text")
    whole = parse(docs, LOCAL, keep=["doc_id"])
    for fields in (("bol_number",), ("origin_city", "destination_city"), ("shipper_name",), ("shipment_date", "total_weight")):
        one = parse(docs, LOCAL, keep=["doc_id"], fields=fields).select("doc_id", *fields)
        assert one.exceptAll(whole.select("doc_id", *fields)).count() == 0


def test_generated_methods_stay_compilable(spark):
    """HotSpot leaves methods of over 8000 bytes interpreted."""
    import re
    docs = spark.read.parquet(SF_SMALL + "/documents.parquet").select("doc_id", "text")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        shown = parse(docs, LOCAL, keep=["doc_id"])._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", shown)]
    assert sizes and max(sizes) < 8000


def test_hand_written_records(spark):
    """Expected values written by hand from the rule language's description."""
    r = _one(spark, "Load ID: 12345678\nOrder: 77-01\nSite: ACME\nCarrier:\nBLUE TRUCKING\n12-Jun-2025 08:00 ship\n44,000 lbs\nPieces: 7\n"
                    "Freight Charges: $1,234.50\nPart#: 9 STEEL   COILS\nMONTVILLE, NJ 07045\n")
    assert {k: r[k] for k in ("bol_number", "shipper_name", "shipper_address", "carrier_name", "shipment_date", "delivery_date", "total_weight",
                              "total_pieces", "freight_charges", "commodity_description", "reference_number", "origin_city",
                              "destination_city", "consignee_name")} == {
        "bol_number": "12345678", "shipper_name": "ACME", "shipper_address": None, "carrier_name": "BLUE TRUCKING",
        "shipment_date": "12-Jun-2025", "delivery_date": None, "total_weight": 44000.0, "total_pieces": 7, "freight_charges": 1234.5,
        "commodity_description": "9 STEEL COILS", "reference_number": "77-01",
        "origin_city": "STEEL   COILS\nMONTVILLE, NJ",  # the general city rule reads over line breaks
        "destination_city": "MONTVILLE, NJ", "consignee_name": None}


def test_attribution_of_dates_and_cities(spark):
    from manifest_spark.operators.coverage import rule_attribution
    texts = ["12-Jun-2025 08:00 ship\n", "Ship Date:\n1-Jan-2025\n3/4/2025 x", "LITTLE FALLS, NY 13365\n", "\nUTICA, NY 13501\n", "none"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.field, r.rule_no): r.documents for r in rule_attribution(docs).collect()
           if r.field in ("shipment_date", "delivery_date", "origin_city", "destination_city") and r.rule_no is not None}
    assert got == {("shipment_date", 1): 1, ("delivery_date", 2): 1, ("shipment_date", 5): 1,
                   ("origin_city", 1): 1, ("destination_city", 3): 1, ("origin_city", 3): 1}
