"""Field extraction: documents → shipment records (narrow, no shuffle).

``parse(df)`` adds the 15 record fields, ``raw_text`` and ``extracted_fields``
to a DataFrame with a text column: a chain of projections over native column
expressions without a UDF, compiled by whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import SparkX, SqlX
from ..functions.literals import LiteralIndex, folded
from ..functions.stages import settled
from ..plans import extract as plan_mod
from ..plans.rules import FIELDS, LOCAL, RuleSet

RECORD_COLUMNS = FIELDS + ("raw_text", "extracted_fields")
ASCII, FOLDED = "__ascii", "__folded"


def with_ascii(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with a column that tells whether ``text`` is ASCII."""
    return settled(df, [(F.length(text) == F.octet_length(text)).alias(ASCII)])


def with_words(df: DataFrame, patterns, text: str = "text") -> tuple[DataFrame, SparkX]:
    """``df`` with the bits of the words of all ``patterns`` that stand in ``text``, and the expression builder that uses them."""
    index = LiteralIndex(patterns)
    cur = settled(with_ascii(df, text), [folded(F.col(text), F.col(ASCII)).alias(FOLDED)])
    return settled(cur, index.columns(F.col(FOLDED)), 1), SparkX(ascii=ASCII, index=index)


def staged(df: DataFrame, plan) -> DataFrame:
    """The plan's stages, each in generators of its own: a projection would be compiled into its neighbours' method."""
    for stage in plan.stages:
        df = settled(df, [e.alias(a) for a, e in stage])
    return df


# the cascades that a field's value comes from
_SOURCES = {
    "bol": ("bol_number",), "site_names": ("shipper_name", "shipper_address"), "shipper": ("shipper_name", "shipper_address"),
    "consignee": ("consignee_name", "consignee_address"), "carrier": ("carrier_name",),
    "dates": ("shipment_date", "delivery_date"), "weight": ("total_weight",), "pieces": ("total_pieces",),
    "freight": ("freight_charges",), "fixed_cities": ("origin_city", "destination_city"),
    "city_contains": ("origin_city", "destination_city"), "commodity": ("commodity_description",), "reference": ("reference_number",),
}


def only(rules: RuleSet, fields: tuple) -> RuleSet:
    """``rules`` without the cascades that none of ``fields`` needs."""
    off = {c: () for c, made in _SOURCES.items() if not set(made) & set(fields)}
    if "fixed_cities" in off:
        off["general_city"] = None
    return rules.with_(**off)


def parse(df: DataFrame, rules: RuleSet = LOCAL, text: str = "text",
          keep: tuple | list | None = None, lazy: bool = True, fields: tuple = FIELDS, extra: tuple = ()) -> DataFrame:
    """Append the extracted record to ``keep`` columns (default: all but text).

    With fewer ``fields`` only their rules run, and there is no
    ``extracted_fields``; ``extra`` names intermediate columns to keep (without
    their leading line).
    """
    keep = [c for c in df.columns if c != text] if keep is None else list(keep)
    rules_of = only(rules, fields)
    cur, d = with_words(df.select(*keep, text), [p for _, p in plan_mod.steps(rules_of)], text)
    plan = plan_mod.build(d, rules_of, text, lazy=lazy)
    final = dict(plan.final)
    cur = staged(cur, plan)
    more = [x.lstrip("_") for x in extra]
    cur = settled(cur, [final[f].alias(f) for f in fields] + [F.col(x).alias(y) for x, y in zip(extra, more)])
    n = rules.raw_text_chars
    # a text of so few bytes has no more signs, and need not be counted
    raw = F.when(F.octet_length(text) <= n, F.col(text)).otherwise(F.substring(text, 1, n))
    cur = cur.select(*keep, *more, *fields, raw.alias("raw_text"))
    return cur.withColumn("extracted_fields", plan_mod.extracted_count(d)) if tuple(fields) == FIELDS else cur


def parse_sql(source_sql: str, rules: RuleSet = LOCAL, keep=("doc_id",), text: str = "text") -> str:
    """DuckDB SQL equivalent of :func:`parse` over ``source_sql``."""
    d = SqlX()
    plan = plan_mod.build(d, rules, text, lazy=False)  # every rule's capture: a plan unlike the engine's
    keep_s = ", ".join(keep)
    sql = f"SELECT {keep_s}, {text} FROM ({source_sql}) src"
    for stage in plan.stages:
        sql = f"SELECT *, {', '.join(d.alias(e, a) for a, e in stage)} FROM ({sql}) s"
    sql = (f"SELECT {keep_s}, {', '.join(d.alias(e, a) for a, e in plan.final)}, "
           f"substring({text}, 1, {rules.raw_text_chars}) AS raw_text FROM ({sql}) s")
    return f"SELECT *, {plan_mod.extracted_count(d)} AS extracted_fields FROM ({sql}) r"
