"""Extraction rule sets as data.

A rule set is an ordered list of regular expressions per field plus a few
literal parameters.  The engine in :mod:`manifest_spark.plans.extract` turns a
rule set into native Spark column expressions (and, for the oracle, into
DuckDB SQL).  Users extend the engine by passing their own :class:`RuleSet`.

Patterns are written in Python ``re`` syntax, which is the contract of the
rule language; :mod:`manifest_spark.functions.regex` translates them to the
Java dialect that Spark evaluates.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# --------------------------------------------------------------------------
# FIXED VALUES — these must equal the values of the system we reproduce, in
# its order, for equal results.  Do not reorder: order is rule priority.
# --------------------------------------------------------------------------

SITE_NAME = "LITTLE FALLS DISTRIBUTION CENT"
SITE_ADDRESS = r"Address:\s*\n\s*([^\n]+)\s*\n\s*([^\n]+)"

BOL_RULES = (
    r"Load ID:\s*(\d+)",
    r"Order:\s*([0-9\-]+)",
    r"(\d{8,})",
    r"(?:BOL|B/L|Bill of Lading)\s*(?:Number|No\.?|#)\s*:?\s*([A-Z0-9\-]+)",
    r"BOL\s*(\d+)",
    r"B/L\s*([A-Z0-9\-]+)",
)

SHIPPER_RULES = (
    r"Site:\s*\n\s*([^\n]+)",
    r"Site:\s*([^\n]+)",
    r"(?:Ship From|Origin).*?\n([^\n]+)",
    r"(?:Shipper|From)\s*:?\s*\n?\s*([^\n]+(?:\n[^\n]+)*?)(?=\n(?:Consignee|To|Carrier|Date))",
    r"SHIPPER\s*\n\s*([^\n]+(?:\n[^\n]+)*?)(?=\n\s*CONSIGNEE)",
)

CONSIGNEE_RULES = (
    r"(\d+\s+[A-Z][A-Z\s]+DRIVE)\s*\n\s*([A-Z\s,]+\d{5})\s*\n\s*([A-Z\s]+INDUSTRIES)",
    r"Stop\s*\n\s*Customer & Comments.*?\n.*?\n.*?\n\d+\s*\n\s*([^\n]+)\s*\n\s*([^\n]+)\s*\n\s*([^\n]+)",
    r"(?:Consignee|To)\s*:?\s*\n?\s*([^\n]+(?:\n[^\n]+)*?)(?=\n(?:Carrier|Date|Description))",
    r"CONSIGNEE\s*\n\s*([^\n]+(?:\n[^\n]+)*?)(?=\n\s*(?:CARRIER|DATE))",
)

CARRIER_RULES = (
    r"Carrier:\s*\n\s*([^\n]+)",
    r"([A-Z\s,]+(?:LOGISTICS|TRANSPORT|TRUCKING|FREIGHT)[^\n]*)",
    r"(?:Carrier|Motor Carrier)\s*:?\s*([^\n]+)",
    r"CARRIER\s*\n\s*([^\n]+)",
)
CARRIER_REJECT_PREFIXES = ("load id", "carrier:")

DATE_RULES = (
    r"([0-9]{1,2}-[A-Za-z]{3}-[0-9]{4})\s+[0-9]{2}:[0-9]{2}",
    r"Ship Date:\s*\n\s*([0-9]{1,2}-[A-Za-z]{3}-[0-9]{4})",
    r"Delivery Date:\s*\n\s*([0-9]{1,2}-[A-Za-z]{3}-[0-9]{4})",
    r"Appt Date:\s*\n\s*([0-9]{1,2}-[A-Za-z]{3}-[0-9]{4})",
    r"(\d{1,2}/\d{1,2}/\d{4})",
    r"(?:Ship(?:ment)?\s*Date|Date\s*Shipped)\s*:?\s*(\d{1,2}[\/\-]\d{1,2}[\/\-]\d{2,4})",
    r"(?:Delivery\s*Date|Date\s*Delivered)\s*:?\s*(\d{1,2}[\/\-]\d{1,2}[\/\-]\d{2,4})",
)
DATE_CONTEXT_SHIP = r"(?:ship|departure)"

WEIGHT_RULES = (
    r"(\d{2,3},\d{3})\s*lbs",
    r"(\d{5,6})\s*(?:\n|$)",
    r"(?:Total\s*)?Weight\s*:?\s*([0-9,]+(?:\.\d+)?)\s*(?:lbs?|pounds?)?",
    r"(\d{1,3}(?:,\d{3})*(?:\.\d+)?)\s*(?:lbs?|pounds?)",
)
WEIGHT_MIN_EXCLUSIVE = 100

PIECES_RULES = (
    r"Roll\s*\n\s*(\d+)",
    r"Units\s*\n\s*Qty\s*\n\s*Weight\s*\n\s*\d+\s*\n.*?\n.*?\n.*?\n.*?\n.*?\n.*?\n.*?\n.*?\n(\d+)",
    r"(?:Total\s*)?Pieces\s*:?\s*(\d+)",
    r"(?:Total\s*)?Count\s*:?\s*(\d+)",
    r"(\d+)\s*pieces?",
)
PIECES_MIN_EXCLUSIVE = 0
PIECES_MAX_EXCLUSIVE = 10000

FREIGHT_RULES = (
    r"(?:Freight\s*Charges?|Total\s*Charges?)\s*:?\s*\$?([0-9,]+(?:\.\d{2})?)",
    r"\$([0-9,]+(?:\.\d{2})?)\s*(?:freight|total)",
)

# (pattern, role, value written when the pattern matches)
FIXED_CITY_RULES = (
    (r"LITTLE FALLS, NY\s+(\d{5})", "origin", "LITTLE FALLS, NY"),
    (r"MONTVILLE, NJ\s+(\d{5})", "destination", "MONTVILLE, NJ"),
)
GENERAL_CITY_RULE = r"([A-Z\s]+),\s*([A-Z]{2})\s+(\d{5})"

COMMODITY_RULES = (
    r"Grade Desc:\s*([^\n]+(?:\n[^\n]+)*?)(?=\n(?:Width|PO#|Part#))",
    r"(?:Part#|Part Number):\s*([^\n]+)",
    r"(?:Commodity|Description|Contents)\s*:?\s*([^\n]+)",
    r"DESCRIPTION\s*\n\s*([^\n]+)",
)

REFERENCE_RULES = (
    r"Order:\s*([0-9\-]+)",
    r"PO#:\s*([A-Z0-9\-]+)",
    r"(?:Reference|Ref\.?)\s*(?:Number|No\.?|#)\s*:?\s*([A-Z0-9\-]+)",
    r"REF\s*([A-Z0-9\-]+)",
)

# Cloud variant: cities are found by case-sensitive substring tests.
# (literal, role, value); a later rule of the same role only applies when an
# earlier one of that role did not (if / elif).
CLOUD_CITY_CONTAINS = (
    ("LITTLE FALLS", "origin", "LITTLE FALLS, NY"),
    ("MONTVILLE", "destination", "MONTVILLE, NJ"),
    ("PLAINFIELD", "destination", "PLAINFIELD, NJ"),
)

RAW_TEXT_CHARS = 4000

# Diagnostic pattern sets (rule-coverage analytics).
DIAG_DATE_RULES = (
    r"Ship Date:\s*\n\s*([0-9]{1,2}-[A-Za-z]{3}-[0-9]{4})",
    r"Delivery Date:\s*\n\s*([0-9]{1,2}-[A-Za-z]{3}-[0-9]{4})",
    r"Appt Date:\s*\n\s*([0-9]{1,2}-[A-Za-z]{3}-[0-9]{4})",
    r"([0-9]{1,2}-[A-Za-z]{3}-[0-9]{4})\s+[0-9]{2}:[0-9]{2}",
    r"Date[^:]*:\s*([0-9]{1,2}-[A-Za-z]{3}-[0-9]{4})",
)
DIAG_BOL_RULES = (
    r"(?:BOL|B/L|Bill of Lading)\s*(?:Number|No\.?|#)\s*:?\s*([A-Z0-9\-]+)",
    r"BOL\s*(\d+)",
    r"B/L\s*([A-Z0-9\-]+)",
    r"Bill of Lading\s*([A-Z0-9\-]+)",
    r"(?:Bill|BOL).*?(\d{6,})",
    r"(\d{8,})",
)
DIAG_SHIPPER_RULES = (
    r"(?:Shipper|From)\s*:?\s*\n?\s*([^\n]+)",
    r"SHIPPER\s*\n\s*([^\n]+)",
    r"Ship\s*To.*?\n([^\n]+)",
    r"(?:Ship|From).*?([A-Z][A-Za-z\s&.,]+(?:\n[A-Za-z\s0-9.,]+)*)",
)
DIAG_SHIPPER_SHOWN = 3
DIAG_WEIGHT_RULES = (
    r"(?:Total\s*)?Weight\s*:?\s*([0-9,]+(?:\.\d+)?)\s*(?:lbs?|pounds?)?",
    r"(\d{1,3}(?:,\d{3})*(?:\.\d+)?)\s*(?:lbs?|pounds?)",
    r"Weight.*?(\d+[,\d]*\.?\d*)",
    r"(\d+)\s*(?:LB|lb|LBS|lbs)",
)
ADDRESS_PAIR_RULES = (
    r"(\d+\s+[A-Z][A-Z\s]+(?:STREET|ST|DRIVE|DR|AVENUE|AVE|ROAD|RD|LANE|LN)\.?)\s*\n\s*([A-Z\s,]+\d{5})",
    r"Address:\s*\n\s*([^\n]+)\s*\n\s*([A-Z\s,]+\d{5})",
    r"(\d+\s+[A-Z][^\n,]+)\s*\n\s*([A-Z]+,\s*[A-Z]{2}\s+\d{5})",
)
ADDRESS_PAIRS_SHOWN = 3
# Case-sensitive date formats: M/D/Y, M-D-Y, D-Mon-Y, Mon D Y, ISO.
DATE_FORMAT_CENSUS = (
    ("mdy_slash", r"\d{1,2}/\d{1,2}/\d{4}"),
    ("mdy_dash", r"\d{1,2}-\d{1,2}-\d{4}"),
    ("dmy_mon", r"\d{1,2}-[A-Za-z]{3}-\d{4}"),
    ("mon_d_y", r"[A-Za-z]{3}\s+\d{1,2},?\s+\d{4}"),
    ("iso", r"\d{4}-\d{2}-\d{2}"),
)
CANDIDATE_FIELDS = (
    ("load_truck_number", r"(?:Load|Truck|Vehicle)\s*(?:ID|Number|#)\s*:?\s*([A-Z0-9\-]+)"),
    ("driver_name", r"Driver\s*:?\s*([A-Za-z\s]+)"),
    ("special_instructions", r"(?:Instructions|Notes|Comments)\s*:?\s*([^\n]+)"),
    ("delivery_window", r"(?:Delivery|Appt)\s*(?:Window|Time)\s*:?\s*([^\n]+)"),
    ("contact_phone", r"(?:Phone|Tel|Contact)\s*:?\s*([\d\-\(\)\s]+)"),
)
KEYWORDS = (
    "shipper", "consignee", "carrier", "weight", "freight",
    "delivery", "origin", "destination", "pieces", "total",
)

# Target table widths (characters) of the orders table.
ORDER_WIDTHS = (
    ("bol_number", 100),
    ("shipper_name", 255),
    ("shipper_address", 500),
    ("consignee_name", 255),
    ("consignee_address", 500),
    ("carrier_name", 255),
    ("shipment_date", 50),
    ("delivery_date", 50),
    ("origin_city", 255),
    ("destination_city", 255),
    ("commodity_description", 500),
    ("reference_number", 100),
)
# Columns the setup self-check looks for.
SCHEMA_AUDIT_COLUMNS = (
    "bol_number", "shipper_name", "consignee_name", "carrier_name",
    "shipment_date", "delivery_date", "total_weight", "total_pieces",
    "freight_charges", "commodity_description", "reference_number", "raw_text",
)
REJECTION_SUBJECT_PREFIX = "Order Rejected: "
REJECTION_BODY = "Order data could not be inserted into the database. See attached PDF."
SUCCESS_SUBJECT = "BOL Processing Success - {n} documents processed"
SUCCESS_BODY = (
    "✅ BOL Automation Success Report",
    "Successfully processed {n} PDF document(s).",
    "Processing Summary:",
    "{lines}",
    "All data has been inserted into the database and logged.",
    "This is an automated message from your BOL processing system.",
)
# --------------------------------------------------------------------------
# end of fixed values
# --------------------------------------------------------------------------

FIELDS = (
    "bol_number", "shipper_name", "shipper_address", "consignee_name",
    "consignee_address", "carrier_name", "shipment_date", "delivery_date",
    "origin_city", "destination_city", "total_weight", "total_pieces",
    "freight_charges", "commodity_description", "reference_number",
)


@dataclass(frozen=True)
class RuleSet:
    """Ordered extraction rules for every field of a shipment record.

    Empty tuples switch a field's cascade off (the field stays NULL).
    """

    name: str
    bol: tuple = BOL_RULES
    site_names: tuple = (SITE_NAME,)
    site_address: str | None = SITE_ADDRESS
    shipper: tuple = SHIPPER_RULES
    consignee: tuple = CONSIGNEE_RULES
    carrier: tuple = CARRIER_RULES
    carrier_reject_prefixes: tuple = CARRIER_REJECT_PREFIXES
    dates: tuple = DATE_RULES
    date_context: bool = True
    weight: tuple = WEIGHT_RULES
    pieces: tuple = PIECES_RULES
    freight: tuple = FREIGHT_RULES
    fixed_cities: tuple = FIXED_CITY_RULES
    general_city: str | None = GENERAL_CITY_RULE
    city_contains: tuple = ()
    commodity: tuple = COMMODITY_RULES
    reference: tuple = REFERENCE_RULES
    raw_text_chars: int = RAW_TEXT_CHARS

    def with_(self, **kw) -> "RuleSet":
        return replace(self, **kw)


# Words without which a rule cannot match: tried first, as they cost less than the rule.
RULE_GUARDS = {
    CARRIER_RULES[1]: "LOGISTICS|TRANSPORT|TRUCKING|FREIGHT",
    CONSIGNEE_RULES[0]: "INDUSTRIES",
    CONSIGNEE_RULES[1]: "Customer & Comments",
    CONSIGNEE_RULES[2]: r"\n(?:Carrier|Date|Description)",
    CONSIGNEE_RULES[3]: "CONSIGNEE",
    SHIPPER_RULES[3]: r"\n(?:Consignee|To|Carrier|Date)",
    SHIPPER_RULES[4]: "SHIPPER",
    COMMODITY_RULES[0]: "Grade Desc:",
    PIECES_RULES[1]: "Units",
    GENERAL_CITY_RULE: r",\s*[A-Z]{2}\s+\d{5}",
    SITE_ADDRESS: "Address:",
    ADDRESS_PAIR_RULES[2]: r",\s*[A-Z]{2}\s+\d{5}",
}

LOCAL = RuleSet(name="local")

CLOUD = RuleSet(
    name="cloud",
    shipper=(),
    consignee=CONSIGNEE_RULES[:2],
    carrier=CARRIER_RULES[1:2],
    dates=(DATE_RULES[0], DATE_RULES[4]),
    date_context=False,
    weight=WEIGHT_RULES[:2],
    pieces=PIECES_RULES[:1],
    freight=(),
    fixed_cities=(),
    general_city=None,
    city_contains=CLOUD_CITY_CONTAINS,
    commodity=COMMODITY_RULES[:1],
    reference=REFERENCE_RULES[:2],
)


def catalog_rows(rule_set: RuleSet) -> list[tuple]:
    """(rule_set, field, priority, pattern, stop_rule) rows of a rule set."""
    stop = {
        "bol": "match", "shipper": "match", "consignee": "match",
        "carrier": "valid", "dates": "all", "weight": "valid",
        "pieces": "valid", "freight": "valid", "commodity": "match",
        "reference": "match",
    }
    rows = []
    for fld in ("bol", "shipper", "consignee", "carrier", "dates", "weight",
                "pieces", "freight", "commodity", "reference"):
        for i, p in enumerate(getattr(rule_set, fld), start=1):
            rows.append((rule_set.name, fld, i, p, stop[fld]))
    i = 0
    for p, role, _ in rule_set.fixed_cities:
        i += 1
        rows.append((rule_set.name, "cities", i, p, "fill:" + role))
    if rule_set.general_city:
        i += 1
        rows.append((rule_set.name, "cities", i, rule_set.general_city, "fill:first_empty"))
    for lit, role, _ in rule_set.city_contains:
        i += 1
        rows.append((rule_set.name, "cities", i, lit, "contains:" + role))
    return rows
