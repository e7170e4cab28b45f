"""A rule set evaluated in plain Python: the tests' yardstick and the benchmark's single-process baseline.

A record is described by a table: each entry names a cascade of rules, how it
goes on after a match, and a function from match to values.  Four ways of
going on cover the rule language: ``first`` takes the first match whatever it
gives, ``valid`` the first that gives a value, ``every`` collects all matches,
and cities ``fill`` the next empty place.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from manifest_spark.plans import rules as R

NAMED = ("name", "address")


def found(rules, text: str) -> Iterator[re.Match]:
    """The first match of each rule that matches, in rule order."""
    return (m for m in (re.search(p, text, re.IGNORECASE) for p in rules) if m)


def first(rules, text: str, value: Callable):
    m = next(found(rules, text), None)
    return None if m is None else value(m)


def valid(rules, text: str, value: Callable):
    return next((v for v in map(value, found(rules, text)) if v is not None), None)


def plain(m: re.Match) -> str:
    return m[1].strip()


def number(kind: type, ok: Callable = lambda v: True) -> Callable:
    def value(m):
        try:
            v = kind(m[1].replace(",", "") if kind is float else m[1])
        except ValueError:
            return None
        return v if ok(v) else None

    return value


def block(m: re.Match) -> dict:
    """Name and address of a party: three groups are address, town, name; one group is lines, the name first."""
    if m.re.groups == 3:
        return {"name": m[3].strip(), "address": m[1].strip()}
    name, *rest = [x for x in map(str.strip, m[1].strip().split("\n")) if x] or [None]
    return {"name": name, "address": " ".join(rest) or None}


def shipper(text: str, rs: R.RuleSet) -> dict:
    for site in (s for s in rs.site_names if s in text):
        where = rs.site_address and re.search(rs.site_address, text, re.IGNORECASE)
        return {"name": site, "address": ", ".join(map(str.strip, where.groups())) if where else None}
    usable = lambda m: block(m) if not plain(m).lower().startswith("address") else {}
    return first(rs.shipper, text, usable) or {}


def dates(text: str, rs: R.RuleSet) -> dict:
    all_ = [d for p in rs.dates for d in re.findall(p, text, re.IGNORECASE)]
    if len(all_) != 1:
        return dict(zip(("delivery_date", "shipment_date"), all_))
    shipped = rs.date_context and re.search(re.escape(all_[0]) + ".*" + R.DATE_CONTEXT_SHIP, text, re.IGNORECASE)
    return {"shipment_date" if shipped else "delivery_date": all_[0]}


def cities(text: str, rs: R.RuleSet) -> dict:
    place = {role: value for p, role, value in rs.fixed_cities if re.search(p, text, re.IGNORECASE)}
    general = rs.general_city and re.search(rs.general_city, text, re.IGNORECASE)
    if general and (free := [r for r in ("origin", "destination") if r not in place]):
        place[free[0]] = f"{general[1].strip()}, {general[2].strip()}"
    # of the plain tests, the first that holds decides a role
    place |= {role: value for literal, role, value in reversed(rs.city_contains) if literal in text}
    return {f"{role}_city": value for role, value in place.items()}


def carrier(rs: R.RuleSet) -> Callable:
    return lambda m: plain(m) if plain(m) and not plain(m).lower().startswith(tuple(rs.carrier_reject_prefixes)) else None


# field: (rules, way, value)
FIELD_TABLE = {
    "bol_number": ("bol", first, plain),
    "total_weight": ("weight", valid, number(float, lambda v: v > R.WEIGHT_MIN_EXCLUSIVE)),
    "total_pieces": ("pieces", valid, number(int, lambda v: R.PIECES_MIN_EXCLUSIVE < v < R.PIECES_MAX_EXCLUSIVE)),
    "freight_charges": ("freight", valid, number(float)),
    "commodity_description": ("commodity", first, lambda m: " ".join(m[1].split())),
    "reference_number": ("reference", first, plain),
}


def parse_text(text: str, rs: R.RuleSet) -> dict:
    record = dict.fromkeys(R.FIELDS)
    record |= {f: way(getattr(rs, rules), text, value) for f, (rules, way, value) in FIELD_TABLE.items()}
    record["carrier_name"] = valid(rs.carrier, text, carrier(rs))
    for party, got in (("shipper", shipper(text, rs)), ("consignee", first(rs.consignee, text, block) or {})):
        record |= {f"{party}_{k}": got.get(k) for k in NAMED}
    record |= dates(text, rs) if len(rs.dates) else {}
    record |= cities(text, rs)
    count = sum(v is not None for v in record.values())
    return record | {"raw_text": text[:rs.raw_text_chars], "extracted_fields": count}
