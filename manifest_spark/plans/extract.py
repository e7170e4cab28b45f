"""Rule set → staged projections that compute one shipment record per text.

The record is computed in three narrow projections (no shuffle):

1. every rule's raw capture is bound once (``''`` = no match);
2. per-field intermediates (stripped values, numeric parses, line arrays);
3. the final 15 fields, ``raw_text`` and ``extracted_fields``.

Binding each regex once keeps the expression tree small and guarantees that
no regex is evaluated twice for a row; stages 2–3 only touch short captures.

Cascade semantics (per field, patterns in rule order, first match of each):

* stop-on-match — the first rule that matches decides, whatever it captured
  (bol, shipper, consignee, commodity, reference);
* stop-on-valid — a capture that fails its check falls through to the next
  rule (carrier, weight, pieces, freight);
* dates collect all matches of all rules, in rule order then text order;
* cities fill origin/destination in sequence without stopping.
"""

from __future__ import annotations

from dataclasses import dataclass

from .rules import (
    DATE_CONTEXT_SHIP,
    FIELDS,
    PIECES_MAX_EXCLUSIVE,
    PIECES_MIN_EXCLUSIVE,
    WEIGHT_MIN_EXCLUSIVE,
    RuleSet,
)


@dataclass
class Plan:
    stages: list  # list of list[(alias, expr)]; each stage keeps prior columns
    final: list   # list[(alias, expr)]
    attribution: dict  # field -> 1-based index of the rule that produced it


def _first_index(d, conds):
    """1-based index of the first true condition, NULL when none is."""
    if not conds:
        return d.when([(d.lit(False), d.lit(0))])
    return d.when([(c, d.lit(i)) for i, c in enumerate(conds, start=1)])


_CASCADES = ("bol", "shipper", "consignee", "carrier", "weight", "pieces", "freight", "commodity", "reference")


def steps(rs: RuleSet) -> list[tuple]:
    """(step, pattern) of all cascades: a step is its field's rules up to this one, and what keeps the field from being tried."""
    site = (rs.site_names, rs.site_address)
    out = [((field, getattr(rs, field)[:i + 1], site if field == "shipper" else None), p)
           for field in _CASCADES for i, p in enumerate(getattr(rs, field))]
    if rs.site_names and rs.site_address:
        out.append((("site",) + site, rs.site_address))
    return out + [(("dates", p), p) for p in rs.dates] + [(("city", p), p) for p, _, _ in rs.fixed_cities] + (
        [(("general",), rs.general_city)] if rs.general_city else [])


class Shared:
    """What the rule sets of one evaluation have in common: steps bound once, and patterns that several steps need.

    A step that two rule sets reach by the same rules is one node.  A pattern
    that stands in several nodes is tried once, for all of them; others are
    tried only where their cascade gets to them.
    """

    def __init__(self, *rule_sets: RuleSet):
        nodes: dict = {}
        for rs in rule_sets:
            for step, p in steps(rs):
                nodes.setdefault(p, set()).add(step)
        self.common = {p for p, each in nodes.items() if len(each) > 1}
        self.bound: dict = {}


def build(d, rs: RuleSet, text: str = "text", prefix: str = "", lazy: bool = True, shared: Shared | None = None, attribute: bool = False) -> Plan:
    """Staged expressions for ``rs``; ``prefix`` namespaces the bound columns
    so that several rule sets can be evaluated in one projection.

    With ``lazy`` each step of a cascade is a projection of its own that holds
    the value so far and evaluates the next rule only where there is none yet.
    Every regex so stands once in the plan, and each projection is compiled to
    a method of its own.  The steps' columns tell which rule gave a value.
    ``shared`` holds the columns that plans of other rule sets over the same
    rows have bound before this one; by default that of this one alone.
    ``attribute`` binds what the attribution of dates needs besides.
    ``lazy=False`` binds every rule's capture (the oracle's form).
    """
    T = d.col(text)
    ahead: list = []
    stages: list = []
    s2: list = []
    fin: list = []
    shared = shared or Shared(rs)
    site_key = (rs.site_names, rs.site_address)

    def bind(stage, alias, expr):
        while isinstance(stage, int) and len(stages) <= stage:
            stages.append([])
        (stages[stage] if isinstance(stage, int) else stage).append((prefix + alias, expr))
        return d.col(prefix + alias)

    def blank(c):
        return d.eq(c, d.lit(""))

    def once(key, make):
        """The column of a node, bound by the first plan that needs it."""
        if not lazy:
            return make()
        if key not in shared.bound:
            shared.bound[key] = make()
        return shared.bound[key]

    def capture(p, group=1):
        """A rule's capture: tried where it stands, or once in advance where several steps need it."""
        if not lazy:
            return d.rx(T, p, group)
        if p not in shared.common or group != 1:
            return d.rx_guarded(T, p, group)
        return once(("raw", p), lambda: bind(ahead, f"_raw{len(shared.bound)}", d.rx_guarded(T, p)))

    def first_match(name, field, unless=None):
        """Captures of a stop-on-match cascade: the value after each step, or one per rule."""
        pats = getattr(rs, field)
        if not lazy:
            return [bind(0, f"_{name}{i}", d.rx(T, p)) for i, p in enumerate(pats)]
        out = []
        for i, p in enumerate(pats):
            def make(i=i, p=p):
                e = capture(p)
                if unless is not None:
                    e = d.when([(unless, d.lit(""))], e)
                return bind(2 * i, f"_{name}{i}", d.when([(blank(out[-1]), e)], out[-1]) if out else e)
            out.append(once((field, pats[:i + 1], site_key if field == "shipper" else None), make))
        return out

    def first_valid(name, field, value):
        """Checked values of a stop-on-valid cascade after each step, or one per rule; NULL where a capture fails its check."""
        pats = getattr(rs, field)
        if not lazy:
            return [bind(1, f"_{name}v{i}", value(bind(0, f"_{name}{i}", d.rx(T, p)))) for i, p in enumerate(pats)]
        out = []
        for i, p in enumerate(pats):
            def make(i=i, p=p):
                raw = bind(2 * i, f"_{name}{i}", d.when([(d.is_null(out[-1]), capture(p))]) if out else capture(p))
                return bind(2 * i + 1, f"_{name}v{i}", d.coalesce(out[-1], value(raw)) if out else value(raw))
            out.append(once((field, pats[:i + 1], None), make))
        return out

    def groups(key, name, pattern, wanted, stage, when=None):
        """Several groups of one scan: the whole match is bound, its groups are taken from that short text."""
        if not lazy:
            return [bind(0, f"_{name}{g}", d.rx(T, pattern, g)) for g in wanted]

        def make():
            e = capture(pattern, 0)
            whole = bind(stage, f"_{name}", e if when is None else d.when([(when, e)], d.lit("")))
            return [bind(stage + 1, f"_{name}{g}", d.rx(whole, pattern, g)) for g in wanted]
        return once(key, make)

    # ---- captures, rule by rule --------------------------------------------
    site = None
    if rs.site_names:
        site = once(("site", rs.site_names), lambda: bind(ahead if lazy else 0, "_site", d.when([(d.contains(T, n), d.lit(n)) for n in rs.site_names])))
        if rs.site_address:
            a1, a2 = groups(("site",) + site_key, "site_a", rs.site_address, (1, 2), 1, d.not_null(site))
    bol = first_match("bol", "bol")
    # the site rule decides first
    shp = first_match("shp", "shipper", None if site is None or not lazy else d.not_null(site))

    con = []
    open_ = None
    for i, p in enumerate(rs.consignee):
        key = ("consignee", rs.consignee[:i + 1], None)
        if "(?=" in p:
            def make(i=i, p=p, open_=open_):
                e = capture(p)
                return bind(2 * i if lazy else 0, f"_con{i}", e if open_ is None or not lazy else d.when([(open_, e)], d.lit("")))
            a = once(key, make)
            con.append(("block", a, None))
        else:
            a, n = groups(key, f"con{i}_", p, (1, 3), 2 * i, open_)
            con.append(("triple", a, n))
        open_ = blank(a) if open_ is None else d.and_(open_, blank(a))
    ok_carrier = lambda c: (lambda v: d.when([(d.and_(d.ne(v, d.lit("")), d.not_(
        d.startswith_any(d.lower(v), rs.carrier_reject_prefixes))), v)]))(d.strip(c))
    car = first_valid("car", "carrier", ok_carrier)
    num = lambda c: d.try_double(d.remove(c, ","))
    wv = first_valid("wt", "weight", lambda c: d.when([(d.gt(num(c), d.lit(WEIGHT_MIN_EXCLUSIVE)), num(c))]))
    pv = first_valid("pc", "pieces", lambda c: d.when([(d.and_(
        d.gt(d.try_long(c), d.lit(PIECES_MIN_EXCLUSIVE)), d.lt(d.try_long(c), d.lit(PIECES_MAX_EXCLUSIVE))), d.try_long(c))]))
    fv = first_valid("fr", "freight", num)
    by_rule = [once(("dates", p), lambda i=i, p=p: bind(0, f"_dates{i}", d.rx_all_guarded(T, p, 1))) for i, p in enumerate(rs.dates)]
    dates = bind(1, "_dates", d.concat_arrays(*by_rule) if by_rule else d.empty_array())
    cfix = [once(("city", p), lambda i=i, p=p: bind(0, f"_cfix{i}", capture(p))) for i, (p, _, _) in enumerate(rs.fixed_cities)]
    if rs.general_city:
        cg1, cg2 = groups(("general", rs.general_city), "cg", rs.general_city, (1, 2), 3)
    ccon = [once(("contains", lit), lambda i=i, lit=lit: bind(0, f"_ccon{i}", d.contains(T, lit))) for i, (lit, _, _) in enumerate(rs.city_contains)]
    cm = first_match("cm", "commodity")
    rf = first_match("rf", "reference")
    # the value that a stop-on-match cascade ends with, or the first of the captures
    ends = lambda each: d.nz(each[-1]) if lazy else d.coalesce(*[d.nz(c) for c in each])
    valid = lambda each: each[-1] if lazy else d.coalesce(*each)

    # ---- intermediates ------------------------------------------------------
    # shipper (site rule first, then the cascade only when no site was found)
    shp_info = None
    s3: list = []
    if shp:
        shp_info = bind(s2, "_shp_info", d.strip(ends(shp)))
        shp_lines = bind(s3, "_shp_lines", d.lines(shp_info))
    con_lines = []
    for i, (kind, a, n) in enumerate(con):
        con_lines.append(bind(s3, f"_con{i}_lines", d.lines(bind(s2, f"_con{i}_text", d.strip(a)))) if kind == "block" else None)
    nd = bind(s2, "_ndates", d.size(dates))
    d1 = bind(s2, "_date1", d.element(dates, 1))
    d2 = bind(s2, "_date2", d.element(dates, 2))
    ctx_ship = None
    if rs.date_context:
        ctx_ship = bind(s2, "_ctx_ship", d.when(
            [(d.eq(d.size(dates), d.lit(1)),
              d.literal_then(T, d.element(dates, 1), DATE_CONTEXT_SHIP))], d.lit(False)))

    # ---- stage 3: final fields -------------------------------------------
    out = {}
    out["bol_number"] = d.strip(ends(bol)) if bol else d.null_str()

    if shp:
        shp_ok = d.and_(d.not_null(shp_info), d.ne(shp_info, d.lit("")),
                        d.not_(d.startswith_any(d.lower(shp_info), ("address",))))
        casc_name = d.when([(shp_ok, d.first(shp_lines))])
        casc_addr = d.when([(shp_ok, d.rest_joined(shp_lines))])
    else:
        casc_name = casc_addr = d.null_str()
    if site is not None:
        site_addr = (d.when([(d.ne(a1, d.lit("")),
                              d.concat(d.strip(a1), d.lit(", "), d.strip(a2)))])
                     if rs.site_address else d.null_str())
        out["shipper_name"] = d.when([(d.not_null(site), site)], casc_name)
        out["shipper_address"] = d.when([(d.not_null(site), site_addr)], casc_addr)
    else:
        out["shipper_name"], out["shipper_address"] = casc_name, casc_addr

    name_cases, addr_cases = [], []
    for (kind, a, n), lines in zip(con, con_lines):
        matched = d.ne(a, d.lit(""))
        if kind == "triple":
            name_cases.append((matched, d.strip(n)))
            addr_cases.append((matched, d.strip(a)))
        else:
            name_cases.append((matched, d.first(lines)))
            addr_cases.append((matched, d.rest_joined(lines)))
    out["consignee_name"] = d.when(name_cases) if name_cases else d.null_str()
    out["consignee_address"] = d.when(addr_cases) if addr_cases else d.null_str()

    out["carrier_name"] = valid(car) if car else d.null_str()

    one = d.eq(nd, d.lit(1))
    two = d.ge(nd, d.lit(2))
    if ctx_ship is not None:
        out["shipment_date"] = d.when([(two, d2), (d.and_(one, ctx_ship), d1)])
        out["delivery_date"] = d.when([(two, d1), (d.and_(one, d.not_(ctx_ship)), d1)])
    else:
        out["shipment_date"] = d.when([(two, d2)])
        out["delivery_date"] = d.when([(two, d1), (one, d1)])

    # cities: sequential fill, no stop
    origin = dest = None
    for (p, role, value), m in zip(rs.fixed_cities, cfix):
        hit = d.ne(m, d.lit(""))
        if role == "origin":
            origin = d.when([(hit, d.lit(value))], origin)
        else:
            dest = d.when([(hit, d.lit(value))], dest)
    if rs.general_city:
        gen = d.when([(d.ne(cg1, d.lit("")), d.concat(d.strip(cg1), d.lit(", "), d.strip(cg2)))])
        if origin is None:
            new_origin, new_dest = gen, dest
        else:
            new_origin = d.coalesce(origin, gen)
            new_dest = (d.when([(d.not_null(origin), gen)]) if dest is None
                        else d.coalesce(dest, d.when([(d.not_null(origin), gen)])))
        origin, dest = new_origin, new_dest
    for role in ("origin", "destination"):
        cases = [(c, d.lit(v)) for (lit, r, v), c in zip(rs.city_contains, ccon) if r == role]
        if cases:
            e = d.when(cases)
            if role == "origin":
                origin = e if origin is None else d.coalesce(e, origin)
            else:
                dest = e if dest is None else d.coalesce(e, dest)
    out["origin_city"] = origin if origin is not None else d.null_str()
    out["destination_city"] = dest if dest is not None else d.null_str()

    out["total_weight"] = valid(wv) if wv else d.when([(d.lit(False), d.lit(0.0))])
    out["total_pieces"] = d.to_int(valid(pv) if pv else d.when([(d.lit(False), d.lit(0))]))
    out["freight_charges"] = valid(fv) if fv else d.when([(d.lit(False), d.lit(0.0))])
    out["commodity_description"] = (d.collapse(d.strip(ends(cm)))
                                    if cm else d.null_str())
    out["reference_number"] = (d.strip(ends(rf)) if rf else d.null_str())

    for f in FIELDS:
        fin.append((prefix + f, out[f]))

    # which rule produced each field (the diagnostics' question)
    hit = lambda c: d.and_(d.not_null(c), d.ne(c, d.lit("")))
    attrib = {
        "bol_number": _first_index(d, [hit(c) for c in bol]),
        "shipper_name": (d.when([(d.not_null(site), d.lit(0))], _first_index(d, [hit(c) for c in shp]))
                         if site is not None else _first_index(d, [hit(c) for c in shp])),
        "consignee_name": _first_index(d, [hit(a) for _, a, _ in con]),
        "carrier_name": _first_index(d, [d.not_null(v) for v in car]),
        "total_weight": _first_index(d, [d.not_null(v) for v in wv]),
        "total_pieces": _first_index(d, [d.not_null(v) for v in pv]),
        "freight_charges": _first_index(d, [d.not_null(v) for v in fv]),
        "commodity_description": _first_index(d, [hit(c) for c in cm]),
        "reference_number": _first_index(d, [hit(c) for c in rf]),
    }
    if rs.dates:
        sizes = [d.size(x) for x in by_rule]
        upto = [d.add(*sizes[:i + 1]) if i else sizes[0] for i in range(len(sizes))]
        if attribute:
            upto = [bind(s3, f"_upto{i}", e) for i, e in enumerate(upto)]
        nth = lambda k: _first_index(d, [d.ge(n, d.lit(k)) for n in upto])
        shipped = d.and_(one, ctx_ship) if ctx_ship is not None else None
        attrib["shipment_date"] = d.when([(two, nth(2))] + ([(shipped, nth(1))] if shipped is not None else []))
        attrib["delivery_date"] = d.when([(two, nth(1)), (one if shipped is None else d.and_(one, d.not_(ctx_ship)), nth(1))])
    # rules are numbered as in the catalog: fixed ones, the general one, plain tests; a later plain test yields to an earlier
    after = len(rs.fixed_cities) + bool(rs.general_city)
    for role in ("origin", "destination"):
        cases = [(c, d.lit(after + 1 + i)) for i, ((_, r, _), c) in enumerate(zip(rs.city_contains, ccon)) if r == role]
        cases += [(d.ne(m, d.lit("")), d.lit(1 + i)) for i, ((_, r, _), m) in reversed(list(enumerate(zip(rs.fixed_cities, cfix)))) if r == role]
        if rs.general_city:
            hits = [d.ne(m, d.lit("")) for (_, r, _), m in zip(rs.fixed_cities, cfix) if r == "origin"]
            general = d.ne(cg1, d.lit(""))
            if role == "origin" or hits:
                cases.append((general if role == "origin" else d.and_(general, d.or_(*hits)), d.lit(len(rs.fixed_cities) + 1)))
        if cases:
            attrib[f"{role}_city"] = d.when(cases)
    return Plan(stages=[x for x in [ahead, *stages, s2, s3] if x], final=fin, attribution=attrib)


def extracted_count(d, fields=FIELDS):
    """Number of non-NULL fields of a record (raw_text not counted)."""
    return d.add(*[d.to_int(d.not_null(d.col(f))) for f in fields])
