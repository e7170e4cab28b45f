"""Rule-coverage analytics: which patterns hit, which fields stay empty.

All diagnostics are per-document projections (find-all / count of each
pattern) unpivoted with ``inline``/``stack`` and, for the census-style
reports, a two-phase aggregate on a small key (rule, field or keyword).
The pattern lists are data, so the same code serves any rule set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import regex as rx
from ..functions.dialect import q
from ..functions.literals import folded
from ..plans import rules as R
from ..plans.extract import build, steps
from ..plans.rules import FIELDS, LOCAL, RuleSet
from .extract import ASCII, FOLDED, settled, staged, with_ascii, with_words

SEP = " | "


def with_folded(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the text, with its case-folded form."""
    cur = with_ascii(docs.select(*keep, "text"))
    return settled(cur, [folded(F.col("text"), F.col(ASCII)).alias(FOLDED)])


def diag_rules():
    """(rule_group, rule_no, pattern, shown) of the per-pattern match dump."""
    out = []
    for group, pats, shown in (("dates", R.DIAG_DATE_RULES, None),
                               ("bol", R.DIAG_BOL_RULES, None),
                               ("shipper", R.DIAG_SHIPPER_RULES, R.DIAG_SHIPPER_SHOWN),
                               ("weight", R.DIAG_WEIGHT_RULES, None)):
        for i, p in enumerate(pats, start=1):
            out.append((group, i, p, shown))
    return out


def _matches_sql(group, no, pattern, shown, ignorecase=True):
    all_ = f"regexp_extract_all(text, {q(rx.re2(pattern, ignorecase))}, 1)"
    vis = all_ if shown is None else f"({all_})[1:{shown}]"
    return (f"SELECT doc_id, {q(group)} AS rule_group, {no} AS rule_no, "
            f"CAST(len({all_}) AS INTEGER) AS n_matches, array_to_string({vis}, {q(SEP)}) AS matches FROM ({{src}})")


# --- D1 ----------------------------------------------------------------------
def pattern_matches(docs: DataFrame) -> DataFrame:
    """(doc_id, rule_group, rule_no, n_matches, matches): one row per doc and pattern."""
    T = F.col("text")
    rules = diag_rules()
    cur, d = with_words(docs.select("doc_id", "text"), [p for _, _, p, _ in rules])
    # bind each find-all once; the generator below only references columns
    bound = cur.select("doc_id", *[d.rx_all_guarded(T, p).alias(f"_m{k}") for k, (g, i, p, s) in enumerate(rules)])
    arr = F.array(*[
        F.struct(F.lit(g).alias("rule_group"), F.lit(i).alias("rule_no"),
                 F.size(f"_m{k}").alias("n_matches"),
                 F.array_join(F.col(f"_m{k}") if s is None else F.slice(f"_m{k}", 1, s), SEP)
                 .alias("matches"))
        for k, (g, i, p, s) in enumerate(rules)])
    return bound.select("doc_id", F.inline(arr))


def pattern_matches_sql(src: str) -> str:
    return " UNION ALL ".join(_matches_sql(g, i, p, s).replace("{src}", src) for g, i, p, s in diag_rules())


# --- D2 ----------------------------------------------------------------------
def pattern_coverage(docs: DataFrame) -> DataFrame:
    """Per pattern: documents hit and total matches, across every document.

    One global two-phase aggregate of per-pattern match counts (no explode,
    no per-match arrays), unpivoted at the end: 19 rows.
    """
    T = F.col("text")
    rules = diag_rules()
    cur, d = with_words(docs.select("text"), [p for _, _, p, _ in rules])
    counts = settled(cur, [d.rx_count_guarded(T, p).alias(f"_n{k}") for k, (g, i, p, s) in enumerate(rules)])
    agg = counts.agg(*[x for k in range(len(rules)) for x in (
        F.count_if(F.col(f"_n{k}") > 0).alias(f"_h{k}"), F.sum(f"_n{k}").cast("bigint").alias(f"_t{k}"))])
    arr = F.array(*[F.struct(F.lit(g).alias("rule_group"), F.lit(i).alias("rule_no"),
                             F.col(f"_h{k}").alias("docs_hit"), F.col(f"_t{k}").alias("total_matches"))
                    for k, (g, i, p, s) in enumerate(rules)])
    return agg.select(F.inline(arr))


def pattern_coverage_sql(src: str) -> str:
    return (f"SELECT rule_group, rule_no, count(*) FILTER (WHERE n_matches > 0) AS docs_hit, "
            f"CAST(sum(n_matches) AS BIGINT) AS total_matches FROM ({pattern_matches_sql(src)}) m "
            f"GROUP BY rule_group, rule_no")


# --- D3 ----------------------------------------------------------------------
def _pair_of(form: str):
    return lambda match: F.struct(F.regexp_extract(match, form, 1).alias("street"), F.regexp_extract(match, form, 2).alias("city_state_zip"))


def address_pairs(docs: DataFrame) -> DataFrame:
    """First (street, city-state-zip) pairs of each two-group address pattern.

    One find-all of whole matches a pattern; the groups are taken from the few
    short matches that are shown.
    """
    T = F.col("text")
    cur, d = with_words(docs.select("doc_id", "text"), R.ADDRESS_PAIR_RULES)
    per_rule = []
    for i, p in enumerate(R.ADDRESS_PAIR_RULES, start=1):
        shown = F.slice(d.rx_all_guarded(T, p, 0), 1, R.ADDRESS_PAIRS_SHOWN)
        per_rule.append(F.struct(F.lit(i).alias("rule_no"), F.transform(shown, _pair_of(rx.java(p))).alias("pairs")))
    r = cur.select("doc_id", F.inline(F.array(*per_rule)))
    return r.select("doc_id", "rule_no", F.posexplode("pairs").alias("pos", "pair")).select(
        "doc_id", "rule_no", (F.col("pos") + 1).alias("pair_no"),
        F.col("pair.street").alias("street"), F.col("pair.city_state_zip").alias("city_state_zip"))


def address_pairs_sql(src: str) -> str:
    parts = []
    for i, p in enumerate(R.ADDRESS_PAIR_RULES, start=1):
        pat = q(rx.re2(p))
        parts.append(
            f"SELECT doc_id, {i} AS rule_no, regexp_extract_all(text, {pat}, 1) AS s, "
            f"regexp_extract_all(text, {pat}, 2) AS c FROM ({src})")
    u = " UNION ALL ".join(parts)
    return (f"SELECT doc_id, rule_no, pair_no, s[pair_no] AS street, c[pair_no] AS city_state_zip "
            f"FROM (SELECT doc_id, rule_no, s, c, unnest(range(1, least(len(s), "
            f"{R.ADDRESS_PAIRS_SHOWN}) + 1)) AS pair_no FROM ({u}) u WHERE len(s) > 0) x")


# --- D4 ----------------------------------------------------------------------
def date_format_census(docs: DataFrame) -> DataFrame:
    """Per date format (case-sensitive): documents containing it, total matches."""
    T = F.col("text")
    arr = F.array(*[F.struct(F.lit(n).alias("format"),
                             F.regexp_count(T, F.lit(rx.java(p, ignorecase=False))).alias("n"))
                    for n, p in R.DATE_FORMAT_CENSUS])
    per = docs.select(F.inline(arr))
    return per.groupBy("format").agg(F.count_if(F.col("n") > 0).alias("docs_hit"),
                                     F.sum("n").cast("bigint").alias("total_matches"))


def date_format_census_sql(src: str) -> str:
    parts = [f"SELECT {q(n)} AS format, len(regexp_extract_all(text, {q(rx.re2('(' + p + ')', False))}, 1)) AS n "
             f"FROM ({src})" for n, p in R.DATE_FORMAT_CENSUS]
    return (f"SELECT format, count(*) FILTER (WHERE n > 0) AS docs_hit, CAST(sum(n) AS BIGINT) AS total_matches "
            f"FROM ({' UNION ALL '.join(parts)}) u GROUP BY format")


# --- D5 ----------------------------------------------------------------------
def candidate_fields(docs: DataFrame) -> DataFrame:
    """Matches of the not-yet-captured candidate fields, per document."""
    T = F.col("text")
    cur, d = with_words(docs.select("doc_id", "text"), [p for _, p in R.CANDIDATE_FIELDS])
    bound = cur.select("doc_id", *[d.rx_all_guarded(T, p).alias(f"_m{k}") for k, (n, p) in enumerate(R.CANDIDATE_FIELDS)])
    arr = F.array(*[F.struct(F.lit(n).alias("field"), F.size(f"_m{k}").alias("n_matches"),
                             F.array_join(f"_m{k}", SEP).alias("matches"))
                    for k, (n, p) in enumerate(R.CANDIDATE_FIELDS)])
    return bound.select("doc_id", F.inline(arr))


def candidate_fields_sql(src: str) -> str:
    parts = []
    for i, (n, p) in enumerate(R.CANDIDATE_FIELDS, start=1):
        all_ = f"regexp_extract_all(text, {q(rx.re2(p))}, 1)"
        parts.append(f"SELECT doc_id, {q(n)} AS field, CAST(len({all_}) AS INTEGER) AS n_matches, "
                     f"array_to_string({all_}, {q(SEP)}) AS matches FROM ({src})")
    return " UNION ALL ".join(parts)


# --- D6 ----------------------------------------------------------------------
def keyword_census(docs: DataFrame) -> DataFrame:
    """Occurrences of each keyword (case-insensitive substring) per document."""
    T = F.col(FOLDED)
    # in the folded text a keyword in any case is the keyword itself: counted by what its removal takes away
    arr = F.array(*[F.struct(F.lit(k).alias("keyword"),
                             F.when(T.isNull(), F.lit(None)).when(F.contains(T, F.lit(k)), F.floor((F.length(T) - F.length(F.replace(T, F.lit(k), F.lit("")))) / len(k)))
                             .otherwise(0).cast("int").alias("occurrences"))
                    for k in R.KEYWORDS])
    return with_folded(docs, "doc_id").select("doc_id", F.inline(arr))


def keyword_census_sql(src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT doc_id, {q(k)} AS keyword, CAST(len(regexp_extract_all(text, {q('(?i)(' + k + ')')}, 1)) AS INTEGER) "
        f"AS occurrences FROM ({src})" for k in R.KEYWORDS)


# --- D7 ----------------------------------------------------------------------
def page_profile(pages: DataFrame) -> DataFrame:
    """Per document: page count, characters, pages without text."""
    return pages.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum(F.length("page_text")).cast("bigint").alias("chars"),
        F.count_if((F.col("page_text").isNull()) | (F.length("page_text") == 0)).alias("empty_pages"))


PAGE_PROFILE_SQL = """SELECT doc_id, count(*) AS pages, CAST(sum(length(page_text)) AS BIGINT) AS chars,
    count(*) FILTER (WHERE page_text IS NULL OR length(page_text) = 0) AS empty_pages
    FROM ({pages}) p GROUP BY doc_id"""


# --- D8 ----------------------------------------------------------------------
def text_preview(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.substring("text", 1, 500).alias("preview_500"),
                       F.substring("text", 1, 1000).alias("preview_1000"),
                       F.length("text").alias("total_chars"))


TEXT_PREVIEW_SQL = """SELECT doc_id, substring(text, 1, 500) AS preview_500,
    substring(text, 1, 1000) AS preview_1000, CAST(length(text) AS INTEGER) AS total_chars FROM ({src})"""


# --- D9 ----------------------------------------------------------------------
def field_fill(records: DataFrame) -> DataFrame:
    """Per field: documents where it was found / not found, and the fill rate.

    One global aggregate (two counters per field), unpivoted to 15 rows.
    """
    agg = records.agg(F.count(F.lit(1)).alias("_n"), *[
        F.count_if(F.col(f).isNotNull()).alias(f"_f{k}") for k, f in enumerate(FIELDS)])
    arr = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_f{k}").alias("found"),
                             (F.col("_n") - F.col(f"_f{k}")).alias("not_found"),
                             F.round(F.col(f"_f{k}") / F.col("_n"), 4).alias("fill_rate"))
                    for k, f in enumerate(FIELDS)])
    return agg.select(F.inline(arr))


def field_fill_sql(records_sql: str) -> str:
    parts = [f"SELECT {q(f)} AS field, {f} IS NOT NULL AS found FROM ({records_sql})" for f in FIELDS]
    return (f"SELECT field, count(*) FILTER (WHERE found) AS found, count(*) FILTER (WHERE NOT found) AS not_found, "
            f"round(avg(CAST(found AS DOUBLE)), 4) AS fill_rate FROM ({' UNION ALL '.join(parts)}) u GROUP BY field")


# --- D10 ---------------------------------------------------------------------
def rule_attribution(docs: DataFrame, rules: RuleSet = LOCAL) -> DataFrame:
    """Per field and rule index: how many documents got their value from it
    (index 0 = the fixed site rule, NULL = no rule produced a value).

    The cascades run as in the extraction, each rule only where none before it
    decided; the columns of their steps tell which one did."""
    cur, d = with_words(docs.select("doc_id", "text"), [p for _, p in steps(rules)])
    plan = build(d, rules, "text", attribute=True)
    cur = staged(cur, plan)
    names = list(plan.attribution)
    cur = settled(cur, [e.cast("int").alias(f"_a{k}") for k, e in enumerate(plan.attribution.values())])
    arr = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_a{k}").alias("rule_no"))
                    for k, f in enumerate(names)])
    return cur.select(F.inline(arr)).groupBy("field", "rule_no").agg(
        F.count(F.lit(1)).alias("documents"))


def rule_attribution_sql(src: str, rules: RuleSet = LOCAL) -> str:
    from ..functions.dialect import SqlX
    d = SqlX()
    plan = build(d, rules, "text", lazy=False)
    sql = f"SELECT doc_id, text FROM ({src}) s0"
    for stage in plan.stages:
        sql = f"SELECT *, {', '.join(d.alias(e, a) for a, e in stage)} FROM ({sql}) s"
    parts = [f"SELECT {q(f)} AS field, CAST({e} AS INTEGER) AS rule_no FROM ({sql}) a"
             for f, e in plan.attribution.items()]
    return (f"SELECT field, rule_no, count(*) AS documents FROM ({' UNION ALL '.join(parts)}) u "
            f"GROUP BY field, rule_no")
