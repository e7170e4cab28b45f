"""Two back ends for one expression vocabulary.

The extraction cascades, fixture rendering and reports are written once
against this small vocabulary.  :class:`SparkX` returns PySpark ``Column``
objects (the engine); :class:`SqlX` returns DuckDB SQL text (the oracle the
driver checks us against).  Both take rule patterns in Python ``re`` syntax
and translate them with :mod:`manifest_spark.functions.regex`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import regex as rx
from .literals import needed
from ..plans.rules import RULE_GUARDS

_WS = r"[\s\x1c-\x1f]"
#: The signs that Python's ``str.strip()`` removes.
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

_ASCII_BLANKS = "".join(c for c in _BLANKS if c.isascii())
_VISIBLE = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in _BLANKS) + "]"


class SparkX:
    """Expression builder producing Spark Columns; ``ascii`` names a column that tells whether the text is ASCII.

    ``index`` is a literal index whose columns stand beside the text.
    """

    name = "spark"

    def __init__(self, ascii: str | None = None, index=None):
        self.ascii, self.index = ascii, index

    # -- basics -----------------------------------------------------------
    def col(self, name: str) -> Column:
        return F.col(name)

    def lit(self, v) -> Column:
        return F.lit(v)

    def null_str(self) -> Column:
        return F.lit(None).cast("string")

    def alias(self, e: Column, name: str) -> Column:
        return e.alias(name)

    def when(self, cases, other=None) -> Column:
        out = None
        for cond, val in cases:
            out = F.when(cond, val) if out is None else out.when(cond, val)
        return out if other is None else out.otherwise(other)

    def coalesce(self, *xs) -> Column:
        return xs[0] if len(xs) == 1 else F.coalesce(*xs)

    def is_null(self, x):
        return x.isNull()

    def not_null(self, x):
        return x.isNotNull()

    def and_(self, *xs):
        out = xs[0]
        for x in xs[1:]:
            out = out & x
        return out

    def or_(self, *xs):
        out = xs[0]
        for x in xs[1:]:
            out = out | x
        return out

    def not_(self, x):
        return ~x

    def eq(self, a, b):
        return a == b

    def ne(self, a, b):
        return a != b

    def gt(self, a, b):
        return a > b

    def lt(self, a, b):
        return a < b

    def ge(self, a, b):
        return a >= b

    def to_int(self, b):
        return b.cast("int")

    def add(self, *xs):
        out = xs[0]
        for x in xs[1:]:
            out = out + x
        return out

    # -- strings ----------------------------------------------------------
    def concat(self, *xs):
        return F.concat(*xs)

    def substr(self, x, pos: int, n: int):
        return F.substring(x, pos, n)

    def length(self, x):
        return F.length(x)

    def lower(self, x):
        return F.lower(x)

    def contains(self, x, literal: str):
        return F.contains(x, F.lit(literal))

    def startswith_any(self, x, prefixes):
        return self.or_(*[x.startswith(p) for p in prefixes])

    def strip(self, x):
        """Python ``str.strip()``: all Unicode whitespace at both ends."""
        every = F.btrim(x, F.lit(_BLANKS))  # compares an end's sign with each blank
        return every if self.ascii is None else F.when(F.col(self.ascii), F.btrim(x, F.lit(_ASCII_BLANKS))).otherwise(every)

    def is_blank(self, x):
        """Whether ``strip`` leaves nothing; looks no further than the first visible sign."""
        return ~F.regexp_like(x, F.lit(_VISIBLE))

    def collapse(self, x):
        """Python ``' '.join(s.split())`` of an already stripped string."""
        return F.regexp_replace(x, rf"(?U){_WS}+", " ")

    def remove(self, x, s: str):
        return F.replace(x, F.lit(s), F.lit(""))

    # a failed cast raises and catches an exception, so that the many empty captures are kept from it
    def try_double(self, x):
        return F.when(x != "", x.try_cast("double"))

    def try_long(self, x):
        return F.when(x != "", x.try_cast("bigint"))

    def nz(self, x):
        """'' → NULL (a rule that did not match)."""
        return F.when(x != "", x)

    # -- regex ------------------------------------------------------------
    def _by_text(self, form: str, use):
        """``use(form)``; if a column tells ASCII texts, these get the form that is cheaper on them."""
        if self.ascii is None:
            return use(form)
        return F.when(F.col(self.ascii), use(rx.for_ascii(form))).otherwise(use(form))

    def rx(self, text, pattern: str, group: int = 1, ignorecase=True, first_match=True):
        """First match, capture ``group``; '' when there is no match."""
        form = rx.java(pattern, ignorecase, first_match)
        if rx.block_parts(pattern) or rx.seek_parts(pattern):
            return self._by_text(form, lambda f: F.array_join(F.regexp_extract_all(text, F.lit(f), F.lit(1)), ""))
        return self._by_text(form, lambda f: F.regexp_extract(text, f, group))

    def _where_standing(self, text, pattern: str, found, none):
        """``found``, tried only where words stand that each match must hold: by the index, else by the rule's own guard."""
        stands = self.index.stands(pattern) if self.index is not None and pattern in self.index.words else None
        guard = RULE_GUARDS.get(pattern)
        # single signs stand in many texts without a match: the guard is tried where they do
        if guard is not None and (stands is None or not needed(pattern)):
            test = self.rx_test(text, guard)
            stands = test if stands is None else stands & test
        return found if stands is None else F.when(stands, found).otherwise(none)

    def rx_guarded(self, text, pattern: str, group: int = 1):
        """As ``rx``; a rule with words that each match must hold is tried only where they stand."""
        return self._where_standing(text, pattern, self.rx(text, pattern, group), F.lit(""))

    def rx_all_guarded(self, text, pattern: str, group: int = 1):
        return self._where_standing(text, pattern, self.rx_all(text, pattern, group), self.empty_array())

    def rx_all(self, text, pattern: str, group: int = 1, ignorecase=True):
        found = self._by_text(rx.java(pattern, ignorecase), lambda f: F.regexp_extract_all(text, F.lit(f), F.lit(group)))
        return F.array_remove(found, "") if rx.seek_parts(pattern) else found

    def rx_count(self, text, pattern: str, ignorecase=True):
        """Number of matches of a rule that has a group, or of a plain pattern."""
        if rx.seek_parts(pattern):
            return F.size(self.rx_all(text, pattern, 1, ignorecase))
        return self._by_text(rx.java(pattern, ignorecase), lambda f: F.regexp_count(text, F.lit(f)))

    def rx_count_guarded(self, text, pattern: str):
        return self._where_standing(text, pattern, self.rx_count(text, pattern), F.lit(0))

    def rx_test_guarded(self, text, pattern: str):
        return self._where_standing(text, pattern, self.rx_test(text, pattern), F.lit(False))

    def rx_test(self, text, pattern: str, ignorecase=True):
        if rx.block_parts(pattern) or rx.seek_parts(pattern):
            return self.rx(text, pattern, 1, ignorecase) != ""
        return self._by_text(rx.java(pattern, ignorecase, True), lambda f: F.regexp_like(text, F.lit(f)))

    def literal_then(self, text, value, tail: str):
        """``value`` (escaped) followed on the same line by regex ``tail``; a pattern of its own for each value, so tried only where the tail's words stand."""
        pattern = lambda form: F.concat(F.lit(form[:-len(tail)] + r"\Q"), value, F.lit(r"\E.*" + form[-len(tail):]))
        found = self._by_text(rx.JAVA_FLAGS_CI + tail, lambda f: F.regexp_like(text, pattern(f)))
        stands = None if self.index is None or self.index.text is None else self.index.stands(tail)
        return found if stands is None else F.when(stands, found).otherwise(F.lit(False))

    # -- arrays -----------------------------------------------------------
    def lines(self, x):
        """Stripped non-blank lines of an already stripped ``x`` (split on '\\n')."""
        blank = r"[\s\x1c-\x1f&&[^\n]]"
        one = F.regexp_replace(x, rf"(?U)(?<!{blank}){blank}*+\n{_WS}*+", "\n")
        return F.when(x == "", self.empty_array()).when(~F.contains(x, F.lit("\n")), F.array(x)).otherwise(F.split(one, "\n"))

    def first(self, arr):
        return F.try_element_at(arr, F.lit(1))

    def element(self, arr, i: int):
        return F.try_element_at(arr, F.lit(i))

    def rest_joined(self, arr, sep=" "):
        return F.when(F.size(arr) > 1, F.array_join(F.slice(arr, 2, F.size(arr) - 1), sep))

    def size(self, arr):
        return F.size(arr)

    def concat_arrays(self, *arrs):
        return arrs[0] if len(arrs) == 1 else F.concat(*arrs)

    def empty_array(self):
        return F.array().cast("array<string>")

    # -- formatting (fixture rendering) -------------------------------------
    def to_str(self, x):
        return x.cast("string")

    def lpad(self, x, n: int, pad: str):
        return F.lpad(x, n, pad)

    def repeat(self, x, n: int):
        return F.repeat(x, n)

    def fmt_dmy(self, x):
        return F.date_format(x, "dd-MMM-yyyy")

    def fmt_mdy(self, x):
        return F.date_format(x, "M/d/yyyy")

    def fmt_commas(self, x):
        return F.format_number(x, 0)

    def mod(self, x, n: int):
        return x % n

    def join_lines(self, *xs):
        return F.concat_ws("\n", *xs)


def q(s: str) -> str:
    """SQL string literal (standard SQL: no backslash escapes)."""
    return "'" + s.replace("'", "''") + "'"


class SqlX:
    """Expression builder producing DuckDB SQL text (oracle only)."""

    name = "duckdb"

    def col(self, name: str) -> str:
        return name

    def lit(self, v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return repr(v)
        return q(v)

    def null_str(self):
        return "CAST(NULL AS VARCHAR)"

    def alias(self, e, name):
        return f"{e} AS {name}"

    def when(self, cases, other=None):
        body = " ".join(f"WHEN {c} THEN {v}" for c, v in cases)
        tail = f" ELSE {other}" if other is not None else ""
        return f"(CASE {body}{tail} END)"

    def coalesce(self, *xs):
        return xs[0] if len(xs) == 1 else "COALESCE(" + ", ".join(xs) + ")"

    def is_null(self, x):
        return f"({x} IS NULL)"

    def not_null(self, x):
        return f"({x} IS NOT NULL)"

    def and_(self, *xs):
        return "(" + " AND ".join(xs) + ")"

    def or_(self, *xs):
        return "(" + " OR ".join(xs) + ")"

    def not_(self, x):
        return f"(NOT {x})"

    def eq(self, a, b):
        return f"({a} = {b})"

    def ne(self, a, b):
        return f"({a} <> {b})"

    def gt(self, a, b):
        return f"({a} > {b})"

    def lt(self, a, b):
        return f"({a} < {b})"

    def ge(self, a, b):
        return f"({a} >= {b})"

    def to_int(self, b):
        return f"CAST({b} AS INTEGER)"

    def add(self, *xs):
        return "(" + " + ".join(xs) + ")"

    def concat(self, *xs):
        return "(" + " || ".join(xs) + ")"

    def substr(self, x, pos, n):
        return f"substring({x}, {pos}, {n})"

    def length(self, x):
        return f"length({x})"

    def lower(self, x):
        return f"lower({x})"

    def contains(self, x, literal):
        return f"(strpos({x}, {q(literal)}) > 0)"

    def startswith_any(self, x, prefixes):
        return self.or_(*[f"starts_with({x}, {q(p)})" for p in prefixes])

    def strip(self, x):
        return f"regexp_replace({x}, {q(r'^\s+|\s+$')}, '', 'g')"

    def collapse(self, x):
        return f"regexp_replace({x}, {q(r'\s+')}, ' ', 'g')"

    def remove(self, x, s):
        return f"replace({x}, {q(s)}, '')"

    def try_double(self, x):
        return f"TRY_CAST({x} AS DOUBLE)"

    def try_long(self, x):
        return f"TRY_CAST({x} AS BIGINT)"

    def nz(self, x):
        return f"NULLIF({x}, '')"

    def rx(self, text, pattern, group=1, ignorecase=True, first_match=True):
        return f"regexp_extract({text}, {q(rx.re2(pattern, ignorecase))}, {group})"

    def rx_guarded(self, text, pattern, group=1):
        return self.rx(text, pattern, group)

    def rx_all_guarded(self, text, pattern, group=1):
        return self.rx_all(text, pattern, group)

    def rx_all(self, text, pattern, group=1, ignorecase=True):
        return f"regexp_extract_all({text}, {q(rx.re2(pattern, ignorecase))}, {group})"

    def rx_test(self, text, pattern, ignorecase=True):
        return f"regexp_matches({text}, {q(rx.re2(pattern, ignorecase))})"

    def literal_then(self, text, value, tail):
        return f"regexp_matches({text}, '(?i)' || regexp_escape({value}) || {q('.*' + tail)})"

    def lines(self, x):
        return (f"list_filter(list_transform(string_split({x}, chr(10)), "
                f"lambda s: {self.strip('s')}), lambda s: s <> '')")

    def first(self, arr):
        return f"({arr})[1]"

    def element(self, arr, i):
        return f"({arr})[{i}]"

    def rest_joined(self, arr, sep=" "):
        return f"(CASE WHEN len({arr}) > 1 THEN array_to_string(({arr})[2:], {q(sep)}) END)"

    def size(self, arr):
        return f"len({arr})"

    def concat_arrays(self, *arrs):
        out = arrs[0]
        for a in arrs[1:]:
            out = f"list_concat({out}, {a})"
        return out

    def empty_array(self):
        return "CAST([] AS VARCHAR[])"

    def to_str(self, x):
        return f"CAST({x} AS VARCHAR)"

    def lpad(self, x, n, pad):
        return f"lpad({x}, {n}, {q(pad)})"

    def repeat(self, x, n):
        return f"repeat({x}, {n})"

    def fmt_dmy(self, x):
        return f"strftime({x}, '%d-%b-%Y')"

    def fmt_mdy(self, x):
        return f"strftime({x}, '%-m/%-d/%Y')"

    def fmt_commas(self, x):
        return f"format('{{:,}}', {x})"

    def mod(self, x, n):
        return f"({x} % {n})"

    def join_lines(self, *xs):
        return "concat_ws(chr(10), " + ", ".join(xs) + ")"
