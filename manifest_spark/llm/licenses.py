"""Licence scans: Aho-Corasick finds phrases and tags, a shunting-yard parser evaluates licence expressions."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_of, chunks

# fixed values: base phrases and their labels
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# notice phrases of the method, and what they tell
NOTICE_PHRASES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache-2.0",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl-2.0",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "cc0": "cc0",
    "public domain": "public-domain",
    "isc license": "isc",
    "eclipse public license": "epl",
}

TAG = "spdx license identifier"

# how far a licence restricts use: 0 free, 1 everything reserved
RESTRICTION = {
    "public-domain": 0.05, "cc0": 0.05, "unlicense": 0.05, "0bsd": 0.05,
    "mit": 0.1, "isc": 0.1, "bsd": 0.1, "apache-2.0": 0.15, "zlib": 0.1,
    "cc-by": 0.2, "epl": 0.4, "mpl-2.0": 0.4, "lgpl": 0.4, "cc-by-sa": 0.4,
    "gpl": 0.6, "agpl": 0.7, "cc-by-nd": 0.7, "cc-by-nc": 0.8, "reserved": 1.0,
}
FAMILIES = ("agpl", "lgpl", "gpl", "bsd", "mit", "isc", "mpl-2.0", "apache-2.0", "cc-by-nc", "cc-by-nd", "cc-by-sa",
            "cc-by", "cc0", "epl", "unlicense", "0bsd", "zlib")
UNKNOWN = 0.5
EXCEPTION_RELIEF = 0.5

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_TAG_TEXT = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)", re.I)
_LEXEME = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+\-]*)")
_STRENGTH = {"or": 1, "and": 2, "with": 3}

_automaton = None


def automaton():
    """One automaton per process over all phrases; entries are (label or None for the tag, is base, length)."""
    global _automaton
    if _automaton is None:
        import ahocorasick
        a = ahocorasick.Automaton()
        for phrase, label in NOTICE_PHRASES.items():
            a.add_word(f" {phrase} ", (label, False, len(phrase) + 2))
        for phrase, label in BASE_PHRASES.items():
            a.add_word(f" {phrase} ", (label, True, len(phrase) + 2))
        a.add_word(f" {TAG} ", (None, False, len(TAG) + 2))
        a.make_automaton()
        _automaton = a
    return _automaton


def family(name: str) -> str:
    """The label of a licence id: its family where known, else the id itself in lower case."""
    low = name.lower().rstrip("+")
    for f in FAMILIES:
        if low == f or low.startswith(f + "-") or low.startswith(f.split("-2.0")[0] + "-") and f.endswith("-2.0"):
            return f
    return low


def postfix(text: str) -> list[str]:
    """Shunting yard: the longest well-formed expression at the start of ``text`` in postfix order ([]: none)."""
    out: list[str] = []
    ops: list[str] = []
    good: list[str] = []
    at, operand_next = 0, True
    while m := _LEXEME.match(text, at):
        word, at = m[1], m.end()
        low = word.lower()
        if word == "(":
            if not operand_next:
                break
            ops.append(word)
        elif word == ")":
            if operand_next or "(" not in ops:
                break
            while ops[-1] != "(":
                out.append(ops.pop())
            ops.pop()
        elif low in _STRENGTH:
            if operand_next:
                break
            while ops and ops[-1] != "(" and _STRENGTH[ops[-1]] >= _STRENGTH[low]:
                out.append(ops.pop())
            ops.append(low)
            operand_next = True
            continue
        else:
            if not operand_next:
                break
            out.append(word)
            operand_next = False
        if not operand_next and "(" not in ops:
            good = out + ops[::-1]
    return good


def evaluate(rpn: list[str]) -> tuple[float, set[str]]:
    """Restriction of an expression and its licences: OR lets the user choose the freer side, AND binds to both,
    WITH grants an exception that halves the restriction."""
    stack: list[tuple[float, set[str]]] = []
    for x in rpn:
        if x in _STRENGTH and len(stack) >= 2:
            (rb, lb), (ra, la) = stack.pop(), stack.pop()
            if x == "or":
                stack.append((min(ra, rb), la | lb))
            elif x == "and":
                stack.append((max(ra, rb), la | lb))
            else:
                stack.append((ra * EXCEPTION_RELIEF, la))
        else:
            f = family(x)
            stack.append((RESTRICTION.get(f, UNKNOWN), {f}))
    return stack[-1] if stack else (0.0, set())


def scan(data: bytes) -> tuple:
    """One text: (n_words, n_base, first_word, last_word, base_labels, labels, score, expressions)."""
    words = data.translate(_FOLD).split()
    line = " " + b" ".join(words).decode("latin-1") + " "
    hits = sorted((end + 1 - what[2], what[0] or "", what[1]) for end, what in automaton().iter(line)) if words else []
    if not hits:
        return len(words), 0, None, None, "", "", 0.0, []
    base, places, labels, tagged = set(), [], set(), False
    word = at = 0
    for start, label, is_base in hits:
        word += line.count(" ", at, start)
        at = start
        if not label:
            tagged = True
            continue
        labels.add(label)
        if is_base:
            base.add(label)
            places.append(word)
    score = max((RESTRICTION.get(x, UNKNOWN) for x in labels), default=0.0)
    found = []
    if tagged:
        for m in _TAG_TEXT.finditer(data.decode("utf-8", "replace")):
            if rpn := postfix(m[1]):
                value, names = evaluate(rpn)
                found.append(" ".join(rpn))
                labels |= names
                score = max(score, value)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score, found)


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("expressions", T.ArrayType(T.StringType()))])
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
                    ("score", pa.float64()), ("expressions", pa.list_(pa.string()))])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence notices of every whole text, one row per input row.

    ``n_base`` counts all places of the base phrases, overlapping ones too;
    ``labels`` adds the method's notice phrases and the licences of
    ``SPDX-License-Identifier`` expressions, whose postfix forms are in
    ``expressions``.  ``score`` is the strictest restriction found (0: none
    found, 1: all rights reserved).  A null or empty text has no words and no
    labels (empty strings, null places); repeated rows give repeated rows; a
    null id stays null; other columns are ignored.  The scan is one pass over
    each text with no shuffle.
    """
    def run(batches):
        for b in chunks(batches):
            rows = [scan(t) for t in bytes_of(b)]
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64())] + [pa.array(c, f.type) for c, f in zip(cols, list(_ARROW)[1:])],
                schema=_ARROW)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, SCHEMA)
