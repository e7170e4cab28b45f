"""Rule patterns → the regex dialects that evaluate them.

Rules are written in Python ``re`` syntax.  Spark evaluates them with
``java.util.regex``; the DuckDB oracle with RE2.  The translations here never
change which text a rule captures:

* flags ``(?idU)`` for Java: ``d`` makes only ``\\n`` a line terminator and
  ``U`` gives Unicode classes and case folding, as in Python 3.
* Python's ``\\s`` also matches U+001C..U+001F; Java's Unicode ``\\s`` does
  not, so they are added explicitly.
* Block rules ``HEAD([^\\n]+(?:\\n[^\\n]+)*?)(?=END)`` recurse once per line in
  Java (a repeated group), and a head whose block finds no ``END`` is followed
  by a scan to the next blank line, again and again for each head in it.  They
  are rewritten to an alternation for find-all (:func:`block_scan`): a head
  with its block, whose match takes the rest of the text along, or a head
  without, whose match takes along what can hold no head with a block.
* Seek rules ``HEAD.*?TARGET`` and ``HEAD[^:]*:TARGET`` scan the rest of the
  line (or up to the colon) once for each head in vain, where no target
  follows.  They become an alternation too (:func:`seek_scan`): a head with its
  target, or a head without, which takes along the rest of the gap, as no later
  head in it can have a target either.
* Search rules that begin with a greedy class run ``([C]+`` are anchored at
  run starts with ``(?<![C])``: the leftmost match of such a rule always starts
  at a run start, and testing only run starts turns a quadratic scan of long
  runs into a linear one.  (Not valid for find-all, so only applied to
  first-match rules.)
* Rules that begin with a number before blanks or a word are tried once a run
  of digits (:func:`anchor_number`), not from each digit to its end and back.
* Rules that begin with one of several words, and the rewritten ones, are tried
  only at signs that one of their matches begins with (:func:`first_signs`).
* Short numbers give no digit back where none could follow (:func:`kept_digits`).
"""

from __future__ import annotations

import re
from re import _constants, _parser

JAVA_FLAGS_CI = "(?idU)"
JAVA_FLAGS_CS = "(?dU)"
# on ASCII text the Unicode classes and case rules change no match, and cost more
_ASCII_FLAGS = {JAVA_FLAGS_CI: "(?id)", JAVA_FLAGS_CS: "(?d)"}
_BLOCK = r"([^\n]+(?:\n[^\n]+)*?)(?="
_EXTRA_SPACE = r"\x1c-\x1f"


def _closing_paren(p: str, start: int) -> int:
    """Index of the ')' closing the group whose body starts at ``start``."""
    depth = 1
    i = start
    in_class = False
    while i < len(p):
        c = p[i]
        if c == "\\":
            i += 2
            continue
        if in_class:
            if c == "]":
                in_class = False
        elif c == "[":
            in_class = True
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if depth == 0:
                return i
        i += 1
    raise ValueError(f"unbalanced pattern: {p!r}")


def block_parts(p: str) -> tuple[str, str] | None:
    """(head, end) of a block rule, None for other rules."""
    k = p.find(_BLOCK)
    if k < 0:
        return None
    body = k + len(_BLOCK)
    close = _closing_paren(p, body)
    end = p[body:close]
    first = next(iter(_parser.parse(end)), None)
    if first != (_constants.LITERAL, 10) or close + 1 != len(p):
        raise ValueError(f"a block must reach to the rule's end and its end start at a line break: {p!r}")
    return p[:k], end


# blanks after a head's word; the pieces overlap, so that their splits are tried over and over
_LOOSE = (r"\s*:?\s*\n?\s*", r"\s*(?::\s*)?")
_TAILS = (_LOOSE[1], r"\s*\n\s*", r"\s*")
# the rest of the text, where nothing follows: a greedy run is one loop in Java, a possessive one a call a sign
_REST = "(?s:.*)"


def block_scan(p: str) -> str:
    """A find-all pattern whose first groups, joined, are the first capture of block rule ``p`` (Python syntax).

    The block of a head ends at the first ``END`` or blank line, both of which
    begin with a line break, so that they are looked for there alone.  If there is
    no ``END`` before the blank line, none is there for any later head whose
    block starts before that blank line either.  So such a head takes along
    the lines up to the last one with a visible sign, and of that one all but
    its last 24 signs: every head that starts in there is followed by a visible
    sign before the blank line, which is where its block would start.
    """
    head, end = block_parts(p)
    head = head.replace(*_LOOSE)
    word = next(head[:-len(t)] for t in _TAILS if head.endswith(t))
    block = r"((?>.+(?:(?!\n\n|" + end + r")\n.*)*+))(?=" + end + ")"
    lines = r"(?:.*\n(?:[^\S\n]+\n)*+(?=[^\S\n]*\S))*+"
    inside = r"(?:.*(?=.{23}\S))?+"
    return f"{head}{block}{_REST}|(?={head}.){word}{lines}{inside}"


#: How a gap is written, and the signs it may hold.
_GAPS = {".*?": r"[^\n]", "[^:]*": "[^:]"}
_PLAIN_HEAD = re.compile(r"(?:\(\?:)?[\w /&|]+\)?")


def _first_group(parsed):
    """The parsed body of group 1."""
    for o, x in parsed:
        if o is _constants.SUBPATTERN:
            return x[3] if x[0] == 1 else _first_group(x[3])
    return None


def seek_parts(p: str) -> tuple[str, str] | None:
    """(head, gap) of a rule that seeks a target behind a head of plain words, None for other rules."""
    found = min(((p.find(g), g) for g in _GAPS if g in p), default=None)
    if found is None or not _PLAIN_HEAD.fullmatch(p[:found[0]].replace(r"\s*", "")):
        return None
    body = _first_group(_parser.parse(p))
    if body is None or not body.getwidth()[0]:
        return None  # an empty capture could not be told from a head without a target
    return p[:found[0]], found[1]


def seek_scan(p: str, once: bool) -> str:
    """A find-all pattern whose non-empty first groups are the first captures of seek rule ``p`` (Python syntax).

    A head without a target takes along the rest of its gap: a target there
    would be the first head's, too.  Only a head that begins in the gap and
    ends behind it, over a line break between its words, is left standing.
    With ``once`` the first match takes along the rest of the text.
    """
    head, gap = seek_parts(p)
    words = head.split(r"\s*")
    begun = [r"\s*".join(words[:i]) + r"[\s&&[^\n]]*\n" for i in range(1, len(words))] if gap == ".*?" else []
    rest = f"(?:(?!{'|'.join(begun)}){_GAPS[gap]})*+" if begun else f"{_GAPS[gap]}*+"
    return f"{p}{_REST if once else ''}|{head}{rest}"


_RUN_START = re.compile(r"^\((\[[^\]]+\])\+")
_RUN_WORDS = re.compile(r"^(\(\[[^\]]+\]\+)\(\?:([A-Za-z]+(?:\|[A-Za-z]+)+)\)(?![?*{])")


def anchor_run_start(p: str, ignorecase: bool = True) -> str:
    """Prefix a first-match rule ``([C]+...`` with ``(?<![C])``; words behind the run are tried at their first signs only."""
    m = _RUN_START.match(p)
    if not m:
        return p
    words = _RUN_WORDS.match(p)
    q = f"{words[1]}{_at(first_signs(words[2], ignorecase))}{p[words.end(1):]}" if words else p
    return "(?<!" + m.group(1) + ")" + q


def _first(seq) -> tuple[set | None, bool]:
    """Signs that matches of a parsed sequence begin with (None: others than plain signs), and whether it matches nothing, too."""
    out: set = set()
    for o, x in seq:
        if o is _constants.LITERAL:
            return out | {chr(x)}, False
        if o is _constants.SUBPATTERN and not (x[1] or x[2]):
            signs, empty = _first(x[3])
        elif o is _constants.BRANCH:
            each = [_first(a) for a in x[1]]
            signs = None if any(s is None for s, _ in each) else set().union(*(s for s, _ in each))
            empty = any(e for _, e in each)
        elif o is _constants.MAX_REPEAT:
            signs, empty = _first(x[2])
            empty = empty or x[0] == 0
        else:
            return None, False
        if signs is None:
            return None, False
        out |= signs
        if not empty:
            return out, False
    return out, True


def first_signs(p: str, ignorecase: bool = True) -> str:
    """The signs that every match of ``p`` (Python syntax) begins with one of; none if these are not a few ASCII letters."""
    signs, empty = _first(_parser.parse(p))
    if not signs or empty or not all(c.isascii() and c.isalpha() for c in signs):
        return ""
    return "".join(sorted({c.lower() for c in signs} if ignorecase else signs))


def _at(signs: str) -> str:
    """A test for one of ``signs``, which costs less than to try several words."""
    return f"(?=[{signs}])" if signs else ""


_SHORT_NUMBER = re.compile(r"^\(\\d\{\d+,([3-9])\}(?!\+)")


def kept_digits(p: str) -> str:
    """A rule that begins with a number of up to three to nine digits: it gives back none of them where what follows begins with none.

    A match with fewer digits would have to go on with a digit.
    """
    m = _SHORT_NUMBER.match(p)
    return f"{m[0]}+{p[m.end():]}" if m and not _digit_first(_parser.parse("(" + p[m.end():]))[0] else p


def _digit_first(seq) -> tuple[bool, bool]:
    """Whether what ``seq`` matches may begin with a digit (as far as can be told), and whether it may be empty."""
    for o, x in seq:
        if o is _constants.LITERAL:
            return chr(x).isdigit(), False
        if o is _constants.IN:
            plain = all(k is _constants.LITERAL and not chr(v).isdigit() or (k, v) == (_constants.CATEGORY, _constants.CATEGORY_SPACE) for k, v in x)
            return not plain, False
        if o is _constants.AT and x in (_constants.AT_END, _constants.AT_END_STRING):
            return False, False
        if o is _constants.SUBPATTERN:
            digit, empty = _digit_first(x[3])
        elif o is _constants.BRANCH:
            each = [_digit_first(a) for a in x[1]]
            digit, empty = any(d for d, _ in each), any(e for _, e in each)
        elif o in (_constants.MAX_REPEAT, _constants.MIN_REPEAT):
            digit, empty = _digit_first(x[2])
            empty = empty or x[0] == 0
        else:
            return True, False
        if digit or not empty:
            return digit, False
    return False, True


_WORD = r"[A-Za-z]{2,}\??"
_NUMBER = re.compile(rf"\(\\d\+(?=\\s\+|\)\\s\*(?:\(\?:{_WORD}(?:\|{_WORD})*\)(?![?*{{])|[A-Za-z]{{2,}}))")


def anchor_number(p: str) -> str:
    """Rules ``(\\d+\\s+...`` and ``(\\d+)\\s*WORD`` with their number in one piece, tried once a run of digits.

    What follows holds no digit at its start, so that a part of the run never
    matches, and a match from a later digit of the run matches from its first
    one, too, or from the place where the match before ended in it.
    """
    m = _NUMBER.match(p)
    return rf"(?=\d)(?:(?<!\d)|\G){m[0]}+{p[m.end():]}" if m else p


def _python_whitespace(p: str) -> str:
    out = []
    i = 0
    in_class = False
    while i < len(p):
        c = p[i]
        if c == "\\" and i + 1 < len(p):
            tok = p[i:i + 2]
            if tok == r"\s":
                out.append(r"\s" + _EXTRA_SPACE if in_class else r"[\s" + _EXTRA_SPACE + "]")
            else:
                out.append(tok)
            i += 2
            continue
        if in_class and c == "]":
            in_class = False
        elif not in_class and c == "[":
            in_class = True
            out.append(c)
            i += 1
            # a ']' right after '[' or '[^' is literal
            if i < len(p) and p[i] == "^":
                out.append("^")
                i += 1
            if i < len(p) and p[i] == "]":
                out.append("]")
                i += 1
            continue
        out.append(c)
        i += 1
    return "".join(out)


def java(p: str, ignorecase: bool = True, first_match: bool = False) -> str:
    """Java-regex form of a Python-syntax rule pattern (of a block or seek rule: its find-all form)."""
    signs = _at(first_signs(p, ignorecase))
    if block_parts(p):
        q = f"{signs}(?:{block_scan(p)})" if signs else block_scan(p)
    elif seek_parts(p):
        q = f"{signs}(?:{seek_scan(p, first_match)})" if signs else seek_scan(p, first_match)
    elif signs and p.startswith("(?:"):
        q = f"{signs}(?:{p})"  # a word alone is as quickly tried as its first sign
    else:
        q = anchor_number(kept_digits(anchor_run_start(p, ignorecase) if first_match else p))
    return (JAVA_FLAGS_CI if ignorecase else JAVA_FLAGS_CS) + _python_whitespace(q)


_FLAG_S = re.compile(r"\(\?[a-zA-Z]*s")


def _class_end(q: str, start: int) -> int:
    """Index behind the class that begins at ``start``, as Java reads it (classes stand in classes)."""
    depth, i = 0, start
    while True:
        if q[i] == "\\":
            i += 1
        elif q[i] == "[":
            depth += 1
        elif q[i] == "]":
            depth -= 1
        i += 1
        if not depth:
            return i


def _listed(cls: str, ignorecase: bool) -> str:
    """A class as the list of its ASCII signs: Java looks them up in one table, but asks each range and set in turn.

    Negated classes and those in which Java sees more than Python stay as they are.
    """
    if cls[1] in "^]" or "[" in cls[1:] or "&&" in cls:
        return cls
    holds = re.compile(cls, re.ASCII | (re.IGNORECASE if ignorecase else 0)).fullmatch
    signs = [c for c in map(chr, range(128)) if holds(c) and not (ignorecase and c.isupper())]
    return "[" + "".join(c if c.isalnum() else f"\\x{ord(c):02x}" for c in signs) + "]"


def for_ascii(q: str) -> str:
    """A translated pattern in the form for ASCII text."""
    flags = next(f for f in _ASCII_FLAGS if q.startswith(f))
    q = q[len(flags):]
    dot = not _FLAG_S.search(q.replace(_REST, ""))  # there, only \n ends a line
    out, i = [_ASCII_FLAGS[flags]], 0
    while i < len(q):
        end = i + (2 if q[i] == "\\" else 1)
        if q[i] == "[":
            end = _class_end(q, i)
            out.append("." if dot and q[i:end] == r"[^\n]" else _listed(q[i:end], flags == JAVA_FLAGS_CI))
        else:
            out.append(q[i:end])
        i = end
    return "".join(out)


def re2(p: str, ignorecase: bool = True) -> str:
    """RE2 (DuckDB) form: lookaheads become plain groups (same group 1)."""
    q = p.replace("(?=", "(?:")
    return ("(?i)" if ignorecase else "") + q

