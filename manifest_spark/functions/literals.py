"""Literal index of a rule set: words without which a rule cannot match, looked up once per text.

Each rule's pattern is taken apart into sets of words, of each of which any match
must hold one.
The words are looked up in the case-folded text by plain substring search,
which costs a fraction of a regex scan.  Those that several rules need are kept
as the bits of a few numbers, the others are looked up where their rule is
tried.  A rule then runs only on texts in which its words
stand.  The result is the same as without the index, for any rule set.

The search compares wherever a word's first sign stands, which is most of its
cost.  So of a word its end from its rarest sign on is looked up.
"""

from __future__ import annotations

from collections import Counter
from itertools import product
from math import prod
from re import _constants as op, _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of an index that one number tells (so few that the method that looks them up stays small).
BITS = 30
#: Fewer signs do not make a word worth a look.
LEAST = 2
#: Signs of a word that are looked up at least, if it has so many.
KEY = 4
#: Single signs that are worth a look.
RARE = set("/$,#&%*@")
#: Sets that the alternatives of a branch make at most.
COMBINED = 8
#: Signs of running text, commonest first; others are rarer.
_COMMON = " etaoinsrhldc\num.pfgwyb,vkxjqz"
# signs that fold to an ASCII letter where case is ignored, besides A-Z
_FOLDED = ("İıſK", "iisk")


def folded(text: Column, ascii: Column | None = None) -> Column:
    """``text`` such that a word stands in it in any case just if its lower-case form stands in this one."""
    every = F.lower(F.translate(text, *_FOLDED))
    return every if ascii is None else F.when(ascii, F.lower(text)).otherwise(every)


def _fold(s: str) -> str:
    return s.translate(str.maketrans(*_FOLDED)).lower()


def _plain(seq) -> str | None:
    """The string that a sequence of literals spells, None for any other sequence."""
    return "".join(chr(x) for o, x in seq) if all(o is op.LITERAL for o, _ in seq) else None


def key_of(word: str) -> str:
    """The end of a (folded) word from its rarest sign on, by which it is looked up."""
    ends = [word[i:] for i in range(max(1, len(word) - KEY + 1)) if _tells(word[i:])]
    return max(ends or [word], key=lambda e: (_COMMON.find(e[0]) if e[0] in _COMMON else len(_COMMON), len(e)))


def _choices(seq) -> list[frozenset]:
    """Sets of words, of each of which one stands in every match of ``seq``."""
    out, run = [], ""

    def close():
        nonlocal run
        if run:
            out.append(frozenset([run]))
        run = ""

    for o, x in seq:
        if o is op.LITERAL:
            run += chr(x)
            continue
        inner = x[3] if o is op.SUBPATTERN else None
        if inner is not None and len(inner) == 1 and inner[0][0] is op.BRANCH:
            o, x = inner[0]
        if o is op.BRANCH:
            words = [_plain(a) for a in x[1]]
            if all(w is not None for w in words):
                head, run = run, ""
                out.append(frozenset(head + w for w in words))
                continue
            close()
            each = [[c for c in _choices(a) if all(map(_tells, c))] for a in x[1]]
            # one word of any alternative's choices: each combination of them tells, if they are few
            if prod(map(len, each)) > COMBINED:
                each = [[max(cs, key=_worth)] for cs in each]
            out += [frozenset().union(*cs) for cs in product(*each)]
            continue
        close()
        if inner is not None:
            out += _choices(inner)
        elif o in (op.MAX_REPEAT, op.MIN_REPEAT) and x[0] >= 1:
            out += _choices(x[2])
        elif o is op.ASSERT and x[0] == 1:
            out += _choices(x[1])
    close()
    return out


def _tells(word: str) -> bool:
    return len(word) >= LEAST and any(c.isalpha() for c in word)


def _worth(words: frozenset) -> tuple:
    """What a set of words tells: more if its shortest word is longer; of equals, if it has fewer words."""
    return min(map(len, words)), -len(words)


def needed(pattern: str) -> list[frozenset]:
    """Sets of folded words: one word of each stands in every text that ``pattern`` (Python syntax, case ignored) matches."""
    found = [c for c in _choices(_parser.parse(pattern)) if all(_tells(w) for w in c)]
    return list(dict.fromkeys(frozenset(map(_fold, c)) for c in found))


def signs(pattern: str) -> list[frozenset]:
    """Signs that stand in every text that ``pattern`` matches, of those that many texts lack."""
    found = [c for c in _choices(_parser.parse(pattern)) if all(w in RARE for w in c)]
    return list(dict.fromkeys(found))


class LiteralIndex:
    """The words of ``patterns``, those of several patterns as bits of number columns; several rule sets share one index."""

    def __init__(self, patterns, prefix: str = "__words"):
        self.words = {p: [self._keys(each) for each in needed(p) + signs(p)] for p in dict.fromkeys(patterns)}
        self.words = {p: [c for c in dict.fromkeys(sets) if not any(o < c for o in sets)] for p, sets in self.words.items()}
        uses = Counter(w for sets in self.words.values() for w in frozenset().union(*sets))
        self.place = {w: i for i, w in enumerate(sorted(w for w, n in uses.items() if n > 1))}
        self.prefix = prefix
        self.text = None

    @staticmethod
    def _keys(words: frozenset) -> frozenset:
        """What is looked up for one of ``words``: not what holds another one."""
        keys = frozenset(map(key_of, words))
        return frozenset(k for k in keys if not any(o != k and o in k for o in keys))

    def columns(self, text: Column) -> list[Column]:
        """Number columns that tell which words of several patterns stand in ``text`` (a folded one), which is kept for the others."""
        self.text = text
        bit = lambda w, i: F.when(F.contains(text, F.lit(w)), F.lit(1 << i % BITS).cast("long")).otherwise(F.lit(0).cast("long"))
        names = sorted(self.place, key=self.place.get)
        return [sum((bit(w, i) for i, w in enumerate(names[at + 1:at + BITS], 1)), bit(names[at], 0)).alias(f"{self.prefix}{at // BITS}")
                for at in range(0, len(names), BITS)]

    def stands(self, pattern: str) -> Column | None:
        """Whether of each of the pattern's sets of words one stands in the text; None for a pattern that must be tried on all.

        Sets whose words all are known come first.
        """
        out = None
        sets = self.words[pattern] if pattern in self.words else [self._keys(each) for each in needed(pattern)]
        for words in sorted(sets, key=lambda each: len(each - self.place.keys())):
            masks: dict[int, int] = {}
            one = None
            for w in sorted(words):
                if w in self.place:
                    at, bit = divmod(self.place[w], BITS)
                    masks[at] = masks.get(at, 0) | 1 << bit
            for at, m in masks.items():
                c = F.col(f"{self.prefix}{at}").bitwiseAND(F.lit(m).cast("long")) != 0
                one = c if one is None else one | c
            for w in sorted(words - self.place.keys()):
                c = F.contains(self.text, F.lit(w))
                one = c if one is None else one | c
            out = one if out is None else out & one
        return out
