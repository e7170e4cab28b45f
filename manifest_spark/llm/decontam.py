"""Benchmark decontamination: typed templates of benchmark items are found in documents by a hash join of their windows."""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, texts_of, written

#: Tokens of a template window, and the literal (not replaced) ones that it needs.
WINDOW, LITERALS = 8, 5
#: Consistent windows of an item that make a document contaminated (all, if the item has fewer).
WINDOWS = 6
# ways to find an item: some windows, all of a template that has no window of its own, or the text as it stands
PARTS, WHOLE, VERBATIM = 0, 1, 2
#: Plain words that each window needs of a template that must be there as a whole.
WHOLE_LITERALS = 2
FILTER_BITS = 24

# fixed values: units that are replaced after a number or a currency sign's place
UNITS = frozenset("""
% percent mm cm m km inch inches ft feet yard yards mile miles mg g kg lb lbs oz ton tons ml l liter liters litre litres
s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
dollar dollars cent cents euro euros pound pounds usd eur gbp k mb gb tb hz khz mhz ghz w kw v degrees celsius fahrenheit
""".split())
#: Spellings of one unit, the last of each line; as slot values they are the same.
SAME_UNITS = {w: line.split()[-1] for line in """
% percent
inches inch
feet ft
yards yard
miles mile
lbs lb
tons ton
l liters litre litres liter
s sec seconds second
minutes min minute
h hr hours hour
days day
weeks week
months month
years year
usd dollars dollar
cents cent
eur euros euro
pounds pound
""".split("\n") for w in line.split()}

# blocks of scripts without blanks between words: of ideographs, and of letters and syllables
IDEOGRAPHS = ((0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
UNSPACED = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3040, 0x312F), (0x31A0, 0x31BF),
            (0x31F0, 0x31FF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F))

_NUMBER, _NAME, _UNIT, _STOP, _MONEY, _WORD = 1, 2, 3, 4, 5, 0
_SLOTS = {_NUMBER: "<number>", _NAME: "<name>", _UNIT: "<unit>"}
_CODE = {k: np.uint64(xxhash.xxh64_intdigest(v, 3)) for k, v in _SLOTS.items()}
_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_P), -1, 2**64))
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
CHUNK = 1 << 20

# classes of code points
_OTHER, _LETTER, _DIGIT, _SINGLE, _IDEOGRAPH, _SIGN = 0, 1, 2, 3, 4, 5
# words that an ideograph and a sign of another unspaced script stand for
_WORDS = {_IDEOGRAPH: 0.5, _SIGN: 0.25}


@functools.cache
def code_points() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower-case form of every code point (of those that become several signs: themselves)."""
    signs = [chr(c) for c in range(0x110000)]
    kind = np.array([_LETTER if c.isalpha() else _DIGIT if c.isdecimal() else _OTHER for c in signs], dtype=np.uint8)
    for k, blocks in ((_IDEOGRAPH, IDEOGRAPHS), (_SIGN, UNSPACED)):
        kind[[c for a, b in blocks for c in range(a, b + 1) if unicodedata.category(signs[c])[0] in "LM" or c == 0x3007]] = k
    kind[[ord(c) for c in ".!?:;\n%$€£"]] = _SINGLE
    lower = np.array([ord(x) if len(x := c.lower()) == 1 else i for i, c in enumerate(signs)], dtype=np.uint32)
    return kind, lower


class Powers:
    """Powers of the hash's factor and of its inverse, modulo 2**64."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up))
            cls.up, cls.down = (np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size, f))]) for f in (_P, _INVERSE))
        return cls.up[:n], cls.down[:n]


def token_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the code points between ``start`` and ``end``, equal wherever they stand."""
    up, down = Powers.of(len(low) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((low + np.uint64(1)) * up[:len(low)], dtype=np.uint64)])
        h = (total[end] - total[start]) * down[start]
        return (h ^ (h >> np.uint64(29))) * _Q


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


@functools.cache
def unit_hashes() -> np.ndarray:
    words = sorted(UNITS)
    size = np.array([len(w) for w in words])
    end = np.cumsum(size)
    return np.sort(token_hashes(_points("".join(words)).astype(np.uint64), end - size, end))


class Templates:
    """Canonical tokens of a batch of texts: numbers, units after numbers and names inside sentences become slots.

    Tokens are runs of letters, numbers (with points and commas inside) and
    single signs: those that end sentences or mark money, and each sign of a
    script without blanks between words, which is a plain word.  They are found, hashed and
    told apart in whole arrays of code points.
    """

    def __init__(self, texts: list[str]):
        self.line = line = "\n".join(texts) + "\n"  # a line's end parts texts and sentences
        points = _points(line)
        kinds, lower = code_points()
        cls, low = kinds[points], lower[points].astype(np.uint64)
        digit = cls == _DIGIT
        inner = ((points[1:-1] == 46) | (points[1:-1] == 44)) & digit[:-2] & digit[2:]
        cls[1:-1][inner] = _DIGIT
        change = np.concatenate([[True], cls[1:] != cls[:-1]]) | (cls >= _SINGLE)
        start = np.nonzero(change)[0]
        end = np.append(start[1:], len(cls))
        token = cls[start] != _OTHER
        start, end = start[token], end[token]
        script, sign = cls[start], points[start]
        code = token_hashes(low, start, end)
        upper = np.concatenate([[0], np.cumsum((points != low) & (cls == _LETTER))])
        capitals, size = upper[end] - upper[start], end - start
        title = (points[start] != low[start]) & ~((size > 1) & (capitals == size))
        alone = np.select([(sign == 37), np.isin(sign, [36, 0x20AC, 0xA3])], [_UNIT, _MONEY], _STOP)
        letters = np.where(np.isin(code, unit_hashes()), _UNIT, np.where(title, _NAME, _WORD))
        kind = np.select([script == _LETTER, script == _DIGIT, script != _SINGLE], [letters, _NUMBER, _WORD], alone)
        before = np.concatenate([[_STOP], kind[:-1]])
        # a title-case word that starts a sentence, and a unit without a number, are ordinary words
        kind = np.where((kind == _NAME) & (before == _STOP), _WORD, kind)
        kind = np.where((kind == _UNIT) & (before != _NUMBER), _WORD, kind)
        same_name = (kind == _NAME) & np.concatenate([[False], kind[:-1] == _NAME])
        keep = (kind != _STOP) & (kind != _MONEY) & ~same_name
        first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        self.start, self.end, self.same_name = start, end, same_name
        self.raw, self.title = code, title
        # words that are slots only because of what stands before them: they would be plain at a text's start
        self.turned = np.nonzero((kind == _NAME) | (kind == _UNIT))[0]
        self.places = np.nonzero(keep)[0]
        self.kind, self.code = kind[keep].astype(np.int8), code[keep]
        for k, c in _CODE.items():
            self.code[self.kind == k] = c
        self.owner = np.searchsorted(first, start[keep], "right") - 1
        self.said = np.nonzero((kind != _STOP) & (kind != _MONEY))[0]
        self.said_owner = np.searchsorted(first, start[self.said], "right") - 1
        self.said_begin = np.searchsorted(self.said_owner, np.arange(len(texts)))
        self.said_count = np.bincount(self.said_owner, minlength=len(texts))
        self.script = script
        self.turned_owner = np.searchsorted(first, start[self.turned], "right") - 1
        self.begin = np.searchsorted(self.owner, np.arange(len(texts)))
        self.count = np.bincount(self.owner, minlength=len(texts))

    def windows(self, w: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(first tokens, hashes) of all windows of ``w`` tokens inside one text with ``least`` literal tokens."""
        n = len(self.code) - w + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.zeros(n, np.uint64)
        literal = np.zeros(n, np.int8)
        for j in range(w):
            h = (h + self.code[j:j + n]) * _P
            h ^= h >> np.uint64(31)
            literal += self.kind[j:j + n] == _WORD
        ok = (self.owner[:n] == self.owner[w - 1:]) & (literal >= least)
        at = np.nonzero(ok)[0]
        return at, h[at]

    def said_windows(self, w: int) -> tuple[np.ndarray, np.ndarray]:
        """(first tokens, hashes) of all windows of ``w`` tokens as they stand inside one text."""
        n = len(self.said) - w + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        code, h = self.raw[self.said], np.zeros(n, np.uint64)
        for j in range(w):
            h = (h + code[j:j + n]) * _P
            h ^= h >> np.uint64(31)
        at = np.nonzero(self.said_owner[:n] == self.said_owner[w - 1:])[0]
        return at, h[at]

    def words_said(self, i: int, w: int) -> str:
        """The tokens from said place ``i`` on, in lower case."""
        return " ".join(self.line[self.start[p]:self.end[p]] for p in self.said[i:i + w].tolist()).lower()

    def weights(self, ideograph: float) -> tuple[np.ndarray, np.ndarray]:
        """Words that each text's tokens as they stand come to: their sum, and their mean."""
        each = np.ones(6)
        each[[_IDEOGRAPH, _SIGN]] = ideograph, _WORDS[_SIGN]
        total = np.bincount(self.said_owner, each[self.script[self.said]], len(self.said_count))
        return total, total / np.maximum(self.said_count, 1)

    def first_windows(self, w: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, second tokens, hashes) of windows of ``w`` tokens that begin with a word that is a slot here.

        The word is taken as it would be at a text's start, as a plain one;
        a name that it begins goes on without it.
        """
        p = self.turned
        follows = np.append(self.same_name, False)[p + 1]
        s = np.searchsorted(self.places, p, "right") - follows
        ok = s + w - 2 < len(self.code)
        p, s = p[ok], s[ok]
        ok = self.owner[s + w - 2] == self.turned_owner[ok]
        p, s = p[ok], s[ok]
        h = self.raw[p] * _P
        h ^= h >> np.uint64(31)
        literal = np.ones(len(p), np.int8)
        for j in range(w - 1):
            h = (h + self.code[s + j]) * _P
            h ^= h >> np.uint64(31)
            literal += self.kind[s + j] == _WORD
        ok = literal >= least
        return p[ok], s[ok], h[ok]

    def words(self, p: int) -> str:
        """The token (of a name, all its words from there on) at place ``p``, in lower case."""
        words = [self.line[self.start[p]:self.end[p]]]
        while p + 1 < len(self.start) and self.same_name[p + 1]:
            p += 1
            words.append(self.line[self.start[p]:self.end[p]])
        return " ".join(words).lower()

    def describe(self, i: int, w: int, head: int | None = None) -> tuple[str, list[str]]:
        """A window's template and its slot values in order; before canonical place ``i`` with the plain word at place ``head``."""
        at = [int(p) for p in self.places[i:i + w]]
        if head is not None and at[0] <= head:
            at[0] = head + 1
        words = [self.words(p) for p in at]
        kinds = self.kind[i:i + w].tolist()
        slots = [SAME_UNITS.get(x, x) if k == _UNIT else x for k, x in zip(kinds, words) if k != _WORD]
        if head is not None:
            kinds, words = [_WORD, *kinds], [self.line[self.start[head]:self.end[head]].lower(), *words]
        return " ".join(_SLOTS.get(k, x) for k, x in zip(kinds, words)), slots

    def open_name(self, i: int) -> bool:
        """Whether canonical token ``i`` is a name whose words before it depend on what stands before the text.

        It follows its text's first word, which is title-case: in the middle
        of a sentence both are one name.
        """
        b = int(self.begin[self.owner[i]])
        return i == b + 1 and self.kind[i] == _NAME and self.kind[b] == _WORD and bool(self.title[self.places[b]])


_WINDOW_TYPE = "id long, way int, size int, h long, pos long, template string, slots array<string>, total long, first boolean, weight double, key long"
_ARROW = pa.schema([("id", pa.int64()), ("way", pa.int32()), ("size", pa.int32()), ("h", pa.int64()), ("pos", pa.int64()), ("template", pa.string()),
                    ("slots", pa.list_(pa.string())), ("total", pa.int64()), ("first", pa.bool_()), ("weight", pa.float64()), ("key", pa.int64())])
# hashes of the ways differ, so that each meets only its own bits of the filter
_SALT = {PARTS: np.uint64(0), WHOLE: np.uint64(0xA0761D6478BD642F), VERBATIM: np.uint64(0xE7037ED1A0B428DB)}
WAYS = [*((PARTS, w) for w in range(LITERALS, WINDOW + 1)), (WHOLE, WINDOW), *((VERBATIM, w) for w in range(LITERALS, WINDOW + 1))]


def _least(way: int, w: int) -> int:
    return min(w, LITERALS) if way == PARTS else WHOLE_LITERALS


def _batch(rows):
    cols = list(zip(*rows)) if rows else [[]] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def _seen(ids, t: Templates, ways: list[tuple[int, int]], keep):
    """Windows of documents that the filter lets through."""
    rows = []

    def some(way, h, *places):
        h = h ^ _SALT[way]
        hit = keep[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
        return zip(h[hit].view(np.int64).tolist(), *(p[hit].tolist() for p in places))

    for way, w in ways:
        if way == VERBATIM:
            at, h = t.said_windows(w)
            for x, i in some(way, h, at):
                o = int(t.said_owner[i])
                rows.append((ids[o], way, w, x, i - int(t.said_begin[o]), t.words_said(i, w), [], 0, False, 1.0, 0))
            continue
        head, at, h = t.first_windows(w, _least(way, w))
        for x, p, i in some(way, h, head, at):
            o = int(t.owner[i])
            rows.append((ids[o], way, w, x, i - 1 - int(t.begin[o]), *t.describe(i, w - 1, p), 0, True, 1.0, 0))
        at, h = t.windows(w, _least(way, w))
        for x, i in some(way, h, at):
            o = int(t.owner[i])
            rows.append((ids[o], way, w, x, i - int(t.begin[o]), *t.describe(i, w), 0, False, 1.0, 0))
    return _batch(rows)


def _cover(at, owner, begin, count, w):
    """Of windows at ``at`` those that cover their text: each ``w`` tokens, and the last ones."""
    pos = at - begin[owner]
    return (pos % w == 0) | (pos == count[owner] - w)


def _held(ids, texts, t: Templates):
    """Windows of items by each way that holds for the item."""
    rows, n = [], len(ids)
    enough = t.weights(1.0)[0] >= LITERALS
    mean = t.weights(_WORDS[_IDEOGRAPH])[1]
    plain = np.bincount(t.owner[t.kind == _WORD], minlength=n)
    parts = np.zeros(n, bool)
    for way, w in WAYS:
        if way == VERBATIM:
            at, h = t.said_windows(w)
            owner, begin, count = t.said_owner[at], t.said_begin, t.said_count
            some = enough[owner] & _cover(at, owner, begin, count, w)
        else:
            at, h = t.windows(w, _least(way, w))
            owner, begin, count = t.owner[at], t.begin, t.count
            some = enough[owner]
            if way == WHOLE:
                cover = _cover(at, owner, begin, count, w)
                every = np.bincount(owner[cover], minlength=n) == -(-count // w)
                some = some & cover & (~parts & (plain >= LITERALS) & every)[owner]
        if way != WHOLE:
            some = some & ((count[owner] >= WINDOW) if w == WINDOW else (count[owner] == w))
        at, h, owner = at[some], h[some] ^ _SALT[way], owner[some]
        totals = np.bincount(owner, minlength=n)
        if way == PARTS:
            parts |= totals > 0
        for i, x, o in zip(at.tolist(), h.view(np.int64).tolist(), owner.tolist()):
            if way == VERBATIM:
                template, slots = t.words_said(i, w), []
            else:
                template, slots = t.describe(i, w)
                if t.open_name(i):
                    slots[0] = None
            # parts of several texts of one id count together, whole texts do not
            key = 0 if way == PARTS else xxhash.xxh64_intdigest(texts[o].encode("utf-8", "surrogatepass")) >> 1
            rows.append((ids[o], way, w, x, i - int(begin[o]), template, slots, int(totals[o]), False, float(mean[o]), key))
    return _batch(rows)


def template_windows(rows: DataFrame, id_col: str, ways: list[tuple[int, int]] = WAYS, keep=None) -> DataFrame:
    """Windows of each row's text as an item's; with a filter ``keep`` as a document's, only those that it lets through.

    A document's windows also begin with a plain word in place of a slot
    (``first``), as they do where the word is a text's first one.  An item's
    slots that depend on what stands before the text are null.
    """
    def run(batches):
        for b in chunks(batches, max_bytes=CHUNK):
            ids, texts = b.column("id").to_pylist(), texts_of(b)
            yield _held(ids, texts, Templates(texts)) if keep is None else _seen(ids, Templates(texts), ways, keep.value)

    src = rows.select(F.col(id_col).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, _WINDOW_TYPE)


#: Of an alignment with clashing values, the least share of windows that must agree.
SHARE = (2, 3)


def _consistent(w, v):
    """Places of the windows ``w`` (place, v) of an alignment whose slot values ``v`` (x, y) are one-to-one together.

    Where values clash, pairs are taken by the number of windows that hold
    them, each unless its x or y is taken already; the windows that hold no
    other pairs stay, if they are two thirds of the alignment at least: one
    changed value in a long item is a slip, many make another question.
    """
    clear = (F.size(v) == F.size(F.array_distinct(v["x"]))) & (F.size(v) == F.size(F.array_distinct(v["y"])))
    every = F.flatten(F.transform(w, lambda one: F.array_distinct(one["v"])))
    ranked = F.array_sort(F.transform(v, lambda p: F.struct((-F.size(F.filter(every, lambda o: o == p))).alias("rank"), p["x"].alias("x"), p["y"].alias("y"))))
    free = lambda taken, p: ~F.exists(taken, lambda t: (t["x"] == p["x"]) | (t["y"] == p["y"]))
    taken = F.aggregate(ranked, F.filter(ranked, lambda p: F.lit(False)),
                        lambda acc, p: F.when(free(acc, p), F.concat(acc, F.array(p))).otherwise(acc))
    agrees = lambda one: F.forall(one["v"], lambda p: F.exists(taken, lambda t: (t["x"] == p["x"]) & (t["y"] == p["y"])))
    kept = F.filter(w, agrees)
    return F.when(clear, w["place"]).when(SHARE[1] * F.size(kept) >= SHARE[0] * F.size(w), F.transform(kept, lambda one: one["place"]))


def contaminated(docs: DataFrame, benchmark: DataFrame, windows: int = WINDOWS) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, coverage): benchmark items found in documents.

    An item counts as found if ``windows`` of its windows (or all, if it has
    fewer) stand in the document with consistent slots: along one alignment
    each number, name and unit of the item has one value in the document and
    no two of one kind share a value; spellings of a unit, singular and plural,
    are one value.  Where a few values clash, the windows without them count,
    if they are two thirds of the alignment or more.  An item's first word is a plain one,
    also where it stands inside a sentence and looks like a name or a unit.
    Items of 5 to 7 tokens are one window and must stand as a whole.

    Windows hold five plain words (see LITERALS).  An item of eight tokens or
    more without such a window is found if its whole template stands there
    with consistent slots, provided that it has five plain words in all and
    two in each window of the cover.  Every item is also found where it stands
    word for word with its own numbers, names and units; ``n_windows`` and
    ``item_windows`` are then those of the cover.  In scripts without blanks
    between words each sign is a token; as signs are less than words, more
    windows are asked for (13 words' worth, two ideographs or four other signs
    a word), and an item needs five ideographs or twenty other signs.  Signs
    that are neither letters nor digits are not compared, but for %.

    Items of fewer tokens, null or empty ones cannot be told from ordinary
    phrases and are never found.  Null and empty documents contain nothing; repeated rows give one result; rows with a null
    id are held together under the null id.  Other columns are not read.

    Documents are read once without a shuffle: a filter of fixed size
    (2**24 bits) over the hashes of the benchmark's windows lets few other
    windows through, and those meet the benchmark in a hash join that compares
    whole templates.
    """
    spark = docs.sparkSession
    items = written(template_windows(benchmark.where("text is not null").dropDuplicates(["item_id", "text"]), "item_id"), "templates")
    held = [tuple(r) for r in items.select("way", "size").distinct().orderBy("way", "size").collect()]  # nine at most
    bits = np.zeros(1 << FILTER_BITS, bool)
    buckets = items.select(F.shiftrightunsigned("h", 64 - FILTER_BITS).alias("b")).distinct()
    for r in buckets.toLocalIterator():  # 2**FILTER_BITS numbers at most
        bits[r["b"]] = True
    seen = template_windows(docs, "doc_id", held, spark.sparkContext.broadcast(bits))
    pairs = (seen.select(F.col("id").alias("doc_id"), "way", "h", "size", "template", F.col("pos").alias("doc_pos"), F.col("slots").alias("doc_slots"), "first")
             .join(items.select(F.col("id").alias("item_id"), "way", "h", "size", "template", F.col("pos").alias("item_pos"),
                                F.col("slots").alias("item_slots"), "total", "weight", "key"), ["way", "h", "size", "template"])
             .where("not first or item_pos = 0"))
    values = F.filter(F.arrays_zip(F.col("item_slots").alias("x"), F.col("doc_slots").alias("y")), lambda v: v["x"].isNotNull())
    item = ["doc_id", "item_id", "way", "total", "weight", "key"]
    along = (pairs.groupBy(*item, (F.col("doc_pos") - F.col("item_pos")).alias("shift"))
             # windows and their slots are bounded by the item's length
             .agg(F.collect_set(F.struct(F.col("item_pos").alias("place"), values.alias("v"))).alias("w"))
             .withColumn("v", F.array_distinct(F.flatten("w.v"))))
    found = along.select(*item, "shift", F.explode(F.array_distinct(_consistent(F.col("w"), F.col("v")))).alias("place"))
    # the parts may stand apart, a whole may not
    shift = F.when(F.col("way") != PARTS, F.col("shift"))
    found = found.select(*item, shift.alias("shift"), "place").distinct().groupBy(*item, "shift").agg(F.count(F.lit(1)).alias("n_windows"))
    asked = F.when(F.col("way") == PARTS, F.ceil((windows + WINDOW - 1) / F.col("weight")) - (WINDOW - 1)).otherwise(F.col("total"))
    of_parts = lambda n: F.coalesce(F.max(F.when(F.col("way") == PARTS, F.col(n))), F.max(n))
    return (found.where(F.col("n_windows") >= F.least(asked, F.col("total")))
            .groupBy("doc_id", "item_id").agg(of_parts("n_windows").alias("n_windows"), of_parts("total").alias("item_windows"))
            .withColumn("coverage", F.col("n_windows") / F.col("item_windows")))
