"""Toxicity: a noisy channel restores obfuscated words (Viterbi over character lattices), then the restored text is scored."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, chunks, labelled_rows, texts_of, written

#: Most word features that the model may hold.
MAX_FEATURES = 4000
#: Counters that a task holds before it hands them on.
MOST_COUNTERS = 500_000
#: A feature must stand in so many toxic texts, and so large a part of its texts must be toxic.
MIN_TOXIC, MIN_SHARE = 5, 0.9
#: Texts counted against each feature besides those seen.
DOUBT = 1
PREFIXES = (4, 5, 6, 7)
SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))
ORDER = 4

# what an obfuscated sign may stand for
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e"}
FILLERS = "._-*~'"
KEEP, SWAP, DROP, REPEAT = math.log(0.9), math.log(0.3), math.log(0.5), math.log(0.6)

_WORDS = re.compile(r"[^\W\d_]+")
_EDGES = re.compile(r"^[^\w@$!]+|[^\w@$]+$")
_RUNS = re.compile(r"^([@$!+|])\1+|([@$!+|])\2+$")
_ODD = re.compile(r"[^\W\d_][0-9@$!|+€]|[0-9@$!|+€][^\W\d_]|([^\W\d_])\1\1|^[^\W_](?:[._*~\-][^\W_]){2,}$")
_SPACED = re.compile(r"(?<!\S)\w(?: \w){3,}(?!\S)")


class CharModel:
    """Interpolated character n-gram model over words; '^' starts and '$' ends a word."""

    def __init__(self, counts: dict[str, int]):
        self.next: dict[str, Counter] = defaultdict(Counter)
        for gram, n in counts.items():
            for k in range(len(gram)):
                self.next[gram[k:-1]][gram[-1]] += n
        self.total = {c: sum(x.values()) for c, x in self.next.items()}
        self.cache: dict[tuple[str, str], float] = {}

    @classmethod
    def shipped(cls, nexts: dict[str, Counter]) -> "CharModel":
        model = cls({})
        model.next, model.total = nexts, {c: sum(x.values()) for c, x in nexts.items()}
        return model

    def logp(self, context: str, letter: str) -> float:
        key = (context, letter)
        if (got := self.cache.get(key)) is None:
            p = 1e-4
            for k in range(len(context) + 1):
                c = context[len(context) - k:]
                if n := self.total.get(c):
                    mix = n / (n + 3.0)
                    p = (1 - mix) * p + mix * self.next[c].get(letter, 0) / n
            got = self.cache[key] = math.log(max(p, 1e-9))
        return got


def lattice(core: str) -> list[list[tuple[str, float]]]:
    """For each sign of a token the letters it may stand for ('' drops it), with channel log-probabilities."""
    out = []
    for i, c in enumerate(core):
        if c.isalpha():
            options = [(c, KEEP)]
            run = i > 0 and core[i - 1] == c and (core[i - 2:i - 1] == c or core[i + 1:i + 2] == c)
            if run:
                options.append(("", REPEAT))
        else:
            options = [(x, SWAP) for x in LEET.get(c, "")]
            if c in FILLERS or c == " " or (i and core[i - 1] == c):
                options.append(("", DROP))
            if not options:
                options = [("", DROP * 4)]
        out.append(options)
    return out


def restore(core: str, model: CharModel) -> str:
    """The likeliest word behind ``core``: Viterbi with the last letters as states."""
    states = {"^" * (ORDER - 1): (0.0, "")}
    for options in lattice(core):
        after: dict[str, tuple[float, str]] = {}
        for context, (score, text) in states.items():
            for letter, cost in options:
                s = score + cost + (model.logp(context, letter) if letter else 0.0)
                c = (context + letter)[-(ORDER - 1):]
                t = text + letter
                if c not in after or (s, t) > after[c]:
                    after[c] = (s, t)
        states = after
    return max((s + model.logp(c, "$"), t) for c, (s, t) in states.items())[1]


def words_of(token: str, model: CharModel | None) -> list[str]:
    """Words of a blank-free lower-case token: its plain letter runs, and the restored word if it looks obfuscated."""
    plain = _WORDS.findall(token)
    if model is not None and (plain or any(c in LEET for c in token)):
        core = _RUNS.sub("", _EDGES.sub("", token))
        if plain and _ODD.search(core):
            back = restore(core, model)
            if back and back not in plain:
                plain.append(back)
    return plain


def spaced_words(text: str, model: CharModel) -> list[str]:
    """Words spelled with single blanks between their letters; a one-letter word may stand before or behind."""
    out = []
    for m in _SPACED.finditer(text):
        out += [restore(x, model) for x in (m[0], m[0][2:], m[0][:-2])]
    return out


def features_of(word: str) -> list[str]:
    return [word] + [word[:k] + "~" for k in PREFIXES if len(word) >= k]


def char_counts(rows: DataFrame) -> dict[str, int]:
    """Character n-grams of the distinct plain words of each text (at most one entry per n-gram of letters)."""
    def run(batches):
        got, memo = Counter(), Memo()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())], names=["gram", "n"])

        for b in chunks(batches):
            words: Counter = Counter()
            for t in texts_of(b):
                tokens = set(t.lower().split())
                for k in memo.missing(tokens):
                    memo.young[k] = [] if _ODD.search(k) else _WORDS.findall(k)
                words.update({w for k in tokens for w in memo.young[k]})
            for w, n in words.items():
                line = "^" * (ORDER - 1) + w + "$"
                for i in range(len(w) + 1):
                    got[line[i:i + ORDER]] += n
            if len(got) > MOST_COUNTERS:
                yield out()
                got.clear()
        yield out()

    grams = rows.mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    return dict(zip(grams.column("gram").to_pylist(), grams.column("n").to_pylist()))


def signatures(rows: DataFrame) -> DataFrame:
    """(doc_id, s): the smallest hashes of each text's 3-word shingles under several seeds."""
    def run(batches):
        for b in chunks(batches):
            out = []
            for t in texts_of(b):
                w = t.split()
                shingles = {" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))}
                h = np.array([xxhash.xxh64_intdigest(x) for x in shingles], dtype=np.uint64)
                out.append([int((h * m).min().view(np.int64)) for m in SEEDS])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "s"])

    return rows.mapInArrow(run, "doc_id long, s array<long>")


def without_copies(rows: DataFrame) -> DataFrame:
    """``rows`` less texts that share a signature with one of a smaller id, so that copies do not vouch for a word."""
    each = signatures(rows).select("doc_id", F.posexplode("s").alias("seed", "h"))
    first = each.groupBy("seed", "h").agg(F.min("doc_id").alias("doc_id"))
    # a text counts if its id is the first at each of its signatures
    own = first.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(SEEDS)).select("doc_id")
    return rows.join(written(own, "toxic-own"), "doc_id")


def feature_counts(rows: DataFrame, model: CharModel) -> DataFrame:
    """(feature, t, n): in how many toxic texts, and in how many texts, each feature of restored words stands."""
    shipped = rows.sparkSession.sparkContext.broadcast(dict(model.next))  # bounded by letters

    def run(batches):
        model, memo = CharModel.shipped(shipped.value), Memo()
        toxic, every = Counter(), Counter()

        def out():
            # features that never stand in a toxic text of this task still count as texts
            return pa.RecordBatch.from_arrays(
                [pa.array(list(every), pa.string()), pa.array([toxic[f] for f in every], pa.int64()), pa.array(list(every.values()), pa.int64())],
                names=["feature", "t", "n"])

        for b in chunks(batches):
            for t, y in zip(texts_of(b), b.column("y").to_pylist()):
                low = t.lower()
                tokens = set(low.split())
                for k in memo.missing(tokens):
                    memo.young[k] = words_of(k, model)
                words = {w for k in tokens for w in memo.young[k]}.union(spaced_words(low, model))
                found = {f for w in words for f in features_of(w)}
                every.update(found)
                if y:
                    toxic.update(found)
            if len(every) > MOST_COUNTERS:
                yield out()
                toxic.clear()
                every.clear()
        yield out()

    return rows.mapInArrow(run, "feature string, t long, n long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, mod: int = 3, rest: int = 1) -> tuple:
    """(character model, chances by feature, chance without any) from all labelled rows outside the held-out fold.

    A feature is a word or a word's beginning that stands almost only in toxic
    texts; its chance is the share of them among its texts, DOUBT more texts
    counted against it.
    """
    rows = written(labelled_rows(docs, labels, "toxic", mod, rest), "toxic-rows")
    model = CharModel(char_counts(rows))
    own = without_copies(rows)
    found = (feature_counts(own, model).where((F.col("t") >= MIN_TOXIC) & (F.col("t") >= MIN_SHARE * F.col("n")))
             .orderBy(F.desc("t"), "feature").limit(MAX_FEATURES).collect())
    chances = {r["feature"]: r["t"] / (r["n"] + DOUBT) for r in found}
    shipped = docs.sparkSession.sparkContext.broadcast((dict(model.next), chances, 0.0))

    def run(batches):
        scorer = Scorer.shipped(shipped.value)
        for b in chunks(batches):
            none = np.array([scorer.score(t) == 0 for t in texts_of(b)], bool)
            y = b.column("y").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([int(y[none].sum())]), pa.array([int(none.sum())])], names=["t", "n"])

    left = own.mapInArrow(run, "t long, n long").agg(F.sum("t"), F.sum("n")).first()
    return model, chances, (left[0] or 0) / ((left[1] or 0) + 1)


class Scorer:
    """Scores whole texts: each distinct restored word is toxic with its best feature's chance, a text if any word is."""

    def __init__(self, model: CharModel, chances: dict[str, float], bias: float):
        self.model, self.chances, self.bias, self.memo = model, chances, bias, Memo()

    @classmethod
    def shipped(cls, parts: tuple) -> "Scorer":
        nexts, chances, bias = parts
        return cls(CharModel.shipped(nexts), chances, bias)

    def weigh(self, words) -> list[tuple[str, float]]:
        get = self.chances.get
        return [(w, c) for w in words if (c := max([get(f, 0.0) for f in features_of(w)])) > 0]

    def score(self, text: str) -> float:
        low = text.lower()
        tokens = set(low.split())
        for k in self.memo.missing(tokens):
            self.memo.young[k] = self.weigh(words_of(k, self.model))
        hits = {pair for pairs in map(self.memo.young.__getitem__, tokens) for pair in pairs}
        hits.update(self.weigh(spaced_words(low, self.model)))
        clean = 1 - self.bias
        for _, c in sorted(hits):
            clean *= 1 - c
        return 1 - clean


def score_toxicity(docs: DataFrame, fitted: tuple, threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) of every row's whole text; ``score`` is the chance of label 1.

    Null and empty texts have no words and get the model's bias.  Repeated
    rows give repeated rows with equal scores, a null id stays null, other
    columns are not read.  No shuffle.
    """
    model, chances, bias = fitted
    shipped = docs.sparkSession.sparkContext.broadcast((dict(model.next), chances, bias))  # bounded by letters and MAX_FEATURES

    def run(batches):
        scorer = Scorer.shipped(shipped.value)
        for b in chunks(batches):
            s = np.array([scorer.score(t) for t in texts_of(b)])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, score double, predicted int")
