"""BPE encoding and decoding by speculation: greedy tokens, vectorised checks of adjacent pairs, exact merging of what fails."""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, chunks, texts_of

END = "\n"  # stands for the mark of a word's end; never a symbol of a word
NEVER = np.iinfo(np.int64).max

# Latin text, on which the pattern of Python's own regular expressions cuts as the file's does
_PLAIN = re.compile(r"[\t\n\x0b\x0c\r -~\xa0\xa1\xab\xbf-ɏ‐-‧]*\Z")
_FAST = re.compile(r"'(?:[stmd]|re|ve|ll)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 signs for themselves, the rest from 256 on."""
    shown = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordBPE:
    """A word-level byte BPE read from a tokenizer file: lower-cased NFC text, words cut by a pattern, marked word ends."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        mark = spec["model"]["end_of_word_suffix"]
        own = lambda t: t[:-len(mark)] + END if t.endswith(mark) else t
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.text = [""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            self.text[i] = t
        self.number = [str(i) for i in range(size)]
        self.ids = {own(t): i for t, i in vocab.items()}
        self.longest = max(map(len, self.ids))
        self.letters = byte_letters()
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]]
        self.merges = {(a, b): (rank, c) for rank, (a, b, c) in enumerate(pairs)}
        a, b, c = np.array(pairs, dtype=np.int64).T
        key = a << 20 | b
        order = np.argsort(key)
        self.key, self.key_rank = key[order], order
        # of each token: the merge that makes it and its two parts (-1: a letter)
        self.rank, self.left, self.right = (np.full(size, -1, dtype=np.int64) for _ in range(3))
        self.rank[c], self.left[c], self.right[c] = np.arange(len(c)), a, b
        self.whole = self._canonical(a, b, c)

    def _canonical(self, a, b, c) -> np.ndarray:
        """Whether a token's letters merge to just that token."""
        whole = np.ones(len(self.rank), bool)
        whole[c[self.rank[c] != np.arange(len(c))]] = False  # made by two merges: leave it to exact merging
        sound = self.compatible(a, b, made=True)
        for x, y, z, ok in zip(a.tolist(), b.tolist(), c.tolist(), sound.tolist()):
            whole[z] &= ok and whole[x] and whole[y]
        return whole

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.key_rank[at], NEVER // 4)

    def compatible(self, a: np.ndarray, b: np.ndarray, made: bool = False) -> np.ndarray:
        """Whether merging the letters of each a + b ends with the two tokens a, b side by side.

        Both are taken apart backwards in time, the part made last first.
        While a left and a right part stood side by side no merge may have
        joined them before the next event; of equal merges the left one comes
        first.  With ``made`` the last step, in which a and b themselves are
        joined, is allowed.
        """
        a, b = a.copy(), b.copy()
        good = np.ones(len(a), bool)
        before = np.full(len(a), NEVER, dtype=np.int64)
        live = np.arange(len(a))
        first = made
        while len(live):
            x, y = a[live], b[live]
            if not first:
                clash = 2 * self.pair_rank(x, y) < before[live]
                clash &= self.pair_rank(x, y) < NEVER // 4
                good[live[clash]] = False
                live, x, y = live[~clash], x[~clash], y[~clash]
            first = False
            rx, ry = self.rank[x], self.rank[y]
            more = np.maximum(rx, ry) >= 0
            live, x, y, rx, ry = live[more], x[more], y[more], rx[more], ry[more]
            cut_left = rx > ry
            before[live] = np.where(cut_left, 2 * rx, 2 * ry + 1)
            a[live] = np.where(cut_left, self.right[x], x)
            b[live] = np.where(cut_left, y, self.left[y])
        return good

    def greedy(self, word: str) -> list[int] | None:
        """Longest tokens from the left; None if they do not reach the word's end."""
        out, at, n, get = [], 0, len(word), self.ids.get
        while at < n:
            for to in range(min(n, at + self.longest), at, -1):
                if (i := get(word[at:to])) is not None:
                    out.append(i)
                    at = to
                    break
            else:
                return None
        return out

    def exact(self, word: str) -> list[int]:
        """Merges of lowest rank first, leftmost first among equals, until none applies."""
        signs = [*word[:-2], word[-2:]]
        parts = [self.ids[s] for s in signs if s in self.ids]
        merges = self.merges
        while len(parts) > 1:
            rank, at = min((merges.get(p, (NEVER, 0))[0], i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            parts[at:at + 2] = [merges[parts[at], parts[at + 1]][1]]
        return parts

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of words: greedy proposals stand if all adjacent pairs are compatible, other words are merged exactly."""
        letters = self.letters
        marked = [(w if w.isascii() and w.isprintable() else "".join([letters[x] for x in w.encode()])) + END for w in words]
        proposed = [self.greedy(m) for m in marked]
        size = np.array([len(p) if p else 0 for p in proposed], dtype=np.int64)
        flat = np.array([i for p in proposed if p for i in p], dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), size)
        bad = size == 0
        if len(flat):
            bad[owner[~self.whole[flat]]] = True
            inner = owner[1:] == owner[:-1]
            pairs, where = np.unique(flat[:-1][inner] << 20 | flat[1:][inner], return_inverse=True)
            fits = self.compatible(pairs >> 20, pairs & ((1 << 20) - 1))[where]
            bad[owner[1:][inner][~fits]] = True
        return [self.exact(m) if wrong else p for m, p, wrong in zip(marked, proposed, bad.tolist())]

    @functools.cached_property
    def library(self):
        """The library's tokenizer, of which only the normalizer and the pattern are used, for other than Latin text."""
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    def words(self, text: str) -> list[str]:
        if _PLAIN.match(text):
            return _FAST.findall((text if text.isascii() else unicodedata.normalize("NFC", text)).lower())
        text = self.library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, texts: list[str], memo: Memo) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array and the offset of each text."""
        pieces = [[p if p in self.special else self.words(p) for p in (self.split_special.split(t) if "<|" in t else [t])] for t in texts]
        new = memo.missing({w for ps in pieces for p in ps if not isinstance(p, str) for w in p})
        for w, ids in zip(new, self.encode_words(new)):
            memo.young[w] = np.array(ids, dtype="<i4").tobytes()
        get = memo.young.__getitem__
        out = []
        for ps in pieces:
            out.append(b"".join([np.int32(self.special[p]).tobytes() if isinstance(p, str) else b"".join(map(get, p)) for p in ps]))
        size = np.array([len(x) // 4 for x in out], dtype=np.int64)
        return np.frombuffer(b"".join(out), dtype="<i4"), np.concatenate([[0], np.cumsum(size)])

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by blanks, special ones too: the file names no decoder."""
        return " ".join([self.text[i] for i in ids])


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBPE:
    """One tokenizer per process and path."""
    return WordBPE(path)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row's whole text.

    Null and empty texts have no ids; repeated rows give repeated rows; a null
    id stays null; other columns are not read.  No shuffle; a process keeps the
    ids of a bounded number of words.
    """
    def run(batches):
        model, memo = load(path), Memo()
        for b in chunks(batches):
            ids, at = model.encode(texts_of(b), memo)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))],
                names=["doc_id", "n_tokens", "ids"])

    return _source(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids decode to the empty text."""
    def run(batches):
        model = load(path)
        for b in batches:
            texts = [model.decode(x or []) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each whole text encoded, decoded again, and both digested."""
    def run(batches):
        model, memo = load(path), Memo()
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in chunks(batches):
            ids, at = model.encode(texts_of(b), memo)
            lists = [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(at)), pa.array([sha(" ".join([model.number[i] for i in x])) for x in lists]),
                 pa.array([sha(model.decode(x)) for x in lists])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _source(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
