"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader, sparse dot products."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, chunks, labelled_sample, texts_of

BITS = 18
#: Most labelled rows that the model learns from.
SAMPLE_ROWS = 6000
EPOCHS = 3
SEED = 7
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
SCALE = 8.0
AGAIN = (1, 2)

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\s\w]+|_+")
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)


def token_codes(token: str) -> tuple[int, int]:
    """Hashes of a token's lower-case form and of its shape (letters by case, digits, or the signs themselves)."""
    first = token[0]
    if first.isalpha():
        shape = "U" if len(token) > 1 and token.isupper() else "T" if first.isupper() else "l"
    else:
        shape = "0" if first.isdigit() else token
    return xxhash.xxh64_intdigest(token.lower(), 1), xxhash.xxh64_intdigest(shape, 2)


def _mix(a: np.ndarray) -> np.ndarray:
    a = a ^ (a >> np.uint64(29))
    a = a * _Q
    return (a >> np.uint64(64 - BITS)).astype(np.int32)


def features(texts: list[str], memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids of all texts in one array, and where each text's ids end.

    Word 1- and 2-grams, shape 1- to 3-grams, and whether a word equals the
    one or two places before; n-grams do not cross texts.
    """
    lists = [_TOKEN.findall(t) for t in texts]
    for k in memo.missing(set().union(*lists)):
        memo.young[k] = token_codes(k)
    get = memo.young.__getitem__
    out, ends, end = [], [], 0
    for tokens in lists:
        if tokens:
            codes = np.array([get(t) for t in tokens], dtype=np.uint64)
            w, s = codes[:, 0], codes[:, 1]
            s2 = s[:-1] * _P + s[1:]
            again = np.concatenate([np.where(w[k:] == w[:-k], np.uint64(2 * k), np.uint64(2 * k + 1)) * _P for k in AGAIN if len(w) > k] + [s[:0]])
            ids = np.concatenate([w, w[:-1] * _P + w[1:], s, s2, s2[:-1] * _P + s[2:] + np.uint64(3), again])
            out.append(_mix(ids))
            end += len(ids)
        ends.append(end)
    return (np.concatenate(out) if out else np.zeros(0, np.int32)), np.array(ends, dtype=np.int64)


def feature_rows(sample: DataFrame) -> DataFrame:
    """(doc_id, y, ids, counts): the distinct feature ids of each sampled text."""
    def run(batches):
        memo = Memo()
        for b in chunks(batches):
            ids, ends = features(texts_of(b), memo)
            parts = [np.unique(x, return_counts=True) for x in np.split(ids, ends[:-1])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), pa.array([p[0] for p in parts], pa.list_(pa.int32())),
                 pa.array([p[1].astype(np.int32) for p in parts], pa.list_(pa.int32()))],
                names=["doc_id", "y", "ids", "counts"])

    return sample.mapInArrow(run, "doc_id long, y int, ids array<int>, counts array<int>")


def train_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """Per-coordinate FTRL over (y, ids, counts), several passes in a fixed random order: (weights, bias)."""
    n = 1 << BITS
    z, g2, w = np.zeros(n), np.zeros(n), np.zeros(n)
    zb = gb = b = 0.0
    order = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            y, ids, counts = rows[k]
            if not len(ids):
                continue
            x = counts * (SCALE / counts.sum())
            p = 1 / (1 + np.exp(-np.clip(b + w[ids] @ x, -30, 30)))
            g = (p - y) * x
            old = g2[ids]
            new = old + g * g
            z[ids] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w[ids]
            g2[ids] = new
            zi = z[ids]
            w[ids] = np.where(np.abs(zi) <= L1, 0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(new)) / ALPHA + L2))
            d = p - y
            zb += d - (np.sqrt(gb + d * d) - np.sqrt(gb)) / ALPHA * b
            gb += d * d
            b = -zb / ((BETA + np.sqrt(gb)) / ALPHA + L2)
    return w.astype(np.float32), float(b)


def fit(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0, limit: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """Weights learned from at most ``limit`` labelled rows outside the held-out fold (zero weights if there are none)."""
    sample = labelled_sample(docs, labels, "quality", mod, rest, limit)
    got = feature_rows(sample).toArrow().sort_by("doc_id").combine_chunks()  # at most `limit` rows of hashed features
    if not got.num_rows:
        return train_ftrl([])
    ids, counts = (got.column(c).chunk(0) for c in ("ids", "counts"))
    at = ids.offsets.to_numpy()
    x, n = ids.values.to_numpy(), counts.values.to_numpy().astype(np.float32)
    y = got.column("y").to_pylist()
    return train_ftrl([(y[k], x[at[k]:at[k + 1]], n[at[k]:at[k + 1]]) for k in range(len(y))])


def score_texts(texts: list[str], weights: np.ndarray, bias: float, memo: Memo) -> np.ndarray:
    ids, ends = features(texts, memo)
    total = np.concatenate([[0.0], np.cumsum(weights[ids], dtype=np.float64)])
    starts = np.concatenate([[0], ends[:-1]])
    n = np.maximum(ends - starts, 1)
    return 1 / (1 + np.exp(-np.clip(bias + (total[ends] - total[starts]) * (SCALE / n), -30, 30)))


def score_quality(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of every row's whole text; ``score`` is the chance of label 1.

    Null and empty texts and texts of blanks have no features and get the
    model's prior.  Repeated rows give repeated rows with equal scores, a null
    id stays null, other columns are not read.  No shuffle.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS floats, whatever the input

    def run(batches):
        weights, bias = shipped.value
        memo = Memo()
        for b in chunks(batches):
            score = score_texts(texts_of(b), weights, bias, memo)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, score double, predicted int")
