"""Language ID: a byte convolutional network trained in numpy, applied to batches of fixed-length windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, fold, thinned

#: Most labelled rows that the network learns from, and most windows of them in a pass.
SAMPLE_ROWS = 3000
SAMPLE_WINDOWS = 24_000
WINDOW = 256
WIDTHS = (2, 3, 4)
STRIDE = WINDOW - max(WIDTHS) + 1
FILTERS = 16
EPOCHS = 3
SEED = 11
UNKNOWN = "und"
CHUNK = 1 << 20

# bytes in 96 classes: 26 letters (either case), digit, blank, apostrophe, other sign, two groups of lead bytes, 64 continuation bytes
CLASSES = 96
_CLASS = np.full(256, 29, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 27
_CLASS[48:58] = 26
_CLASS[39] = 28
for _i in range(26):
    _CLASS[[65 + _i, 97 + _i]] = _i
_CLASS[128:192] = 32 + np.arange(64)
_CLASS[192:256] = 31
_CLASS[0xC3] = 30
BLANK = 27
_LETTER = regex.compile(r"\p{L}")  # category L, as the native rule: signs such as ½ or Ⅷ are no letters


def windows(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte classes of all windows (rows of WINDOW, short ones filled with blanks), the text of each, its bytes.

    Windows overlap by the widest filter less one, so that each n-gram of a text is in a window.
    """
    size = np.array([len(d) for d in data], dtype=np.int64)
    count = np.maximum(1, -(-(size - (WINDOW - STRIDE)) // STRIDE))
    owner = np.repeat(np.arange(len(data)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    first = np.repeat(np.cumsum(size) - size, count) + nth * STRIDE
    held = np.minimum(WINDOW, size[owner] - nth * STRIDE)
    flat = _CLASS[np.frombuffer(b"".join(data) + bytes(1), np.uint8)]
    place = np.arange(WINDOW)[None, :]
    inside = place < held[:, None]
    out = np.where(inside, flat[np.where(inside, first[:, None] + place, 0)], BLANK).astype(np.uint8)
    return out, owner, np.maximum(held, 1)


class Network:
    """Filters of several widths over one-hot byte classes, max pooling, a softmax layer."""

    def __init__(self, languages: list[str], seed: int = SEED):
        r = np.random.default_rng(seed)
        self.languages = languages
        # one table of filter weights per width and offset: a filter over one-hot input is a sum of table rows
        self.taps = {w: (r.normal(size=(w, CLASSES, FILTERS)) * 0.3).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.dense = (r.normal(size=(FILTERS * len(WIDTHS), len(languages))) * 0.2).astype(np.float32)
        self.offset = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.dense, self.offset] + [x for w in WIDTHS for x in (self.taps[w], self.bias[w])]

    def learn(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.02, size: int = 128) -> None:
        """Adam on the cross entropy; the gradient of a pooled filter goes to its best place."""
        r = np.random.default_rng(SEED + 1)
        state = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parameters()]
        step = 0
        for epoch in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(x), size):
                rows = order[at:at + size]
                xb, yb = x[rows], y[rows]
                best, pooled = {}, []
                for w in WIDTHS:
                    n = WINDOW - w + 1
                    a = self.taps[w][0][xb[:, :n]]
                    for j in range(1, w):
                        a += self.taps[w][j][xb[:, j:j + n]]
                    best[w] = a.argmax(1)
                    top = np.take_along_axis(a, best[w][:, None, :], 1)[:, 0]
                    pooled.append(np.tanh(top + self.bias[w]))
                h = np.concatenate(pooled, 1)
                p = softmax(h @ self.dense + self.offset)
                p[np.arange(len(yb)), yb] -= 1
                p /= len(yb)
                back = (p @ self.dense.T) * (1 - h * h)
                grads = [h.T @ p, p.sum(0)]
                for k, w in enumerate(WIDTHS):
                    g = back[:, k * FILTERS:(k + 1) * FILTERS]
                    gt = np.zeros_like(self.taps[w])
                    f = np.broadcast_to(np.arange(FILTERS), g.shape)
                    for j in range(w):
                        np.add.at(gt[j], (np.take_along_axis(xb, best[w] + j, 1), f), g)
                    grads += [gt, g.sum(0)]
                step += 1
                pace = rate * (0.4 ** epoch)
                for q, g, (m, v) in zip(self.parameters(), grads, state):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    q -= pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)

    def fold(self) -> "Folded":
        return Folded(self)


class Folded:
    """The network for prediction: neighbouring offsets share one table over pairs of classes."""

    def __init__(self, net: Network):
        self.languages, self.dense, self.offset = net.languages, net.dense, net.offset
        self.bias = np.concatenate([net.bias[w] for w in WIDTHS])
        pair = lambda t, j: (t[j][:, None, :] + t[j + 1][None, :, :]).reshape(-1, FILTERS)
        t2, t3, t4 = (net.taps[w] for w in WIDTHS)
        self.two, self.three = pair(t2, 0), (pair(t3, 0), np.ascontiguousarray(t3[2]))
        self.four = (pair(t4, 0), pair(t4, 2))

    def logits(self, x: np.ndarray, block: int = 2048) -> np.ndarray:
        out = np.empty((len(x), len(self.languages)), np.float32)
        for at in range(0, len(x), block):
            xb = np.ascontiguousarray(x[at:at + block].T).astype(np.intp)
            n = xb.shape[1]
            pairs = xb[:-1] * CLASSES + xb[1:]
            best = np.full((len(WIDTHS), n, FILTERS), -np.inf, np.float32)
            a, b = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.float32)
            for i in range(WINDOW - 1):
                np.take(self.two, pairs[i], axis=0, out=a, mode="clip")
                np.maximum(best[0], a, out=best[0])
                if i < WINDOW - 2:
                    np.take(self.three[0], pairs[i], axis=0, out=a, mode="clip")
                    np.take(self.three[1], xb[i + 2], axis=0, out=b, mode="clip")
                    a += b
                    np.maximum(best[1], a, out=best[1])
                if i < WINDOW - 3:
                    np.take(self.four[0], pairs[i], axis=0, out=a, mode="clip")
                    np.take(self.four[1], pairs[i + 2], axis=0, out=b, mode="clip")
                    a += b
                    np.maximum(best[2], a, out=best[2])
            h = np.tanh(np.concatenate(list(best), 1) + self.bias)
            out[at:at + n] = h @ self.dense + self.offset
        return out

    def predict(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Language number and its chance for each text: softmax over the window logits' mean by bytes."""
        x, owner, held = windows(data)
        z = np.zeros((len(data), len(self.languages)))
        np.add.at(z, owner, self.logits(x) * held[:, None])
        total = np.zeros(len(data))
        np.add.at(total, owner, held)
        p = softmax(z / total[:, None])
        return p.argmax(1), p.max(1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(docs: DataFrame, mod: int = 4, rest: int = 2, limit: int = SAMPLE_ROWS) -> Folded | None:
    """A network learned from at most ``limit`` documents with a language, outside the held-out fold (None: no such rows).

    The rows are the first in the order of a hash of id and text.  Whole
    texts are cut into windows; if these are more than SAMPLE_WINDOWS, a
    fixed random choice of them is used, together with short pieces, so that
    short texts are met in training too.
    """
    known = (docs.select("doc_id", "text", "lang")
             .where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}")
                    & (fold("doc_id", mod) != rest)))
    got = sorted(thinned(known, limit, "doc_id", "text", "lang").collect())
    if not got:
        return None
    languages = sorted({r["lang"] for r in got})
    data = [r["text"].encode() for r in got]
    y = np.array([languages.index(r["lang"]) for r in got])
    x, owner, held = windows(data)
    r = np.random.default_rng(SEED + 2)
    some = r.permutation(len(x))[:SAMPLE_WINDOWS]
    x, y, held = x[some], y[owner[some]], held[some]
    short = x.copy()
    for row, n in zip(short, held):
        size = int(r.integers(12, 96))
        at = int(r.integers(0, max(1, n - size)))
        piece = row[at:at + size].copy()
        row[:] = BLANK
        row[:len(piece)] = piece
    half = r.random(len(x)) < 0.5
    net = Network(languages)
    net.learn(np.where(half[:, None], short, x), y)
    return net.fold()


def judge(texts: list[str | None], net: Folded | None) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; ``und`` and 0 for texts without a letter, and for all if there is no network."""
    lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    keep = [i for i, t in enumerate(texts) if net is not None and t and _LETTER.search(t)]
    if keep:
        which, chance = net.predict([texts[i].encode() for i in keep])
        for i, k, p in zip(keep, which, chance):
            lang[i], score[i] = net.languages[k], p
    return lang, score


def detect_language(docs: DataFrame, model: Folded | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row's whole text.

    A null text or one without a letter gets ``und`` with score 0, and so
    does every text if nothing could be learned.  Repeated rows give repeated
    rows, a null id stays null, other columns are not read.  No shuffle.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size

    def run(batches):
        for b in chunks(batches, max_bytes=CHUNK):
            lang, score = judge(b.column("text").to_pylist(), shipped.value)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, lang_pred string, score double")


def with_language(docs: DataFrame, model: Folded | None, least: float) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose text has a known language with a score of ``least`` or more.

    If nothing could be learned, no text can be judged and all rows with a
    letter in their text stay.  No shuffle.
    """
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            for part in chunks([pa.RecordBatch.from_arrays([b.column(at), pa.array(np.arange(b.num_rows))], names=["text", "row"])], max_bytes=CHUNK):
                lang, score = judge(part.column("text").to_pylist(), shipped.value)
                rows = part.column("row").to_numpy()[(np.array(lang) != UNKNOWN) & (score >= least)]
                if len(rows):
                    yield b.take(pa.array(rows))

    return docs.mapInArrow(run, docs.schema)
