"""Token-ID files: documents compressed one by one with a shared zstandard dictionary, an offset index in each shard."""

from __future__ import annotations

import functools
import os
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import chunks, shared_dir, texts_of, thinned

END_ID = 0
#: Documents that the dictionary is trained on at most, and its size.
DICTIONARY_ROWS, DICTIONARY_BYTES = 1000, 64 << 10
SHARD_BYTES, SHARD_DOCS = 4 << 20, 4096
LEVEL = 3
MAGIC = b"TOKZ0001"

# Latin text, on which the pattern of Python's own regular expressions cuts as the library's does
_PLAIN = re.compile(r"[\t\n\x0b\x0c\r -~\xa0\xa1\xab\xbf-ɏ‐-‧]*\Z")
# the only ASCII signs that the two patterns class differently
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_FAST = re.compile(r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ]+|'(?:[stmd]|re|ve|ll)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    """One library tokenizer per process and path, with its special strings."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t, [x.content for x in t.get_added_tokens_decoder().values()]


class Pieces(dict):
    """Serialized ids of the pre-tokenizer's pieces, each merged once by the library's model; the empty piece is the end id."""

    def __init__(self, merge):
        super().__init__()
        self.merge, self.letters = merge, dict(enumerate(byte_letters()))
        self[""] = struct.pack("<I", END_ID)

    def __missing__(self, piece: str) -> bytes:
        plain = piece if piece.isascii() else piece.encode().decode("latin-1")
        got = array("I", [t.id for t in self.merge(plain.translate(self.letters))])
        if sys.byteorder == "big":
            got.byteswap()
        self[piece] = got = got.tobytes()
        return got


class Encoder:
    """Encodes as the library does; holds the ids of ``size`` pieces at most (about 200 bytes each)."""

    def __init__(self, path: str, size: int = 1_600_000):
        self.size = size
        self.library, self.special = tokenizer(path)
        self.pieces = Pieces(self.library.model.tokenize)

    def serialized(self, text: str) -> bytes:
        """Ids of a text and the end id, as little-endian unsigned 32-bit integers.

        Texts that hold a special token's string go to the library whole, texts
        in other than Latin letters to its pre-tokenizer.
        """
        if len(self.pieces) > self.size:
            self.pieces = Pieces(self.library.model.tokenize)
        if any(s in text for s in self.special):
            return np.array([*self.library.encode(text, add_special_tokens=False).ids, END_ID], dtype="<u4").tobytes()
        if not any(x in text for x in _SEPARATORS) if text.isascii() else _PLAIN.match(text):
            cut = _FAST.findall(text)
        else:
            cut = [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        cut.append("")
        return b"".join(map(self.pieces.__getitem__, cut))


def train_dictionary(docs: DataFrame, path: str, rows: int = DICTIONARY_ROWS) -> bytes:
    """A zstandard dictionary from the serialized ids of the documents with the first ``rows`` ids in the order of a hash.

    Of few or tiny samples, on which the trainer fails, the samples themselves
    are the dictionary; of none it is empty.
    """
    ids = F.broadcast(thinned(docs.select("doc_id"), rows, "doc_id"))  # `rows` ids
    few = docs.join(ids, "doc_id", "left_semi").where("text <> ''").select("text").limit(rows)

    def run(batches):
        encoder = Encoder(path)
        for b in chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([encoder.serialized(t) for t in texts_of(b)], pa.binary())], names=["ids"])

    samples = sorted(bytes(r["ids"]) for r in few.mapInArrow(run, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


def dictionary_hash(dictionary: bytes) -> int:
    return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(dictionary)))[0]


def _options(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def pack(frames: list[bytes], counts: list[int], dictionary: bytes) -> bytes:
    """One shard: magic, dictionary hash, number of documents, frame offsets, token counts, frames."""
    n = len(frames)
    offsets = np.zeros(n + 1, dtype="<u8")
    offsets[1:] = np.cumsum([len(f) for f in frames])
    return b"".join([MAGIC, struct.pack("<qI", dictionary_hash(dictionary), n), offsets.tobytes(),
                     np.array(counts, dtype="<u4").tobytes(), *frames])


class Shard:
    """Reads single documents of a shard: the index tells where a frame stands, only that frame is decompressed."""

    def __init__(self, blob: bytes | memoryview, dictionary: bytes):
        if blob[:8] != MAGIC:
            raise ValueError("not a shard of token ids")
        known, n = struct.unpack_from("<qI", blob, 8)
        if known != dictionary_hash(dictionary):
            raise ValueError("the shard was written with another dictionary")
        self.blob, self.n = blob, n
        self.offsets = np.frombuffer(blob, "<u8", n + 1, 20)
        self.counts = np.frombuffer(blob, "<u4", n, 20 + 8 * (n + 1))
        self.start = 20 + 8 * (n + 1) + 4 * n
        self.reader = zstandard.ZstdDecompressor(**_options(dictionary))

    def raw(self, k: int) -> bytes:
        a, b = self.start + int(self.offsets[k]), self.start + int(self.offsets[k + 1])
        return self.reader.decompress(self.blob[a:b], max_output_size=4 * int(self.counts[k]))

    def raws(self) -> Iterator[bytes]:
        """All documents in order."""
        at, decompress = (self.offsets + self.start).tolist(), self.reader.decompress
        for a, b, n in zip(at, at[1:], self.counts.tolist()):
            yield decompress(self.blob[a:b], max_output_size=4 * n)

    def ids(self, k: int) -> np.ndarray:
        return np.frombuffer(self.raw(k), dtype="<u4")


_SHARD = "part int, seq int, first_token long, n_tokens long, doc_ids array<long>, dictionary_hash long, blob binary"


def write_token_files(docs: DataFrame, folder: str, path: str) -> None:
    """Writes ``folder``/shards (rows of one shard each, ascending by part and seq) and ``folder``/dictionary.

    Documents stand in ascending order of doc_id, null ids first, rows that
    share an id by a hash of the text and then the text.  They are dealt by
    ranges once; each task sorts its range, encodes it and packs bounded
    shards.  Spark's writer commits the files, so that lost tasks leave nothing
    behind, in any store that Spark writes to.
    """
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dictionary = train_dictionary(src, path)
    spark.createDataFrame([(dictionary_hash(dictionary), bytearray(dictionary))], "hash long, bytes binary").coalesce(1) \
        .write.parquet(os.path.join(folder, "dictionary"))
    shipped = spark.sparkContext.broadcast(dictionary)  # DICTIONARY_BYTES

    def run(batches):
        encoder, writer = Encoder(path), zstandard.ZstdCompressor(level=LEVEL, **_options(shipped.value))
        known, part = dictionary_hash(shipped.value), TaskContext.get().partitionId()
        ids, frames, counts, size, seq, first = [], [], [], 0, 0, 0

        def shard():
            total = sum(counts)
            row = [part, seq, first, total, list(ids), known, pack(frames, counts, shipped.value)]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=[
                "part", "seq", "first_token", "n_tokens", "doc_ids", "dictionary_hash", "blob"]), total

        for b in chunks(batches):
            for doc, raw in zip(b.column("doc_id").to_pylist(), map(encoder.serialized, texts_of(b))):
                frame = writer.compress(raw)
                ids.append(doc)
                frames.append(frame)
                counts.append(len(raw) // 4)
                size += len(frame)
                if size >= SHARD_BYTES or len(ids) >= SHARD_DOCS:
                    batch, total = shard()
                    yield batch
                    ids, frames, counts, size, seq, first = [], [], [], 0, seq + 1, first + total
        if ids:
            yield shard()[0]

    (src.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
     .mapInArrow(run, _SHARD).write.parquet(os.path.join(folder, "shards")))


def read_dictionary(spark: SparkSession, folder: str) -> bytes:
    return bytes(spark.read.schema("hash long, bytes binary").parquet(os.path.join(folder, "dictionary")).first()["bytes"])


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_SHARD).parquet(os.path.join(folder, "shards"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the written files.

    ``start`` counts the ids of all documents before it: the sums of the
    earlier parts (one number a part), of the earlier shards of its part, and
    of the earlier documents of its shard.
    """
    shards = read_shards(spark, folder)
    parts = sorted(shards.groupBy("part").agg(F.sum("n_tokens")).collect())  # one row a write task
    base, total = {}, 0
    for part, n in parts:
        base[part], total = total, total + n
    shipped = spark.sparkContext.broadcast((read_dictionary(spark, folder), base))

    def run(batches):
        dictionary, base = shipped.value
        for b in batches:
            for i in range(b.num_rows):
                part, first, ids, blob = (b.column(c)[i] for c in ("part", "first_token", "doc_ids", "blob"))
                s = Shard(memoryview(blob.as_buffer()), dictionary)
                before = np.concatenate([[0], np.cumsum(s.counts, dtype=np.int64)])[:-1]
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(before + base[part.as_py()] + first.as_py()),
                     pa.array(s.counts.astype(np.int64)), pa.array(map(zlib.crc32, s.raws()), pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("part", "first_token", "doc_ids", "blob").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: only shards that hold one are opened, only their frames are decompressed."""
    wanted = set(doc_ids)
    shipped = spark.sparkContext.broadcast((read_dictionary(spark, folder), wanted))

    def run(batches):
        dictionary, wanted = shipped.value
        for b in batches:
            for ids, blob in zip(b.column("doc_ids").to_pylist(), b.column("blob").to_pylist()):
                s = Shard(blob, dictionary)
                for k, doc in enumerate(ids):
                    if doc in wanted:
                        yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([s.ids(k).astype(np.int64)], pa.list_(pa.int64()))],
                                                         names=["doc_id", "ids"])

    some = read_shards(spark, folder).where(F.arrays_overlap("doc_ids", F.array(*[F.lit(int(i)).cast("long") for i in wanted])))
    return some.select("doc_ids", "blob").mapInArrow(run, "doc_id long, ids array<long>")


def token_file_index(docs: DataFrame, path: str, folder: str | None = None) -> DataFrame:
    """Writes ``docs`` to token files (in the shared folder unless one is given) and reads their index back.

    Null and empty texts hold the end id alone; repeated rows are documents of
    their own; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or os.path.join(shared_dir(spark), f"tokens-{uuid.uuid4().hex}")
    write_token_files(docs, folder, path)
    return read_token_files(spark, folder)
