"""Secret scans in DataFrame functions only: fixed patterns, and Markov models of random strings against identifiers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import thinned

# fixed values: the base patterns; of `assign` the value is group 2
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Candidates of the Markov models: unbroken runs of so many signs with a digit and a letter.
LEAST = 20
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % LEAST
#: Pieces of a run that is no random string as a whole: parted at = and /, and of what is left also at _ and -.
PIECES = (r"[A-Za-z0-9+_-]{%d,}" % LEAST, r"[A-Za-z0-9+]{%d,}" % LEAST)
#: Most documents and pairs of their words that the models are trained on, and a secret's mean log-likelihood ratio per step.
SAMPLE_ROWS, SAMPLE_PAIRS = 200, 4000
RATIO = 0.9
MARK = "[secret]"

_N = len(ALPHABET)


def _steps(s: Column) -> Column:
    """Numbers of a string's pairs of neighbouring signs, where both are in the alphabet (null: not)."""
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring(s, i, 1)) - 1
    pair = lambda i: F.when((place(i) >= 0) & (place(i + 1) >= 0), place(i) * _N + place(i + 1))
    return F.when(F.length(s) >= 2, F.transform(F.sequence(F.lit(1), F.length(s) - 1), pair))


def labelled_strings(docs: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """(s, y) from SAMPLE_PAIRS pairs of neighbouring words of at most ``limit`` documents: identifiers made of their words (0) and random strings (1).

    Random strings are digests of the words in the alphabets that keys come
    in; identifiers are the words, also joined as snake, kebab and camel case
    and with a number behind them.
    """
    few = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
           )
    few = thinned(few, limit, "doc_id", "text")
    words = few.select(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Za-z]{3,}"), F.lit(0))).alias("w"))
    pairs = words.select(F.explode(F.when(F.size("w") >= 2, F.zip_with(
        F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))).alias("p")
                         ).orderBy(F.xxhash64("p"), "p").limit(SAMPLE_PAIRS)
    a, b = F.col("p.a"), F.col("p.b")
    both = F.concat(a, F.lit(" "), b)
    number = F.pmod(F.xxhash64(a, b), F.lit(1000)).cast("string")
    code = F.base64(F.unhex(F.sha2(both, 512)))
    plain = [a, F.concat_ws("_", F.lower(a), F.lower(b)), F.concat_ws("-", F.lower(a), F.lower(b), number),
             F.concat(F.lower(a), F.initcap(b), number), F.concat_ws("/", a, b), F.concat_ws("_", F.upper(a), F.upper(b))]
    random = [F.substring(code, 1, 40), F.translate(F.substring(code, 41, 40), "+/", "-_"), F.substring(F.sha2(both, 256), 1, 40),
              F.upper(F.substring(F.translate(code, "+/=", ""), 3, 24))]
    row = lambda s, y: F.struct(s.alias("s"), F.lit(y).alias("y"))
    return pairs.select(F.explode(F.array(*[row(s, 0) for s in plain], *[row(s, 1) for s in random])).alias("e")).select("e.*")


def train(docs: DataFrame, limit: int = SAMPLE_ROWS) -> list[float]:
    """Log-likelihood ratios (random against ordinary) of all pairs of signs, from smoothed first-order chains."""
    got = (labelled_strings(docs, limit).select("y", F.explode(_steps(F.col("s"))).alias("step")).where("step is not null")
           .groupBy("y", "step").count().collect())  # two rows a pair of signs at most
    count = {y: [0.0] * (_N * _N) for y in (0, 1)}
    for r in got:
        count[r["y"]][r["step"]] += r["count"]
    chance = {}
    for y, c in count.items():
        total = [sum(c[k * _N:(k + 1) * _N]) for k in range(_N)]
        chance[y] = [(c[i] + 0.5) / (total[i // _N] + 0.5 * _N) for i in range(_N * _N)]
    return [math.log(p / q) for p, q in zip(chance[1], chance[0])]


def _ratio(s: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio of a string's steps; the table is one constant array."""
    ratios = F.split(F.lit(",".join(f"{x:.5f}" for x in table)), ",").cast("array<double>")
    total = F.aggregate(_steps(s), F.lit(0.0), lambda acc, i: acc + F.coalesce(F.get(ratios, i), F.lit(0.0)))
    return total / (F.length(s) - 1)


def _spans(text: Column, pattern: str, hits: Column, kind: str) -> Column:
    """(start, rank, end, kind) of all matches: the text between matches and the matches themselves give the places."""
    rank = KINDS.index(kind)
    between = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    lengths = F.zip_with(between, hits, lambda a, b: F.struct(F.length(a).alias("gap"), F.length(b).alias("size")))
    state = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + x["size"]
        one = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))
        return F.when(x["size"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out")))

    return F.when(F.size(hits) > 0, F.aggregate(lengths, state, step, lambda acc: acc["out"])).otherwise(empty)


def _random(run: Column, text: Column, table: list[float]) -> Column:
    """Spans of the random strings of a candidate run: the whole run, or else its pieces that are random by themselves."""
    good = lambda s: s.rlike("[0-9]") & s.rlike("[A-Za-z]") & (_ratio(s, table) >= RATIO)

    def pieces(pattern):
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        both = F.filter(F.arrays_zip(_spans(text, pattern, hits, "random").alias("s"), hits.alias("text")), lambda p: good(p["text"]))
        return F.transform(both, lambda p: F.struct((run["start"] + p["s"]["start"]).alias("start"), p["s"]["rank"].alias("rank"),
                                                    (run["start"] + p["s"]["end"]).alias("end"), p["s"]["kind"].alias("kind")))

    coarse, fine = map(pieces, PIECES)
    inner = F.filter(fine, lambda p: ~F.exists(coarse, lambda c: (c["start"] < p["end"]) & (p["start"] < c["end"])))
    return F.when(good(text), F.array(run)).otherwise(F.concat(coarse, inner))


def with_spans(docs: DataFrame, table: list[float], text_col: str = "text", prefix: str = "__secret_") -> DataFrame:
    """``docs`` with array columns of spans by kind: prefix + assign, access, hex, random, base and all.

    Each pattern scans the text once; a second scan finds the places, only
    where there are matches.  Random spans that overlap a base span are left
    out.  Places are code points, ends exclusive.
    """
    c = lambda n: F.col(prefix + n)
    text = c("text")
    all_of = lambda p, g=0: F.regexp_extract_all(text, F.lit(p), F.lit(g))
    out = docs.withColumn(prefix + "text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    out = out.withColumns({
        prefix + "h_assign": all_of(ASSIGN), prefix + "h_access": all_of(ACCESS), prefix + "h_hex": all_of(HEX),
        prefix + "h_random": all_of(RUN)})
    value = lambda s: F.regexp_extract(s["text"], ASSIGN, 2)
    found = {k: _spans(text, p, c("h_" + k), k) for k, p in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX))}
    out = out.withColumns({
        prefix + "assign": F.transform(F.filter(F.arrays_zip(found["assign"].alias("s"), c("h_assign").alias("text")),
                                                lambda s: F.length(value(s)) >= 8), lambda s: s["s"]),
        prefix + "access": found["access"], prefix + "hex": found["hex"],
        prefix + "random": F.when(
            F.exists(c("h_random"), lambda x: x.rlike("[0-9]") & x.rlike("[A-Za-z]")),
            F.flatten(F.transform(F.filter(
                F.arrays_zip(_spans(text, RUN, c("h_random"), "random").alias("s"), c("h_random").alias("text")),
                lambda s: s["text"].rlike("[0-9]") & s["text"].rlike("[A-Za-z]")),
                lambda s: _random(s["s"], s["text"], table)))).otherwise(F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>"))})
    out = out.withColumn(prefix + "base", F.sort_array(F.concat(c("assign"), c("access"), c("hex"))))
    out = out.withColumn(prefix + "random", F.filter(c("random"), lambda r: ~F.exists(
        c("base"), lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))))
    return out.withColumn(prefix + "all", F.sort_array(F.concat(c("base"), c("random"))))


def _line(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, table: list[float]) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_spans, spans) of every row's whole text.

    Null and empty texts hold no spans (empty strings, counts of 0); repeated
    rows give repeated rows; a null id stays null; other columns are not read.
    No shuffle and no Python on the executors.
    """
    c = lambda n: F.col("__secret_" + n)
    found = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), table)
    return found.select("doc_id", *[F.size(c(k)).cast("long").alias("n_" + k) for k in KINDS],
                        _line(c("base")).alias("base_spans"), _line(c("all")).alias("spans"))


def redact_secrets(docs: DataFrame, table: list[float]) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by a mark; all columns stay, texts without secrets as they are.

    Overlapping spans become one mark.  ``n_chars``, if there is one, follows
    the new text.
    """
    found = with_spans(docs, table)
    text, spans = F.col("__secret_text"), F.col("__secret_all")
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(MARK))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] < acc["at"], acc["out"]).otherwise(gap).alias("out"))

    clean = F.aggregate(spans, state, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    hit = F.size(spans) > 0
    columns = []
    for name, kind in docs.dtypes:
        old = F.col(f"`{name}`")
        if name == "text":
            old = F.when(hit, clean).otherwise(old)
        elif name == "n_chars":
            old = F.when(hit, F.length(clean)).otherwise(old).cast(kind)
        columns.append(old.alias(name))
    return found.select(*columns)
