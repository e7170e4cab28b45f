"""Whitening, filter audit and parity join against brute force, and over odd rows."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from manifest_spark.llm import filter_audit, parity_join, whitening
from manifest_spark.llm.common import table

SF = "/root/testdata/sf0.001"


# ---- op11 --------------------------------------------------------------------------

def covariance(n, d, seed):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)) * rng.exponential(3, d)
    x -= x.mean(0)
    return x.T @ x / n


@pytest.mark.parametrize("n,d", [(500, 64), (5, 64), (200, 3), (2, 2), (1, 4), (40, 30)])
def test_leading_eigenpairs(n, d):
    c = covariance(n, d, n + d)
    e, y = whitening.leading(c, 8)
    want = np.linalg.eigvalsh(c)[::-1]
    assert len(e) == min(8, d, n - 1)
    assert np.abs(e - want[:len(e)]).max(initial=0) < 1e-13 * max(want[0], 1e-9)
    assert np.abs(y.T @ y - np.eye(len(e))).max(initial=0) < 1e-12
    assert np.abs(c @ y - y * e).max(initial=0) < 1e-12 * max(np.trace(c), 1e-9)


def test_equal_and_close_eigenvalues():
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((40, 40)))[0]
    for values in (np.ones(40), np.r_[5, 5, 5, np.ones(37)], np.r_[1 + 1e-9 * np.arange(12), np.linspace(0, 0.5, 28)]):
        c = (q * values) @ q.T
        e, y = whitening.leading((c + c.T) / 2, 8)
        assert np.allclose(e, np.sort(values)[::-1][:8], rtol=1e-12)
        assert np.abs(c @ y - y * e).max() < 1e-12
    assert len(whitening.leading(np.zeros((4, 4)), 8)[0]) == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(0, 10 ** 6))
def test_inertia_counts(d, seed):
    rng = np.random.default_rng(seed)
    m = rng.integers(-3, 4, (d, d)).astype(float)
    m += m.T
    t = float(rng.standard_normal())
    assert whitening.above(whitening.tridiagonal(m), t) == (np.linalg.eigvalsh(m) > t).sum()


def whitened(rows):
    """Brute force in Python integers: {vec_id: (deviation, x - S/n)}, covariance, n."""
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in v] for _, v in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    y = [[n * a - b for a, b in zip(r, s)] for r in x]
    c = np.array(y, dtype=float) / n
    return [sum(a * a for a in r) for r in y], c, c.T @ c / n


def test_whitening_against_numpy(spark):
    vectors = table(spark, SF, "embeddings")
    model = whitening.fit(vectors)
    got = whitening.whiten(vectors, model).collect()
    rows = sorted((r["vec_id"], r["embedding"]) for r in vectors.collect())
    dev, c, cov = whitened(rows)
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    want = c @ u / np.sqrt(e)
    at = {v: i for i, (v, _) in enumerate(rows)}
    w = np.zeros_like(want)
    assert len(got) == 8 * len(rows)
    for r in got:
        w[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == dev[at[r.vec_id]] and r.n == len(rows) and r.identity_error < 1e-9
        assert abs(r.explained - e[r.component - 1] / np.trace(cov)) < 1e-10
    sign = np.sign((w * want).sum(0))
    assert np.abs(w - want * sign).max() < 1e-8


def test_whitening_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.1, 0.2]), (2, None), (3, []), (4, [0.1, None]), (5, [inf, 0.0]), (6, [nan, 1.0]), (7, [1.0, 2.0, 3.0]),
            (1, [0.1, 0.2]), (None, [0.5, -0.7]), (9, [-0.3, 0.4]), (10, [2.0 ** 41, 0.0])]
    schema = "vec_id long, embedding array<float>, label int, n long, whitened double"
    df = spark.createDataFrame([(i, v, 1, 2, 3.0) for i, v in rows], schema).repartition(3)
    model = whitening.fit(df)
    got = whitening.whiten(df, model).collect()
    assert sorted((r.vec_id or -1) for r in got) == sorted([1, 1, -1, 9] * 2) and model.n == 4
    assert {r.deviation for r in got if r.vec_id == 1} == {whitened([(i, v) for i, v in rows if i in (1, None, 9) and v])[0][0]}
    same = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    for odd in (same, spark.createDataFrame([], schema), df.where("vec_id = 1").limit(1)):
        assert whitening.whiten(odd, whitening.fit(odd)).count() == 0


def test_deviation_beyond_a_long(spark):
    y = np.array([[1 << 31, 0], [3_100_000_000, 0], [1, 2]], dtype=np.int64)
    assert whitening.deviation(y).to_pylist() == [1 << 62, None, 5]
    x = np.array([[1 << 50], [3]], dtype=np.int64)
    assert whitening.centred(x, 1 << 20, np.array([7], dtype=object)).tolist() == [[(1 << 70) - 7], [(3 << 20) - 7]]


# ---- op12 --------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def audit(docs, labels):
    """All orders, filter by filter, one document at a time."""
    flags = defaultdict(lambda: [0, 0])
    for d, quality, toxic in labels:
        flags[d] = [max(flags[d][0], quality or 0), max(flags[d][1], toxic or 0)]
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    parts = defaultdict(list)
    for d, t, source in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > least[t]}
        parts[source or ""].append(("".join(f for f in "ABCDE" if fails[f]), *(flags[d] if d is not None else (0, 0))))
    out, share = [], Counter()
    for part, rows in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = list(rows)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                share[part, f] += len(gone)
                failing = sum(f in r[0] for r in rows)
                out.append([part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(r[0] == f for r in rows),
                            sum(r[1] == 1 for r in gone), sum(r[2] == 1 for r in gone), f])
    return sorted((*r[:-1], share[r[0], r[-1]]) for r in out)


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def odd_documents():
    rng = random.Random(5)
    words = ["Alpha", "beta", "gamma", "DELTA", "x#y", "it", "was", "naïve", "日本"]
    texts = [None, "", " ", "short", "short text", " ".join(rng.choice(words) for _ in range(60)), " ".join(f"w{i}" for i in range(70)),
             " ".join(f"w{i}" for i in range(70)) + " $", "A" * 20, "word " * 3000]
    rows = [(rng.choice([*range(40), None]), rng.choice(texts), rng.choice([None, "", "s1", "s2"])) for _ in range(300)]
    return rows + [(3, "short", "s1"), (3, "short", "s1"), (3, "short", "s2"), (-5, "short", "s2")]


def test_filter_audit_retracts(spark, tmp_path):
    docs = odd_documents()
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 40, 2)] + [(4, 1, None), (None, 1, 1), (6, None, 1)]
    labels = [(d, q, int(t) if t is not None else None) for d, q, t in labels]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    schema = "doc_id long, text string, source string, part string, mask int, n long, key binary"
    path = str(tmp_path / "documents.parquet")
    # larger ids come first, file by file, so that earlier masks must be taken back
    order = sorted(docs, key=lambda r: -(r[0] if r[0] is not None else 99))
    for i in range(8):
        some = order[len(order) * i // 8: len(order) * (i + 1) // 8]
        spark.createDataFrame([(*r, "x", 1, 2, b"k") for r in some], schema).coalesce(1).write.mode("append").parquet(path)
    want = audit(docs, labels)
    for batches in (1, 3, 8):
        got = filter_audit.audit(spark, path, lab, str(tmp_path / f"place{batches}"), batches)
        assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == want
    # the same place again: all files are done, nothing is counted twice
    again = filter_audit.audit(spark, path, lab, str(tmp_path / "place3"), 3)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in again.collect()) == want


def test_filter_audit_goes_on(spark, tmp_path):
    """Files that come after a run: its counters are corrected by retraction."""
    docs = [(i, f"text {i % 4}", "s") for i in range(20, 40)]
    late = [(i, f"text {i % 4}", "t") for i in range(10)]
    lab = spark.createDataFrame([(2, 1, 1), (21, 1, 0)], "doc_id long, quality int, toxic int")
    path, place = str(tmp_path / "documents.parquet"), str(tmp_path / "place")
    schema = "doc_id long, text string, source string"
    spark.createDataFrame(docs, schema).write.parquet(path)
    filter_audit.audit(spark, path, lab, place)
    spark.createDataFrame(late, schema).write.mode("append").parquet(path)
    got = filter_audit.audit(spark, path, lab, place).collect()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got) == audit(docs + late, [(2, 1, 1), (21, 1, 0)])


def test_filter_audit_empty(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(path)
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark, path, lab).count() == 0


# ---- op13 --------------------------------------------------------------------------

def sets_of(t, k=4):
    w = WORD.findall(brute.lower(t))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(docs, percent=85):
    sets = [sets_of(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def varied(seed, n, words, changes):
    """Texts in families: a base with a few words changed, so that links chain and miss by little."""
    rng = random.Random(seed)
    out = []
    for f in range(n):
        base = [rng.choice(words) for _ in range(rng.choice([5, 7, 9, 12, 30, 60, 150]))]
        for _ in range(rng.randint(1, 14)):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) * changes // 100))):
                t[rng.randrange(len(t))] = rng.choice(words)
            out.append(" ".join(t))
    return out


@pytest.mark.parametrize("few,block", [(8, 4096), (2, 3)])
def test_parity_join(spark, few, block):
    words = [f"w{i}" for i in range(400)]
    texts = varied(few, 25, words, 6) + varied(few + 1, 10, words[:12], 10)
    texts += [None, "", " \n", "one", "one two three", "One TWO three", "one two three four", "x" * 200_000, "x" * 200_000 + " y",
              " ".join(words * 30), " ".join(words * 30) + " tail", "ſ K k", "ſ k k"]
    random.Random(1).shuffle(texts)
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "one"), (None, None), (7, texts[7]), (7, texts[7]), (3, "one two three")]
    df = spark.createDataFrame([(d, t, 1, 2, 3, [4], 5) for d, t in docs],
                               "doc_id long, text string, n long, row long, node long, keys array<int>, a int").repartition(5)
    got = parity_join.jaccard_groups(df, few=few, block=block)
    assert sorted((tuple(r) for r in got.collect()), key=str) == jaccard(docs)


def test_parity_join_empty(spark):
    assert parity_join.jaccard_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_linked_documents_share_keys():
    """Every pair of linked sets has the number of common keys that the bands promise, whatever their sizes."""
    rng, bands, met = np.random.default_rng(2), parity_join.Bands(), 0
    for _ in range(1500):
        n = int(rng.choice([6, 7, 8, 11, 13, 20, 28, 29, 60, 200, 900]))
        a = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64))
        cut = int(rng.integers(0, max(1, n // 8) + 1))
        b = np.unique(np.concatenate([a[cut:], rng.integers(0, 2 ** 63, int(rng.integers(0, max(1, n // 9) + 1)), dtype=np.uint64)]))
        if parity_join.linked(a, b) and len(np.setxor1d(a, b)):
            met += 1
            common = len(np.intersect1d(bands.keys(a), bands.keys(b)))
            assert common >= bands.shared(len(a), len(b))
    assert met > 300


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 40)), st.sets(st.integers(0, 40)), st.sampled_from([0, 2 ** 40, 2 ** 58]))
def test_sketch_distance_is_a_lower_bound(a, b, scale):
    x, y = (np.array(sorted(v * max(1, scale) for v in s), dtype=np.uint64) for s in (a, b))
    assert len(np.setxor1d(parity_join.places(x), parity_join.places(y))) <= len(a ^ b)
    if a and b:
        words = min(len(parity_join.dense(x)), len(parity_join.dense(y))) // 8
        near = np.bitwise_count(parity_join.folded([parity_join.dense(x)], words) ^ parity_join.folded([parity_join.dense(y)], words)).sum()
        assert near <= len(a ^ b)
    assert parity_join.linked(x, y) == (bool(a) and bool(b) and 100 * len(a & b) >= 85 * len(a | b))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 30)), max_size=60), st.integers(2, 4), st.integers(1, 7))
def test_runs_cover_all_pairs(rows, few, cut):
    """Small runs give all their pairs, larger ones all their rows, however the sorted rows are cut into batches."""
    import pyarrow as pa
    rows = sorted(set(rows))
    batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows[i:i + cut]], pa.int64()), pa.array([r for _, r in rows[i:i + cut]], pa.int64())],
                                          names=["key", "row"]) for i in range(0, len(rows), cut)]
    pairs, many = set(), defaultdict(set)
    for b in parity_join.runs(few)(iter(batches)):
        for k, x, y in zip(*(c.to_pylist() for c in b.columns)):
            if k is None:
                pairs.add((max(x, y), min(x, y)))
            else:
                many[k].add(x)
    groups = defaultdict(set)
    for k, r in rows:
        groups[k].add(r)
    assert dict(many) == {k: v for k, v in groups.items() if len(v) > few}
    for v in groups.values():
        if len(v) <= few:
            assert {(x, y) for x in v for y in v if x > y} <= pairs


# ---- op4: values that clash here and there -----------------------------------------

LONG = ("In the old harbour town a baker named Maria bakes 12 large loaves every morning before the sun comes up, and she sells them to the people "
        "of the valley who come down by cart with 30 baskets on market days, while her brother keeps the small mill by the river and grinds 12 "
        "sacks of wheat for the whole village each week until the first snow of the winter falls")


def consistent(windows, share):
    """The places that stay, by plain Python: pairs by the number of windows that hold them, each unless its x or y is taken."""
    pairs = {p for _, v in windows for p in v}
    if len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs):
        return {p for p, _ in windows}
    count, taken = Counter(p for _, v in windows for p in set(v)), []
    for x, y in sorted(pairs, key=lambda p: (-count[p], p)):
        if all(x != a and y != b for a, b in taken):
            taken.append((x, y))
    kept = [p for p, v in windows if all(q in taken for q in v)]
    return set(kept) if share[1] * len(kept) >= share[0] * len(windows) else set()


def test_one_changed_value_does_not_hide_an_item(spark):
    from manifest_spark.llm import decontam
    at = LONG.rindex("12")
    other = lambda n: LONG[:at] + n + LONG[at + 2:]
    docs = [(1, LONG), (2, "so " + other("13") + " now"), (3, other("3")), (4, LONG.replace("12", "40").replace("30", "5").replace("Maria", "Anna")),
            (5, LONG.replace("bakes 12", "bakes 30")), (6, LONG[:60])]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, LONG)], "item_id long, text string"))
    rows = {r.doc_id: r.n_windows for r in got.collect()}
    assert {1, 2, 3, 4} <= set(rows) and 6 not in rows and rows[2] < rows[1] == rows[4]


def test_consistent_windows_against_plain_python(spark):
    from pyspark.sql import functions as F
    from manifest_spark.llm import decontam
    rng = random.Random(9)
    cases = []
    for i in range(400):
        mapping = {x: f"y{x}" for x in "abcd"}
        windows = []
        for place in range(rng.randint(1, 14)):
            v = [(x, mapping[x] if rng.random() < 0.9 else rng.choice(["ya", "yb", "z"])) for x in rng.sample("abcd", rng.randint(0, 3))]
            windows.append((place, v))
        cases.append((i, windows))
    df = spark.createDataFrame([(i, [(p, [(x, y) for x, y in v]) for p, v in w]) for i, w in cases],
                               "i int, w array<struct<place: int, v: array<struct<x: string, y: string>>>>")
    df = df.withColumn("v", F.array_distinct(F.flatten("w.v")))
    got = {r.i: set(r.places or []) for r in df.select("i", decontam._consistent(F.col("w"), F.col("v")).alias("places")).collect()}
    assert got == {i: consistent(w, decontam.SHARE) for i, w in cases}


# ---- op8: signs that are no letters ------------------------------------------------

def test_letterless_texts_have_no_language(spark):
    from manifest_spark.llm import langid
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the house and the garden", "en"), ("das Haus und der Garten", "de")] * 30)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = ["½ ² ①", "Ⅷ", "12 34", "ª", "日", "x½"]
    got = langid.detect_language(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert [r.lang_pred == "und" for r in sorted(got, key=lambda r: r.doc_id)] == [True, True, True, False, False, False]
    kept = langid.with_language(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, 0.0).collect()
    assert sorted(r.doc_id for r in kept) == [3, 4, 5]


def test_filter_audit_equals_its_sql(spark):
    import duckdb
    from manifest_spark.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE['op12_filter_audit']})").fetchall()
    got = QUERIES["op12_filter_audit"](spark, SF).select(*COLUMNS).collect()
    assert len(want) > 1000 and sorted(map(tuple, got)) == sorted(want)
