"""The dealt operators against brute-force versions, and over nulls, empty and long texts, ties, repeated rows and odd columns."""

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from manifest_spark.llm import bpe, decontam, langid, licenses, quality, rules, secrets, simhash, token_files, toxicity
from manifest_spark.llm.common import Memo, table
from manifest_spark.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, fp long, spans string, "
          "kept boolean, shard int, words string, h int, s int, p int, id int, ids string, y int")


def odd_rows():
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "été", "größe", "niño", "the", "of", "and", "İstanbul", "ΑΣ", "日本語", "😀", "x²", "½"]
    texts = [None, "", " \n\t ", "short", "short", "12 34 .. !!", "SHORT", "ſecret K",
             "token = \"%s\" and secret=abc password: 'longenough1' AKIA%s" % (HEX, "A1B2" * 4),
             "secret=token=abcdefghij password=token:abcdefgh " + "ab" * 16 + "\x00" + "ab" * 15,
             "SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Apache-2.0\nAll Rights  Reserved, cc-by cc by",
             " ".join(rng.choice(words) for _ in range(30_000)), "word " * 5000, "\n".join(["same line here"] * 40),
             "a<|endoftext|>b <|startoftext|>C's don't  WE'LL x\x85y\x1cz", "é" * 10 + " é ﬁ Ǆ"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a text without an id"), (None, None), (3, "short"), (3, "short")]
    return [(d, t, None, None, None if t is None else len(t), 1.0, 2, "x", None, 1, "w", 1, 2, 3, 4, "i", 1) for d, t in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}


def key(r):
    return tuple((x is not None, x) for x in r)


def test_licenses(spark, odd, empty):
    got = sorted((tuple(r)[:6] for r in licenses.scan_licenses(odd).collect()), key=key)
    assert got == sorted(((r[0], *brute.licenses(r[1])) for r in odd_rows()), key=key)
    assert licenses.scan_licenses(empty).count() == 0


def test_license_expressions():
    value = lambda s: licenses.evaluate(licenses.postfix(s))
    assert licenses.postfix("MIT OR (GPL-2.0-only WITH X) AND ISC */") == ["MIT", "GPL-2.0-only", "X", "with", "ISC", "and", "or"]
    assert licenses.postfix("(MIT OR") == [] and licenses.postfix("MIT OR") == ["MIT"] and licenses.postfix("MIT) x") == ["MIT"]
    assert value("MIT OR GPL-3.0") == (0.1, {"mit", "gpl"})
    assert value("MIT AND GPL-3.0")[0] == 0.6 and value("GPL-3.0 WITH Classpath-exception-2.0") == (0.3, {"gpl"})
    n, base, first, last, labels, every, score, found = licenses.scan(b"x SPDX-License-Identifier: MIT OR AGPL-3.0\nAll rights reserved. All rights reserved")
    assert (base, first, last, labels, every, score) == (2, 9, 12, "reserved", "agpl,mit,reserved", 1.0)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\tacby.,-CBYgGenrlpubicsv\x7fé\x00"), max_size=60))
def test_licenses_random(t):
    assert licenses.scan(t.encode())[:5] == brute.licenses(t)


def tokenizers_ids(name, text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(name))
    ids = t.encode(text or "", add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


def test_bpe(odd, empty):
    path = vocabulary("word_bpe_49k.json")
    want = []
    for r in odd_rows():
        ids, back = tokenizers_ids("word_bpe_49k.json", r[1])
        want.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, bpe.token_digests(odd, path).collect()), key=key) == sorted(want, key=key)
    encoded = bpe.encode_documents(odd, path)
    assert sorted((len(r["ids"]) for r in encoded.collect())) == sorted(w[1] for w in want)
    back = sorted(((r["doc_id"], r["text"]) for r in bpe.decode_documents(encoded, path).collect()), key=key)
    assert back == sorted(((r[0], tokenizers_ids("word_bpe_49k.json", r[1])[1]) for r in odd_rows()), key=key)
    assert bpe.token_digests(empty, path).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet=st.sampled_from("abcdeinorst'’ lv0²½_é<|>ΣσßİḰ\x85\x1f"), max_size=40)))
def test_bpe_random(t):
    t = t.encode("utf-8", "ignore").decode()
    model = bpe.load(vocabulary("word_bpe_49k.json"))
    ids, back = LIBRARY["word_bpe_49k.json"](t)
    assert model.encode([t], Memo())[0].tolist() == ids
    assert model.decode(ids) == back
    raw = token_files.Encoder(vocabulary("byte_bpe_50k.json")).serialized(t)
    assert np.frombuffer(raw, "<u4").tolist() == LIBRARY["byte_bpe_50k.json"](t)[0] + [0]


def _library(name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(name))

    def run(text):
        ids = t.encode(text, add_special_tokens=False).ids
        return ids, t.decode(ids, skip_special_tokens=False)

    return run


LIBRARY = {n: _library(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


def test_bpe_pairs_agree_with_merging():
    """The vectorised pair check against exact merging of the two tokens' letters."""
    model = bpe.load(vocabulary("word_bpe_49k.json"))
    rng = np.random.default_rng(5)
    whole = np.array([i for t, i in model.ids.items() if model.whole[i]])
    names = {i: t for t, i in model.ids.items()}
    inner = np.array([i for i in whole if not names[i].endswith(bpe.END)])
    last = np.array([i for i in whole if names[i].endswith(bpe.END)])
    a, b = rng.choice(inner, 3000), rng.choice(last, 3000)
    want = [model.exact(names[x] + names[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert model.compatible(a.astype(np.int64), b.astype(np.int64)).tolist() == want
    assert sum(want) not in (0, len(want))


def test_token_files(spark, odd, empty, tmp_path):
    path = vocabulary("byte_bpe_50k.json")
    folder = str(tmp_path / "t")
    got = [tuple(r) for r in token_files.token_file_index(odd, path, folder).collect()]
    rows = [(r[0], np.array(tokenizers_ids("byte_bpe_50k.json", r[1])[0] + [0], "<u4").tobytes()) for r in odd_rows()]
    assert sorted((d or -1, n, c) for d, _, n, c in got) == sorted((d or -1, len(x) // 4, zlib.crc32(x)) for d, x in rows)
    at = 0
    for d, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    ids = [d for d, *_ in sorted(got, key=lambda r: r[1])]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    some = {r["doc_id"]: r["ids"] for r in token_files.read_documents(spark, folder, [5, 10]).collect()}
    assert some == {d: np.frombuffer(x, "<u4").tolist() for d, x in rows if d in (5, 10)}
    with pytest.raises(ValueError):
        token_files.Shard(token_files.pack([], [], b"one"), b"another")
    assert token_files.token_file_index(empty, path).count() == 0


def test_secrets(odd, empty, texts, spark):
    table_ = secrets.train(table(spark, SF, "documents"))
    got = [tuple(r) for r in secrets.scan_secrets(odd, table_).collect()]
    want = [(r[0], *brute.secrets(r[1])) for r in odd_rows()]
    assert sorted([(g[:4], g[5]) for g in got], key=lambda x: key((*x[0], x[1]))) == sorted([(w[:4], w[5]) for w in want], key=lambda x: key((*x[0], x[1])))
    assert secrets.scan_secrets(empty, table_).count() == 0
    clean = {r["doc_id"]: r["text"] for r in secrets.redact_secrets(odd.where("doc_id > 4"), table_).collect()}
    assert HEX not in clean[8] and "longenough1" not in clean[8] and "secret=abc " in clean[8] and clean[5] == "12 34 .. !!"
    assert secrets.redact_secrets(odd, table_).columns == odd.columns
    assert secrets.train(empty) == [pytest.approx(0.0)] * len(table_)


def test_secret_models(spark):
    table_ = secrets.train(table(spark, SF, "documents"))
    rows = [(1, "key xV9r2LkQpZ7mW4tYbN8sHd3GfJ6c here"), (2, "see getUserAccountSettings2 and load_training_table_v2"),
            (3, "Qz8JkX0vT5wLr3NmYp1BsHf7 end"), (4, "the-quick-brown-fox-jumps-over-2-dogs")]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"), table_).collect()}
    assert got == {1: "random:4:32", 2: "", 3: "random:0:24", 4: ""}


def test_keys_glued_to_names_and_paths(spark):
    table_ = secrets.train(table(spark, SF, "documents"))
    k = "xV9r2LkQpZ7mW4tYbN8s"
    heads = ["", "client_credential=", "DATABASE_PRIVATE_SIGNING_KEY=", "the/path/to/some/long/folder/", "name_of_the_signing_key_"]
    rows = [(i, f"see {h}{k} here") for i, h in enumerate(heads)] + [(9, "see client_credential=load_training_table_v2 here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs, table_).collect()}
    assert spans[9] == "" and all(spans[i] for i in range(len(heads)))
    clean = {r["doc_id"]: r["text"] for r in secrets.redact_secrets(docs, table_).collect()}
    assert all(k not in clean[i] and clean[i].endswith("[secret] here") for i in range(len(heads)))


def test_rules(odd, empty):
    got = sorted((tuple(r)[:6] for r in rules.judge(odd).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()), key=key)
    assert got == sorted(((r[0], *brute.counts(r[1])) for r in odd_rows()), key=key)
    assert rules.judge(empty).count() == 0
    order = rules.order_rules(odd.select("doc_id", "text"))
    assert {k for k, *_ in order} == set(rules.rules())
    one, other = (rules.judge(odd, o).select("doc_id", "n_words", "kept").collect() for o in (order, order[::-1]))
    assert sorted(one, key=key) == sorted(other, key=key)


@settings(max_examples=15, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \n\t|#"), max_size=80), min_size=20, max_size=20))
def test_rules_random(spark, ts):
    got = rules.with_counts(spark.createDataFrame(list(enumerate(ts)), "doc_id long, text string")).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.counts(ts[r.doc_id])


def test_near_copies(odd, empty):
    rows = odd_rows()
    fps = [brute.simhash(r[1]) for r in rows]
    comp = brute.components([r[0] for r in rows], fps)
    got = [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_copies(odd).collect()]
    assert sorted(got, key=key) == sorted(((r[0], f, c) for r, f, c in zip(rows, fps, comp)), key=key)
    assert simhash.near_copies(empty).count() == 0
    left = simhash.representatives(odd)
    assert left.columns == odd.columns
    named = [r["doc_id"] for r in left.collect() if r["doc_id"] is not None]
    assert sorted(named) == sorted({c for r, c in zip(rows, comp) if r[0] is not None})


def test_one_id_on_several_texts(spark):
    """A copy's row goes, not the other text that bears its id; two groups with one smallest id keep a row each."""
    a, b, c = ("green ideas sleep very furiously in winter", "the old market opens at nine on days of rest", "a farmer walks to the river with twelve baskets")
    rows = [(1, a, 0), (5, a, 1), (5, b, 2), (7, b, 3), (5, c, 4), (5, c, 5), (None, c, 6), (8, "something else entirely stands in here", 7)]
    left = simhash.representatives(spark.createDataFrame(rows, "doc_id long, text string, row int").repartition(3))
    assert left.columns == ["doc_id", "text", "row"]
    got = left.collect()
    assert sorted(r["row"] for r in got if r["row"] not in (4, 5)) == [0, 2, 6, 7] and len(got) == 5


def clustered(n, seed):
    """Fingerprints with chains and dense balls: walks of one to three flipped bits, and neighbours of one point."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 1, 5, 40])):
            out.append(x)
            for b in rng.sample(range(64), rng.choice([1, 2, 2, 3])):
                x ^= 1 << b
        if rng.random() < 0.02:
            c = rng.getrandbits(64)
            out += [c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(120)]
    return out[:n]


@pytest.mark.parametrize("shard,most,leaf", [(200, 10**6, 64), (200, 60, 64), (10**6, 10**6, 32)])
def test_tree_finds_all_links(spark, monkeypatch, shard, most, leaf):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    fps = sorted(set(clustered(1500, 9)))
    nodes = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    root = {r["node"] % 2**64: r["root"] for r in simhash.groups(simhash.links(nodes, 2, shard, most)).collect()}
    want = brute.components(list(range(len(fps))), fps)
    mine = [root.get(x, int(np.uint64(x).view(np.int64))) for x in fps]
    pairs = set(zip(want, mine))
    assert len(pairs) == len(set(want)) == len(set(mine))


def test_dense_ball_in_one_shard(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 16)
    centre = random.Random(1).getrandbits(64)
    fps = np.array(sorted({centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 2) for b in range(64)}), dtype=np.uint64)
    forest = simhash.Forest(len(fps))
    simhash.link(fps, np.arange(len(fps)), 2, forest)
    assert len({forest.root(i) for i in range(len(fps))}) == len(set(brute.components(list(range(len(fps))), [int(x) for x in fps])))


def test_long_chain_of_groups(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, x) for x in range(1001, 1400)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in simhash.groups(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {x: 1000 for x in range(1001, 1400)}


ITEM = ("A farmer has 12 apples and gives 3 of them to Maria, who walks 5 km to the old market. "
        "How many apples does the farmer keep if each basket holds 4 apples?")


def test_decontamination(spark, odd, empty):
    items = [(1, ITEM), (2, None), (3, ""), (4, "two words"), (5, "green ideas sleep very furiously"), (1, ITEM), (None, "no id for this item of eight plain words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    swapped = ITEM.replace("12", "40").replace("3", "7").replace("Maria", "Anna Lee").replace("5 km", "9 miles").replace("4", "2")
    torn = ITEM.replace("gives 3", "gives 12").replace("5 km", "12 miles").replace("holds 4", "holds 12")
    docs = [(1, "Before. " + ITEM + " After."), (2, "x " + swapped.upper()), (3, "so " + swapped + " and on"), (4, torn), (5, ITEM[:40]),
            (6, "they say green ideas sleep very furiously in winter"), (7, "two words"), (8, None), (9, ""), (None, ITEM), (1, ITEM), (10, "number 12 " * 50),
            (11, "no id for this item of eight plain words")]
    got = decontam.contaminated(spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, h int, item_id int"), bench).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=key) == sorted([(None, 1), (1, 1), (2, 1), (3, 1), (6, 5), (11, None)], key=key)
    assert decontam.contaminated(odd, bench).count() == 0
    assert decontam.contaminated(empty, bench).count() == 0 and decontam.contaminated(odd, bench.limit(0)).count() == 0


def test_capitalised_items_inside_sentences(spark):
    """The first word of an item looks like a name, or like a part of one, in the middle of a sentence."""
    items = [(1, "What is the total weight of these boxes"), (2, "Which green ideas sleep furiously?"), (3, "If Maria has 12 old green apples, does Maria keep them all?"),
             (4, "Days before the old market opened were long")]
    docs = [(1, "they asked him What is the total weight of these boxes today"), (2, "Then Bob (What is the total weight of these boxes) left"),
            (3, "we ask Bob What is the total weight of these boxes"), (4, "we ask, Which green ideas sleep furiously in winter"),
            (5, "they ask, If Anna Lee has 7 old green apples, does Anna Lee keep them all?"), (6, "then Bob If Maria has 12 old green apples, does Maria keep them all?"),
            (7, "they ask, If Anna has 7 old green apples, does Bob keep them all?"), (8, "it took 5 Days before the old market opened were long"),
            (9, "they asked him Who is the total weight of these boxes today")]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (2, 1), (3, 1), (4, 2), (5, 3), (6, 3), (8, 4)]


def test_items_without_a_window_of_plain_words(spark):
    """Items full of slots, and texts in scripts without blanks, stand in documents as they are or as whole templates."""
    full = "Add 12 apples to 30 km and 7 kg, take 9 kg and 4 km from 6 pears"
    items = [(1, "What is 12 plus 30?"), (2, full), (3, "小明有12个苹果，又买了30个，现在一共有多少个苹果？"), (4, "東京は日本の首都ですか"),
             (5, "เมืองหลวงของประเทศไทยคืออะไร"), (6, "12 plus 30"), (7, "你好"), (8, "Give 5 km to Maria, then see Maria"), (9, None),
             (8, "Take 7 kg to Anna, then see Anna")]
    docs = [(1, "they asked, What is 12 plus 30? and left"), (2, "What is 13 plus 30?"), (3, "so " + full + " at last"),
            (4, full.replace("12", "13").replace("30", "31")), (5, full.replace("4 km", "4 kg")), (6, "他问：小明有12个苹果，又买了30个，现在一共有多少个苹果？好的。"),
            (7, "小明有15个苹果，又买了40个，现在一共有多少个苹果？"), (8, "先生は東京は日本の首都ですかと聞いた"), (9, "ถามว่าเมืองหลวงของประเทศไทยคืออะไรครับ"),
            (10, "你好 and 12 plus 30"), (11, "we give 5 km to Maria, then see Maria Lee there"), (12, "小明有12个苹果"), (13, ""), (14, "ประเทศไทย"),
            (15, "Give 5 km to Anna, then see Anna")]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (3, 2), (4, 2), (6, 3), (7, 3), (8, 4), (9, 5), (11, 8)]
    assert all(0 < r["coverage"] <= 1 for r in got)


def test_units_in_singular_and_plural_are_one_value(spark):
    text = "The slow old train needs 1 hour to reach the market and then 3 hours to come back to the green farm again today"
    docs = [(1, text.replace("1 hour ", "2 hours ").replace("3 hours", "4 hours")), (2, text.replace("1 hour ", "2 hours ").replace("3 hours", "4 days"))]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, text)], "item_id long, text string")).collect()
    assert [r["doc_id"] for r in got] == [1]


def test_decontamination_finds_all_passages(spark, texts):
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_decontamination"](spark, SF).collect()}
    assert got == brute.leaks(texts.items(), items)


@pytest.mark.parametrize("name,column,at_least", [("op2_quality_classifier", "quality", 0.93), ("op9_toxicity", "toxic", 0.93)])
def test_classifiers_on_held_out_rows(spark, name, column, at_least):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r[column] for r in table(spark, sf, "labels").collect()}
    rows = [r for r in QUERIES[name](spark, sf).collect() if r["doc_id"] in labels]
    held = [r for r in rows if r["held_out"]]
    mod, rest = (5, 0) if column == "quality" else (3, 1)
    assert all(r["held_out"] == (brute.crc(r["doc_id"]) % mod == rest) for r in rows)
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= at_least * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_on_held_out_rows(spark):
    docs = {r["doc_id"]: r for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    rows = QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (brute.crc(r["doc_id"]) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.98 * len(held)


def test_folded_network_equals_the_plain_one():
    net = langid.Network(["a", "b", "c"])
    data = [b"", b"x", bytes(range(256)) * 3, "größe été".encode() * 60]
    x, owner, held = langid.windows(data)
    assert len(x) == len(owner) and [int((owner == i).sum()) for i in range(4)] == [1, 1, 4, 4]
    h = []
    for w in langid.WIDTHS:
        n = langid.WINDOW - w + 1
        a = sum(net.taps[w][j][x[:, j:j + n]] for j in range(w))
        h.append(np.tanh(a.max(1) + net.bias[w]))
    want = np.concatenate(h, 1) @ net.dense + net.offset
    assert np.allclose(net.fold().logits(x, block=2), want, atol=1e-4)


def test_classifiers_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1, 0), (3, None, 1), (5, 0, 0), (7, 1, None), (11, 0, 1), (None, 1, 1), (6, 2, 5), (99, 1, 1)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    ids = sorted((r[0] for r in odd_rows()), key=lambda x: (x is not None, x))
    for lab in (labels, none):
        for out in (quality.score_quality(odd, quality.fit(odd, lab)), toxicity.score_toxicity(odd, toxicity.fit(odd, lab))):
            rows = out.collect()
            assert sorted((r["doc_id"] for r in rows), key=lambda x: (x is not None, x)) == ids
            assert all(0 <= r["score"] <= 1 for r in rows)
            same = {r["score"] for r in rows if r["doc_id"] == 3}
            assert len(same) == 1
    assert quality.score_quality(empty, quality.fit(empty, none)).count() == 0
    assert toxicity.score_toxicity(empty, toxicity.fit(empty, none)).count() == 0
    model = langid.fit(odd)
    assert model is None and {r["lang_pred"] for r in langid.detect_language(odd, model).collect()} == {"und"}
    model = langid.fit(table(spark, SF, "documents"))
    got = [(r["doc_id"], r["lang_pred"]) for r in langid.detect_language(odd, model).collect()]
    assert all((lang == "und") == (d in (1, 2, 5, 0)) for d, lang in got if d is not None)
    assert langid.with_language(odd, model, 0.3).columns == odd.columns and langid.with_language(empty, model, 0.3).count() == 0


def test_obfuscated_words_are_restored(spark):
    sf = "/root/testdata/sf0.1"
    fitted = toxicity.fit(table(spark, sf, "documents"), table(spark, sf, "labels"))
    shown = ["the idiot is", "the 1d10t is", "the i.d.i.o.t is", "the iddddiot is", "the i d i o t is", "the $tupid one", "a cl0wn here", "w0rthless", "7RASH!!!"]
    plain = ["the ide is", "mail5 and 2nd e-mail", "aaa bbb 123", "x y z"]
    rows = list(enumerate(shown + plain))
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), fitted).collect()}
    assert [got[i] for i in range(len(rows))] == [1] * len(shown) + [0] * len(plain)


def test_rules_equal_their_sql(spark, duck):
    from manifest_spark.llm.queries import ORACLE
    found = duck.execute(ORACLE["op10_quality_rules"])
    names = [c[0] for c in found.description]
    got = QUERIES["op10_quality_rules"](spark, SF).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(found.fetchall())
