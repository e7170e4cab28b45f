"""Models that learn from all labelled rows."""

from manifest_spark.llm import toxicity
from manifest_spark.llm.common import fold
from pyspark.sql import functions as F


def test_toxicity_learns_from_all_labelled_rows(spark):
    ids = [r[0] for r in spark.range(40_000).select(F.col("id").alias("doc_id")).where(fold("doc_id", 3) != 1).orderBy("doc_id").collect()]
    toxic = dict(zip(ids[::130], range(200)))  # each of 40 words in five toxic texts, all over the rows
    name = lambda i: "zq" + "".join("abcdefghij"[int(c)] for c in f"{i % 40:02d}") + "v"
    docs = spark.createDataFrame([(i, f"{i} plain words {i}a stand {i}b here {i}c " + (name(toxic[i]) if i in toxic else "too")) for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in ids], "doc_id long, toxic int")
    _, chances, _ = toxicity.fit(docs, labels)
    assert {name(i) for i in range(40)} <= set(chances)
    assert all(abs(chances[name(i)] - 5 / 6) < 1e-9 for i in range(40))


def test_copies_count_once_by_the_smallest_id(spark):
    texts = ["a b c d", "e f g h", "a b c d", "", "", "x a b c d"]
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, y int")
    sigs = {r["doc_id"]: set(enumerate(r["s"])) for r in toxicity.signatures(rows).collect()}
    want = [i for i in sigs if not any(sigs[i] & sigs[j] for j in range(i))]
    assert sorted(r["doc_id"] for r in toxicity.without_copies(rows).collect()) == want
