"""The pipeline's stages, one after the other, against plain versions of what each must keep."""

import brute
import corpus_pipeline as cp
from test_operators import LIBRARY, odd_rows, SCHEMA

from manifest_spark.llm import langid, secrets
from manifest_spark.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    columns, now = docs.columns, docs
    for name, stage in cp.STAGES[:4]:
        before = {r["doc_id"]: r for r in now.collect()}
        out = stage(spark, now, SF)
        assert out.columns == columns
        after = {r["doc_id"]: r for r in out.collect()}
        if name.startswith("language"):
            assert set(after) == set(before)
        elif name.startswith("SimHash"):
            ids = list(before)
            comp = brute.components(ids, [brute.simhash(before[i]["text"]) for i in ids])
            assert set(after) == set(comp)
        elif name.startswith("benchmark"):
            assert set(after) == set(before) - {d for d, _ in brute.leaks([(i, r["text"]) for i, r in before.items()], items)}
        else:
            assert set(after) == set(before)
            for i, r in after.items():
                n = brute.secrets(before[i]["text"])
                assert r["text"] == before[i]["text"] if not sum(n[:3]) else sum(brute.secrets(r["text"])[:3]) == 0
        now = spark.createDataFrame(list(after.values()), docs.schema)
    ids = {r["doc_id"]: r["ids"] for r in cp.tokens(spark, now, SF).collect()}
    assert ids == {i: LIBRARY["word_bpe_49k.json"](r["text"])[0] for i, r in after.items()}
    assert {r["doc_id"]: r["ids"] for r in cp.run(spark, SF).collect()} == ids


def test_stages_on_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    docs = docs.unionByName(table(spark, SF, "documents").where("doc_id > 100"), allowMissingColumns=True)
    for _, stage in cp.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), docs.schema)
        empty = stage(spark, docs.limit(0), SF)
        assert empty.columns == docs.columns and empty.count() == 0
    left = sorted(r["doc_id"] for r in docs.where("doc_id < 100").collect())
    assert left == sorted(set(left)) and {0, 1, 2, 5}.isdisjoint(left) and 3 in left
    assert docs.where("doc_id is null").count() == 1
    assert cp.tokens(spark, docs.limit(0), SF).count() == 0
