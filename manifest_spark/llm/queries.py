"""Registered queries of this subpackage: each dealt operator over its whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, decontam, filter_audit, langid, licenses, parity_join, quality, rules, secrets, simhash, token_files, toxicity, whitening
from .common import held_out, table

QUERIES: dict = {}
ORACLE: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file stands."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query
def op1_license_scan(spark, sf_dir):
    return licenses.scan_licenses(documents(spark, sf_dir)).drop("expressions")


@query
def op2_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


@query
def op3_bpe(spark, sf_dir):
    return bpe.token_digests(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


@query
def op4_decontamination(spark, sf_dir):
    return decontam.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query
def op5_secret_scan(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = secrets.scan_secrets(docs, secrets.train(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query
def op6_simhash_near_dedup(spark, sf_dir):
    return simhash.near_copies(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_token_files(spark, sf_dir):
    return token_files.token_file_index(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


@query
def op8_language_id(spark, sf_dir):
    model = langid.fit(table(spark, sf_dir, "documents"))
    return langid.detect_language(documents(spark, sf_dir), model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query
def op9_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    fitted = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, fitted).select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


@query
def op10_quality_rules(spark, sf_dir):
    return rules.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op11_embedding_whitening(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


@query
def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


ORACLE["op12_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             min(doc_id) OVER (PARTITION BY text) AS least FROM d),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
             || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
             || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS mask, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS bad FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before
      FROM o, (SELECT unnest(range(1, 6)) AS step) t),
r AS (SELECT part, filter_order, step, x,
             coalesce(sum(n) FILTER (len(translate(mask, before || x, '')) = len(mask)), 0) AS kept,
             coalesce(sum(n) FILTER (contains(mask, x) AND len(translate(mask, before, '')) = len(mask)), 0) AS removed,
             coalesce(sum(n) FILTER (contains(mask, x) AND len(translate(mask, before, '')) < len(mask)), 0) AS redundant,
             coalesce(sum(n) FILTER (mask = x), 0) AS unique_fails,
             coalesce(sum(good) FILTER (contains(mask, x) AND len(translate(mask, before, '')) = len(mask)), 0) AS good_lost,
             coalesce(sum(bad) FILTER (contains(mask, x) AND len(translate(mask, before, '')) = len(mask)), 0) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, x)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r"""


@query
def op13_parity_join(spark, sf_dir):
    return parity_join.jaccard_groups(documents(spark, sf_dir))


ORACLE["op10_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
places AS (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2),
windows AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS n FROM places),
covered AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words
            FROM windows, (SELECT unnest([0, 1, 2]) AS k) t WHERE n > 1 GROUP BY rid),
counted AS (
  SELECT doc_id, text, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(regexp_replace(text, '\P{{L}}', '', 'g')) AS letters, length(regexp_replace(text, '\P{{Lu}}', '', 'g')) AS capitals
  FROM w LEFT JOIN covered USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND n_symbols <= {rules.MAX_SYMBOLS_PER_WORD} * n_words AND n_dup_lines <= {rules.MAX_DUP_LINES} * n_lines
       AND word_chars BETWEEN {rules.MEAN_WORD[0]} * n_words AND {rules.MEAN_WORD[1]} * n_words
       AND letters >= {rules.MIN_LETTERS} * word_chars AND capitals <= {rules.MAX_SHOUTING} * word_chars AS kept
FROM judged"""
