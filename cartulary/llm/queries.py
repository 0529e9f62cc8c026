"""The registered queries of the corpus operators: each applies its operator to whole tables of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm import fingerprints, language_model, licenses, merge_dropout, packing, quality_rules, secret_scan, simhash, token_output, toxicity
from cartulary.llm.common import fold_of, read_table, shared_folder
from cartulary.session import shipped

#: Where the vocabulary files of public tokenizers are.
TOKENIZER_PATH = public_tokenizers.path


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_versions(read_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_layers")


def op3_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ids_crc32 is over the ids' decimal texts, comma-joined; decoded_sha256 over the text that the ids decode to."""
    model = TOKENIZER_PATH("piece_bpe_32k.model")
    encoded = merge_dropout.encode_with_dropout(read_table(spark, sf_dir, "documents"), path=model)
    encoded = encoded.withColumns({"n_ids": F.size("ids").cast("long"), "ids_crc32": F.crc32(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"))})
    decoded = merge_dropout.decode(encoded, path=model, keep=("n_ids", "ids_crc32"))
    return decoded.select("doc_id", "n_ids", "ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/cartulary-segments-{uuid.uuid4().hex}"
    token_output.write_segments(read_table(spark, sf_dir, "documents"), path, tokenizer=TOKENIZER_PATH("word_bpe_49k.json"), end_id=1)
    return token_output.read_segments(spark, path).withColumnRenamed("id", "doc_id")


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    net, counts = language_model.fit(docs.where(fold_of(F.col("doc_id")) != 1))
    scored = language_model.score(docs, net, counts)
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(net.v.total).cast("long").alias("train_tokens"), "base_score", "score")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op6_sql() -> str:
    low, high = licenses.THRESHOLD, 2 - licenses.THRESHOLD
    values = ", ".join(f"('{name}', {words}, [{', '.join(repr(g) for g in grams)}])" for name, words, grams in licenses.templates())
    return f"""
    WITH t AS (SELECT row_number() OVER () AS tid, name, n, grams, len(grams) AS b FROM (VALUES {values}) AS v(name, n, grams)),
    r AS (SELECT row_number() OVER () AS rid, doc_id, list_distinct([coalesce(text, '')] || string_split(coalesce(text, ''), chr(10))) AS units, coalesce(text, '') AS text FROM documents),
    e AS (SELECT rid, doc_id, len(units) AS n_units, unnest(units) AS unit FROM r),
    w AS (SELECT rid, doc_id, n_units, list_filter(string_split(regexp_replace(lower(unit), '[^0-9a-z]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM e),
    g AS (SELECT row_number() OVER () AS uid, rid, doc_id, n_units, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w),
    s AS (SELECT uid, rid, name, b, 2.0::DOUBLE * len(list_intersect(grams, g)) / (b + len(g)) AS score FROM g JOIN t
          ON b * {high} >= len(g) * {low} AND b * {low} <= len(g) * {high}),
    h AS (SELECT * FROM s WHERE score >= {low}),
    ww AS (SELECT rid, list_filter(string_split(regexp_replace(lower(text), '[^0-9a-z]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM r),
    o AS (SELECT rid, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS o FROM ww),
    c AS (SELECT rid, tid, name, n, grams, b, o FROM o JOIN t ON len(list_intersect(grams, o)) * {high} >= b * {low}),
    p AS (SELECT rid, tid, name, n, grams, b, o, unnest(range(1, len(o) + 1)) AS i FROM c),
    x AS (SELECT rid, tid, name, b, grams, list_distinct(o[i:i + n - 2]) AS g FROM p WHERE list_contains(grams, o[i])),
    y AS (SELECT rid, tid, name, b, max(2.0::DOUBLE * len(list_intersect(grams, g)) / (b + len(g))) AS score FROM x GROUP BY ALL HAVING score >= {low}),
    best AS (SELECT rid, name, score FROM (SELECT rid, name, b, score FROM h UNION ALL SELECT rid, name, b, score FROM y) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, b DESC, name) = 1),
    k AS (SELECT rid, count(DISTINCT uid) AS n_matches FROM h GROUP BY rid),
    v AS (SELECT rid, count(*) AS n_windows FROM y GROUP BY rid),
    d AS (SELECT DISTINCT rid, doc_id, n_units FROM e)
    SELECT doc_id, name AS license, coalesce(score, 0.0::DOUBLE) AS score, coalesce(n_matches, 0) AS n_matches, n_units, coalesce(n_windows, 0) AS n_window_templates
    FROM d LEFT JOIN best USING (rid) LEFT JOIN k USING (rid) LEFT JOIN v USING (rid)
    """


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels.where(fold_of(F.col("doc_id")) != 0))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", "rejected")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), path=TOKENIZER_PATH("byte_bpe_50k.json"), end_id=1)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality_rules.quality_verdicts(read_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    ops = (op1_fingerprints, op2_secret_scan, op3_merge_dropout, op4_token_output, op5_language_model, op6_licenses, op7_toxicity, op8_simhash, op9_packing, op10_quality_rules)
    return {f.__name__: shipped(f) for f in ops} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    return {"op6_licenses": op6_sql()} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
