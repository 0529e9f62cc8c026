"""Operators against sequential versions and fixed cases, on small rows."""

import random

import pytest
from pyspark.sql import functions as F

from cartulary.functions import text
from cartulary.operators import audit, quality, report, review, training, versions
from cartulary.plans.stages import Stage, run_stages
from cartulary.sources import io


def _greedy(texts, threshold):
    import re

    kept, keys, out = [], set(), []
    for t in texts:
        key = re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", t.lower())).strip()
        words = set(re.findall(r"\w+", t.lower()))
        if key in keys:
            out.append("duplicate")
        elif any(words and k and len(words & k) / len(words | k) >= threshold for k in kept):
            out.append("near_duplicate")
        else:
            keys.add(key)
            kept.append(words)
            out.append(None)
    return out


def test_greedy_dedup_matches_a_scan(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.sample("abcdefghij", rng.randrange(4, 9))) for _ in range(60)] + ["", "", "a b c d e", "E d c b a!"]
    rows = spark.createDataFrame(list(enumerate(texts)), "pos int, text string")
    got = {r["pos"]: r["reason"] for r in quality.greedy_dedup(rows, text=F.col("text"), order="pos", threshold=0.7).collect()}
    assert [got[i] for i in range(len(texts))] == _greedy(texts, 0.7)


def test_reject_reasons(spark):
    rows = spark.createDataFrame([("", "a"), ("short", "answer"), ("What is GDP?", "what is gdp"), ("What is it then", "I cannot answer that"), ("What is it then", "a sum")], "q string, a string")
    got = [r[0] for r in rows.select(quality.reject_reason(F.col("q"), F.col("a"))).collect()]
    assert got == ["empty", "too_short", "q_equals_a", "refusal", None]


def test_normalisers(spark):
    row = spark.createDataFrame([("  “Ａ Ｂ”,  c-d. ",)], "x string").select(text.norm_key(F.col("x")), text.norm_quote(F.col("x")), text.norm_answer(F.col("x")), text.norm_index(F.col("x")), text.norm_korquad(F.col("x"))).first()
    assert tuple(row)[1:4] == ("“A B”, c-d.", "a b cd", "a b c d")


def test_version_ties_and_empty(spark):
    schema = "qa_id string, fact string, answer string, source_status string, fact_volatility string, effective_from string, effective_until string, document_version string, pos int"
    rows = [("1", "f", "x", "active", "mutable", "2024", None, "v1", 1), ("2", "f", "y", "active", "mutable", "2024-01-01", None, "1", 2), ("3", "g", "z", "stale", "stable", None, None, None, 3), ("4", "h", None, "revoked", None, None, None, None, 4)]
    got = {r["fact"]: r["reason"] for r in versions.select_sources(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"f": "conflict_no_order", "g": "selected_stable_from_stale", "h": "none_in_effect"}
    assert versions.select_sources(spark.createDataFrame([], schema)).count() == 0


def test_review_hash_chain(spark):
    rows = spark.createDataFrame([("q", "accept", 1), ("q", "reject", 2)], "qa_id string, action string, seq int")
    hashed = review.chain(review.with_hash(rows))
    got = hashed.orderBy("seq").collect()
    assert got[0]["prev_event_id"] is None and got[1]["prev_event_id"] == got[0]["event_id"]
    assert review.chain_faults(hashed).count() == 0


def test_split_and_leak(spark):
    rows = spark.range(1000).withColumnRenamed("id", "k")
    parts = training.seeded_split(rows, "k")
    assert 120 < parts.where("split = 'test'").count() < 280
    with pytest.raises(audit.LeakageError):
        audit.assert_no_leak(rows, rows.where("k < 3"), "k")


def test_nearest_rank_is_half_even(spark):
    rows = spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4)], "x double")
    assert report.nearest_rank(rows, "x", (0.5,)).first()["p50"] == 3.0


def test_stages_resume(spark, tmp_path):
    stages = [Stage("a", lambda s, i: i["src"].where("id > 2")), Stage("b", lambda s, i: i["a"].selectExpr("id * 2 AS id"), needs=("a",))]
    stages[0] = Stage("a", stages[0].run, needs=("src",))
    src = {"src": spark.range(6)}
    assert run_stages(spark, stages, src, str(tmp_path))[1] == ["a", "b"]
    tables, ran = run_stages(spark, stages, src, str(tmp_path))
    assert ran == [] and sorted(r[0] for r in tables["b"].collect()) == [6, 8, 10]


def test_sources(spark, tmp_path):
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text('{"q": "é"}\n\n{"q": "b"}\n', encoding="utf-8")
    bad.write_text('{"q": "c"}\n{"q": \n', encoding="utf-8")
    assert io.read_jsonl(spark, str(good), "q string").count() == 2
    assert [r["q"] for r in io.read_jsonl_or_nothing(spark, str(tmp_path), "q string").orderBy("q").collect()] == ["b", "é"]
    io.write_text_atomically(spark, str(tmp_path / "r.md"), "ok ✓")
    assert (tmp_path / "r.md").read_text(encoding="utf-8") == "ok ✓"


def test_review_stream(spark, tmp_path):
    from cartulary.streaming import review_log

    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"qa_id": "a", "event_id": "1", "action": "accept", "ts": "2024-01-01T00:00:00"}\n{"qa_id": "a", "event_id": "2", "action": "reject", "ts": "2024-01-02T00:00:00"}\n')
    events = spark.readStream.schema("qa_id string, event_id string, action string, ts timestamp").json(str(tmp_path / "in"))
    q = review_log.latest_states(events).writeStream.outputMode("update").format("memory").queryName("states").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["review_status"] for r in spark.table("states").collect()] == ["rejected"]
