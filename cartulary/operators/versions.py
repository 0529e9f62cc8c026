"""Versioned facts: which source answers a fact, how rows part for export, what a new version touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.numbers import partial_date, version_number
from cartulary.functions.text import collapse, strip

# Review states that keep a row out of export.
HELD_REVIEWS = ("rejected", "owner_review_pending")


def fact_key(key: Column, question: Column) -> Column:
    """The given key, else the question; lower case, collapsed if it's the question."""
    return F.when(F.coalesce(key, F.lit("")) != "", F.lower(strip(key))).otherwise(collapse(F.lower(F.coalesce(question, F.lit("")))))


def in_effect(effective_from: Column, effective_until: Column, as_of: str | None) -> Column:
    """Within both bounds, open where null; true where as_of is no date."""
    if as_of is None:
        return F.lit(True)
    day, low, high = partial_date(F.lit(as_of)), partial_date(effective_from), partial_date(effective_until)
    return day.isNull() | (F.coalesce(low <= day, F.lit(True)) & F.coalesce(day <= high, F.lit(True)))


def select_sources(records: DataFrame, *, as_of: str | None = None, order: str = "pos") -> DataFrame:
    """One row a fact: (fact, selected_id, answer, reason, abstain, mutable, n_considered).

    records: qa_id, fact, answer, source_status, fact_volatility, effective_from, effective_until, document_version
    and a column of input order. All by aggregates that tasks begin, so a fact with many records is no one task's."""
    live = (F.coalesce(F.col("source_status"), F.lit("")) != "revoked") & in_effect(F.col("effective_from"), F.col("effective_until"), as_of)
    active = live & (F.col("source_status") == "active")
    day = F.coalesce(F.datediff(partial_date(F.col("effective_from")), F.lit("0001-01-01").cast("date")).cast("double"), F.lit(float("-inf")))
    # The latest source has the greatest (day, version); among equals the first in input order stands for them.
    rank = F.struct(day.alias("day"), F.coalesce(version_number(F.col("document_version")), F.lit(float("-inf"))).alias("version"))
    rows = records.select("fact", "qa_id", F.coalesce(F.col("answer").cast("string"), F.lit("None")).alias("answer"), F.col(order).alias("_pos"), F.coalesce(F.col("fact_volatility") == "mutable", F.lit(False)).alias("_mutable"), live.alias("_live"), F.coalesce(active, F.lit(False)).alias("_active"), rank.alias("_rank"))
    facts = rows.groupBy("fact").agg(
        F.count("*").alias("n_considered"),
        F.max("_mutable").alias("mutable"),
        F.max("_live").alias("any_live"),
        F.max("_active").alias("any_active"),
        F.max(F.when(F.col("_active"), F.col("_rank"))).alias("best_active"),
        F.max(F.when(F.col("_live"), F.col("_rank"))).alias("best_live"),
    )
    facts = facts.withColumn("best", F.when(F.col("any_active"), F.col("best_active")).otherwise(F.col("best_live")))
    ties = rows.join(facts.select("fact", "best", "any_active"), "fact").where(F.when(F.col("any_active"), F.col("_active")).otherwise(F.col("_live")) & (F.col("_rank") == F.col("best")))
    tied = ties.groupBy("fact").agg(F.min("answer").alias("a0"), F.max("answer").alias("a1"), F.min(F.struct("_pos", "qa_id", "answer")).alias("first"))
    out = facts.join(tied, "fact", "left")
    conflict = F.col("a0") != F.col("a1")
    reason = (
        F.when(~F.col("any_live"), "none_in_effect")
        .when(conflict, "conflict_no_order")
        .when(F.col("any_active"), "selected_latest_active")
        .when(F.col("mutable"), "only_stale_mutable")
        .otherwise("selected_stable_from_stale")
    )
    chosen = F.startswith(F.col("reason"), F.lit("selected"))
    return out.withColumn("reason", reason).select("fact", F.when(chosen, F.col("first.qa_id")).alias("selected_id"), F.when(chosen, F.col("first.answer")).alias("answer"), "reason", (~chosen).alias("abstain"), "mutable", "n_considered")


def partition_for_export(records: DataFrame, *, as_of: str | None = None, order: str = "pos") -> DataFrame:
    """Records with part: active, archive or held."""
    facts = select_sources(records, as_of=as_of, order=order).select("fact", "selected_id", "abstain", "mutable")
    rows = records.join(facts, "fact")
    part = (
        F.when(F.coalesce(F.col("review_status").isin(*HELD_REVIEWS), F.lit(False)), "held")
        .when(F.coalesce(F.col("source_status").isin("stale", "revoked"), F.lit(False)), "archive")
        .when(~F.coalesce(F.col("answerable"), F.lit(True)), "active")
        .when(~F.col("mutable"), "active")
        .when(F.col("abstain"), "held")
        .when(F.col("qa_id") == F.col("selected_id"), "active")
        .otherwise("archive")
    )
    return rows.withColumn("part", part).drop("selected_id", "abstain", "mutable")


def mutable_fact_report(records: DataFrame, *, as_of: str | None = None, order: str = "pos") -> DataFrame:
    """One row over facts with a mutable record."""
    facts = select_sources(records, as_of=as_of, order=order).where("mutable")
    status = records.select(F.col("qa_id").alias("_id"), F.col("fact").alias("_fact"), "source_status").dropDuplicates(["_id", "_fact"])
    picked = facts.select("fact", "selected_id", "abstain").join(status, (F.col("fact") == F.col("_fact")) & (F.col("selected_id") == F.col("_id")), "left")
    return picked.agg(F.count("*").alias("n_mutable_facts"), F.count_if(~F.col("abstain")).alias("resolved"), F.count_if("abstain").alias("abstained"), F.count_if(~F.col("abstain") & (F.col("source_status") == "active")).alias("recency_ok"))


def affected_by_version(records: DataFrame, *, new_version: str, document_id: str) -> DataFrame:
    """Ids of records whose evidence cites the document at another version (the record's where evidence has none)."""
    cited = records.select("qa_id", "document_version", F.explode("evidence").alias("e"))
    version = F.coalesce(F.col("e.document_version"), F.col("document_version"))
    return cited.where((F.col("e.document_id") == document_id) & ~version.eqNullSafe(F.lit(new_version))).select("qa_id").distinct()


def dataset_version(affected: DataFrame, new_version: str) -> DataFrame:
    """Ds- and twelve hex digits over the version and the sorted ids (a set that a release note lists)."""
    ids = affected.agg(F.array_sort(F.collect_set(F.col("qa_id").cast("string"))).alias("ids"))
    return ids.select(F.concat(F.lit("ds-"), F.substring(F.sha2(F.concat_ws("\0", F.lit(new_version), F.col("ids")), 256), 1, 12)).alias("dataset_version"), F.size("ids").alias("n_affected"))
