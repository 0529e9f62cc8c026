"""Lookups: questions in a catalogue, assets in a ledger of patterns, claims at JSON pointers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.jsons import pointer_value


def resolve_questions(asked: DataFrame, catalog: DataFrame) -> DataFrame:
    """(ask_id, found): the id that was asked for if the catalogue has it, else the first entry (by pos) whose
    question contains what was asked, whatever the case. A catalogue is a demo's list: it is the broadcast side's size."""
    ids = catalog.select(F.col("qa_id").alias("_id")).distinct()
    rows = asked.join(ids, F.col("qa_id") == F.col("_id"), "left")
    parts = asked.where(F.coalesce("question", F.lit("")) != "").select("ask_id", F.lower("question").alias("q"))
    hits = parts.join(catalog.select("pos", F.col("qa_id").alias("hit"), F.lower("question").alias("cq")), F.contains(F.col("cq"), F.col("q")))
    first = hits.groupBy("ask_id").agg(F.min_by("hit", "pos").alias("hit"))
    return rows.join(first, "ask_id", "left").select("ask_id", F.coalesce("_id", "hit").alias("found"))


def glob_regex(pattern: Column) -> Column:
    """A glob (*, ?) as an anchored regular expression; * stops at no slash."""
    quoted = F.regexp_replace(pattern, r"([.+^$(){}|\[\]\\])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))


def ledger_gaps(assets: DataFrame, ledger: DataFrame) -> DataFrame:
    """(kind, name): assets that no pattern covers (uncovered) and patterns that cover no asset (unused)."""
    patterns = ledger.select("pattern", glob_regex(F.col("pattern")).alias("re"))
    covers = F.expr("path rlike re")
    uncovered = assets.join(patterns, covers, "left_anti").select(F.lit("uncovered").alias("kind"), F.col("path").alias("name"))
    unused = patterns.join(assets, covers, "left_anti").select(F.lit("unused").alias("kind"), F.col("pattern").alias("name"))
    return uncovered.unionByName(unused)


def check_claims(claims: list[tuple[str, str, float]], documents: DataFrame, *, tolerance: float = 1e-6) -> DataFrame:
    """(doc, pointer, claimed, found, ok) of claims (doc, pointer, number) on a table (doc, body: JSON text). The
    pointers are a report's own list, so they are a plan's columns."""
    rows = documents.select("doc", F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.lit(p).alias("pointer"), F.lit(float(v)).alias("claimed"), pointer_value(F.col("body"), p).try_cast("double").alias("found")) for d, p, v in claims])).alias("c"))
    rows = rows.where(F.col("doc") == F.col("c.d")).select("doc", "c.pointer", "c.claimed", "c.found")
    return rows.withColumn("ok", F.coalesce(F.abs(F.col("found") - F.col("claimed")) <= tolerance, F.lit(False)))


def element_counts(elements: DataFrame) -> DataFrame:
    """(category, n, n_linked): elements by category and how many have an image."""
    return elements.groupBy("category").agg(F.count("*").alias("n"), F.count_if(F.coalesce("image_path", F.lit("")) != "").alias("n_linked"))
