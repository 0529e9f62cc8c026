"""Leakage and reuse: families and spans that cross splits, held-out ids, contamination, set hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.functions.text import let
from cartulary.tables import materialize


class LeakageError(ValueError):
    """Rows are where they must not be."""


def crossing(rows: DataFrame, key: str, split: str = "split") -> DataFrame:
    """(key, splits) of keys in more than one split."""
    found = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(split)).alias("splits"))
    return found.where(F.size("splits") > 1)


def span_keys(evidence: Column) -> Column:
    """H: and the quote's hash, else e: and the element's id."""
    keys = F.transform(evidence, lambda e: F.when(F.coalesce(e["quote_sha256"], F.lit("")) != "", F.concat(F.lit("h:"), e["quote_sha256"])).when(F.coalesce(e["element_id"], F.lit("")) != "", F.concat(F.lit("e:"), e["element_id"])))
    return F.array_distinct(F.filter(keys, lambda k: k.isNotNull()))


def leaked(candidates: DataFrame, held_out: DataFrame, key: str) -> DataFrame:
    """Candidates whose key is held out."""
    return candidates.join(held_out.select(key).distinct(), key, "left_semi")


def assert_no_leak(candidates: DataFrame, held_out: DataFrame, key: str, *, where: str = "", shown: int = 10) -> None:
    some = [r[0] for r in leaked(candidates, held_out, key).select(key).distinct().orderBy(key).limit(shown).collect()]
    if some:
        raise LeakageError(f"held-out {key} in {where or 'candidates'}: {some}")


def word_ngrams(text: Column, n: int) -> Column:
    """The distinct runs of n words of a text."""

    def grams(words: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1))), lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(n))))
        return F.array_distinct(F.when(F.size(words) >= n, every).otherwise(F.array().cast("array<string>")))

    return let(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)(\w+)"), 1), grams)


def contamination(docs: DataFrame, benchmark: DataFrame, *, n: int = 8, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shared): word n-grams that a document shares with a benchmark item. The benchmark's n-grams
    are the small side; only documents' n-grams that it has leave their tasks."""
    items = benchmark.select(F.col(item_id), F.explode(word_ngrams(F.col(text), n)).alias("gram"))
    grams = docs.select(F.col(doc_id), F.explode(word_ngrams(F.col(text), n)).alias("gram"))
    return grams.join(items, "gram").groupBy(doc_id, item_id).agg(F.count("*").alias("n_shared"))


def category_counts(rows: DataFrame, key: str = "category") -> DataFrame:
    """(key, n)."""
    return rows.groupBy(key).agg(F.count("*").alias("n"))


def family_versions(rows: DataFrame, *, family: str = "document_family_id", version: str = "document_version") -> DataFrame:
    """(family, versions) of families with more than one version, which must stay in one split together."""
    found = rows.where(F.col(family).isNotNull()).groupBy(family).agg(F.array_sort(F.collect_set(F.nullif(F.col(version), F.lit("")))).alias("versions"), F.countDistinct(F.coalesce(F.col(version), F.lit(""))).alias("_n"))
    return found.where("_n > 1").drop("_n")


def set_hash(rows: DataFrame, key: str) -> DataFrame:
    """SHA-256 over the sorted ids, newline-joined: a manifest's number, for sets that a manifest lists."""
    return rows.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.col(key).cast("string"))), "\n"), 256).alias("id_sha256"), F.count(key).alias("n"))


def slice_rows(rows: DataFrame, *, order: list, start: int, end: int) -> DataFrame:
    """Rows start to end (exclusive) of an order, without a window over the whole table: the sorted table is written
    with its partitions' numbers, whose rows are counted then (a number for each partition goes to the driver)."""
    ordered = materialize(rows.orderBy(*order).withColumn("_p", F.spark_partition_id()), "sorted")
    counted = ordered.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    before, total = {}, 0
    for r in counted.groupBy("_p").agg(F.count("*").alias("n")).orderBy("_p").collect():
        before[r["_p"]] = total
        total += r["n"]
    if not before:
        return rows.limit(0)
    base = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])[F.col("_p")]
    at = F.col("_n") + base - 1
    return counted.where((at >= start) & (at < end)).drop("_p", "_n")


def assert_single_scoring(accesses: DataFrame, *, flag: str = "scoring") -> int:
    """How often the held-out set was scored, which may be once."""
    n = accesses.where(F.coalesce(F.col(flag), F.lit(False))).count()
    if n > 1:
        raise LeakageError(f"the held-out set was scored {n} times")
    return n


def artifact_set_hash(outputs: DataFrame) -> DataFrame:
    """One row: artifact_set_sha256 over the outputs' (path, sha256), sorted by their canonical JSON texts: a run's
    own list of files."""
    item = F.concat(F.lit('{"path":'), F.to_json(F.array("path")).substr(F.lit(2), F.length(F.to_json(F.array("path"))) - 2), F.lit(',"sha256":"'), F.col("sha256"), F.lit('"}'))
    return outputs.agg(F.sha2(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(item)), ","), F.lit("]")), 256).alias("artifact_set_sha256"), F.count("*").alias("n"))


def reuse_counts(rounds: DataFrame) -> DataFrame:
    """(id, n_rounds) from (id, round): distinct rounds that an id was used in."""
    return rounds.groupBy("id").agg(F.countDistinct("round").alias("n_rounds"))
