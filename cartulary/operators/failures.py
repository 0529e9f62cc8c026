"""From failures to data: dev failures mined, corrections with lineage, versions of corrected datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.operators.audit import LeakageError, assert_no_leak


def assert_no_final(rows: DataFrame, final_ids: DataFrame, *, where: str = "correction rows") -> None:
    """No row's id, nor the dev id that it derives from, may be held out."""
    assert_no_leak(rows, final_ids, "qa_id", where=where)
    if "derived_from" in rows.columns:
        assert_no_leak(rows.select(F.col("derived_from.dev_qa_id").alias("qa_id")).where("qa_id is not null"), final_ids, "qa_id", where=f"what {where} derive from")


def mine_failures(predictions: DataFrame, classified: DataFrame, *, dev_ids: DataFrame, final_ids: DataFrame, shown: int = 10) -> DataFrame:
    """Predictions with error_categories, of those that have any. classified: (qa_id, categories). Held-out ids
    among the predictions are an error, and so are ids that aren't dev ids: both are looked for before anything else."""
    assert_no_leak(predictions, final_ids, "qa_id", where="mining input")
    other = [r[0] for r in predictions.select("qa_id").join(dev_ids, "qa_id", "left_anti").distinct().orderBy("qa_id").limit(shown).collect()]
    if other:
        raise LeakageError(f"failure mining is for dev ids only, not {other}")
    failing = classified.where(F.size("categories") > 0).select("qa_id", F.col("categories").alias("error_categories"))
    return predictions.join(failing, "qa_id")


def build_corrections(failures: DataFrame, answers: DataFrame, *, final_ids: DataFrame) -> DataFrame:
    """A correction for each failure with a corrected answer (qa_id, corrected_answer, reviewer), with its lineage;
    it waits for a review."""
    assert_no_leak(failures, final_ids, "qa_id", where="failures to correct")
    keep = ("document_sha256", "quote_sha256", "page", "element_id")
    rows = failures.join(answers.select("qa_id", "corrected_answer", "reviewer"), "qa_id")
    cited = F.transform("evidence", lambda e: F.struct(*[e[c].alias(c) for c in keep]))
    return rows.select(
        F.concat(F.lit("corr-"), "qa_id").alias("qa_id"),
        "question",
        F.col("corrected_answer").alias("answer"),
        F.coalesce("answerable", F.lit(True)).alias("answerable"),
        "category",
        "evidence",
        F.struct(F.lit("correction").alias("provider"), F.lit("human").alias("model")).alias("generation"),
        F.lit("owner_review_pending").alias("review_status"),
        F.lit("train").alias("split"),
        F.struct(F.col("qa_id").alias("dev_qa_id"), "error_categories", cited.alias("evidence")).alias("derived_from"),
        "reviewer",
    )


def corrected_version(corrections: DataFrame, *, base_version: str, final_ids: DataFrame) -> DataFrame:
    """One row: dataset_version over the base and the sorted lineage (a release's own list), and n_rows."""
    assert_no_final(corrections, final_ids)
    line = F.concat(F.col("qa_id").cast("string"), F.lit("<-"), F.coalesce(F.col("derived_from.dev_qa_id").cast("string"), F.lit("None")))
    lines = corrections.agg(F.array_sort(F.collect_list(line)).alias("lines"))
    digest = F.sha2(F.concat_ws("\0", F.lit(base_version), F.col("lines")), 256)
    return lines.select(F.concat(F.lit("ds-"), F.substring(digest, 1, 12)).alias("dataset_version"), F.lit(base_version).alias("base_version"), F.size("lines").cast("long").alias("n_rows"))
