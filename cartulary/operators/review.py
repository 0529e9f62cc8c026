"""The review log: hash-chained events, projection to a status, edits, training export, lineage."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Actions and the states they lead to, reasons to reject, event fields under the hash.
STATUS_OF = {"accept": "approved", "edit": "edited", "reject": "rejected", "reopen": "owner_review_pending"}
DEFAULT_STATUS = "owner_review_pending"
APPROVED = ("approved", "edited")
REJECT_REASONS = ("ungrounded", "wrong_value", "wrong_version", "numeric_unit_error", "pii_exposure", "schema_violation", "policy_violation", "ocr_error", "hallucinated_citation", "duplicate", "other")
HASHED = ("qa_id", "action", "reviewer", "timestamp", "reject_reason", "edits", "evidence_anchor", "prev_event_id", "note")


def status_of(action: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in STATUS_OF.items() for x in kv])[action], F.lit(DEFAULT_STATUS))


@F.pandas_udf(T.StringType())
def canonical_sha256(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Of a JSON text: SHA-256 of the same value with sorted keys, no spaces, nulls kept, UTF-8."""
    for batch in rows:
        yield batch.map(lambda x: _canonical(_with_edits(json.loads(x))), na_action="ignore")


def _canonical(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode("utf-8")).hexdigest()


def _with_edits(value):
    """An event without edits has an empty list of them under its hash."""
    return value | {"edits": value["edits"] or []} if isinstance(value, dict) and "edits" in value else value


def with_hash(events: DataFrame) -> DataFrame:
    """Events with event_sha256 and event_id over the hashed fields (absent ones are null)."""
    body = F.to_json(F.struct(*[(F.col(c) if c in events.columns else F.lit(None).cast("string")).alias(c) for c in HASHED]), {"ignoreNullFields": "false"})
    hashed = events.withColumn("event_sha256", canonical_sha256(body))
    return hashed.withColumn("event_id", F.substring("event_sha256", 1, 24))


def bad_events(events: DataFrame) -> DataFrame:
    """Events that can't be: unknown action or reason, or a rejection without a reason."""
    known = F.col("action").isin(*STATUS_OF)
    reason = F.col("reject_reason")
    return events.where(~F.coalesce(known, F.lit(False)) | ((F.col("action") == "reject") & reason.isNull()) | (reason.isNotNull() & ~reason.isin(*REJECT_REASONS)))


def chain(events: DataFrame, *, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Events with prev_event_id (the id of the one before of the same qa_id), which their own hash covers, and so
    with event_sha256 and event_id. A chain is made in order, but a task holds only the last id of the qa_id it is at."""
    bare = events.drop("prev_event_id", "event_sha256", "event_id")
    body = F.struct(*[(F.col(c) if c in bare.columns else F.lit(None).cast("string")).alias(c) for c in HASHED])
    rows = bare.withColumn("_body", F.to_json(body, {"ignoreNullFields": "false"})).repartition("qa_id").sortWithinPartitions("qa_id", *order)
    schema = T.StructType([*bare.schema.fields, *[T.StructField(c, T.StringType()) for c in ("prev_event_id", "event_sha256", "event_id")]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = last = None
        for pdf in batches:
            marks = []
            for key, body in zip(pdf["qa_id"], pdf["_body"], strict=True):
                before = last if key == at else None
                content = json.loads(body) | {"prev_event_id": before}
                content["edits"] = content["edits"] or []
                digest = _canonical(content)
                at, last = key, digest[:24]
                marks.append((before, digest, last))
            yield pdf.drop(columns="_body").assign(**dict(zip(("prev_event_id", "event_sha256", "event_id"), zip(*marks, strict=True) if marks else ([], [], []), strict=True)))

    return rows.mapInPandas(run, schema)


def chain_faults(events: DataFrame, *, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """(qa_id, event_id, fault) of events whose hash isn't that of their content (bad_hash), whose id was there
    before (duplicate_id), or that don't follow the one before of their qa_id (broken_chain)."""
    body = F.to_json(F.struct(*[(F.col(c) if c in events.columns else F.lit(None).cast("string")).alias(c) for c in HASHED]), {"ignoreNullFields": "false"})
    twice = Window.partitionBy("event_id").orderBy(*order)
    before = F.lag("event_id").over(Window.partitionBy("qa_id").orderBy(*order))
    rows = events.withColumns({"_hash": canonical_sha256(body), "_n": F.row_number().over(twice), "_before": before})
    fault = F.when(~F.col("event_sha256").eqNullSafe(F.col("_hash")), "bad_hash").when(F.col("_n") > 1, "duplicate_id").when(~F.col("prev_event_id").eqNullSafe(F.col("_before")), "broken_chain")
    return rows.withColumn("fault", fault).where("fault is not null").select("qa_id", "event_id", "fault")


def latest(events: DataFrame, *, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The last event of each qa_id as (qa_id, action, reviewer, event_id, review_status). Partly summed in tasks."""
    last = events.groupBy("qa_id").agg(F.max(F.struct(*dict.fromkeys((*order, "action", "reviewer", "event_id")))).alias("e"))
    return last.select("qa_id", "e.action", "e.reviewer", "e.event_id", status_of(F.col("e.action")).alias("review_status"))


def edited_fields(records: DataFrame, events: DataFrame, *, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """(qa_id, field, original, value, n_edits): the last edit of each field wins; original is the first edit's old value."""
    one = events.where("action = 'edit'").select("qa_id", *order, F.posexplode("edits").alias("at", "x"))
    by = F.struct(*order, "at")
    got = one.groupBy("qa_id", F.col("x.field").alias("field")).agg(F.min_by("x.old", by).alias("original"), F.max_by("x.new", by).alias("value"), F.count("*").alias("n_edits"))
    return got.join(records.select("qa_id").distinct(), "qa_id", "left_semi")


def export_training(records: DataFrame, events: DataFrame, allowed: DataFrame, *, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Records with review_status, review_event_id, reviewer and split: train, quarantine or pending."""
    last = latest(events, order=order).select("qa_id", F.col("event_id").alias("review_event_id"), "reviewer", "review_status")
    rows = records.drop("review_status").join(last, "qa_id", "left").join(allowed.select("qa_id", F.lit(True).alias("_allowed")).dropDuplicates(["qa_id"]), "qa_id", "left")
    rows = rows.withColumn("review_status", F.coalesce("review_status", F.lit(DEFAULT_STATUS)))
    split = F.when(F.col("review_status") == "rejected", "quarantine").when(F.col("review_status").isin(*APPROVED) & F.coalesce("_allowed", F.lit(False)), "train").otherwise("pending")
    return rows.withColumn("split", split).drop("_allowed")


def redact_for_report(records: DataFrame, *, has_source_access: bool = False) -> DataFrame:
    """P20: records whose evidence keeps its addresses and hashes but not the quotes, for readers without the sources."""
    if has_source_access:
        return records
    shown = F.transform("evidence", lambda e: e.withField("quote", F.lit(None).cast("string")).withField("quote_redacted", F.lit(True)))
    return records.withColumns({"evidence": shown, "source_redacted": F.lit(True)})


def trace(records: DataFrame, events: DataFrame, *, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """(qa_id, review_status, approved, n_events, n_evidence, traceable)."""
    n = events.groupBy("qa_id").agg(F.count("*").alias("n_events"))
    rows = records.select("qa_id", F.size(F.coalesce("evidence", F.array().cast(records.schema["evidence"].dataType))).alias("n_evidence"))
    out = rows.join(n, "qa_id", "left").join(latest(events, order=order).select("qa_id", "review_status"), "qa_id", "left")
    out = out.withColumns({"n_events": F.coalesce("n_events", F.lit(0)), "review_status": F.coalesce("review_status", F.lit(DEFAULT_STATUS))})
    return out.select("qa_id", "review_status", F.col("review_status").isin(*APPROVED).alias("approved"), "n_events", "n_evidence", ((F.col("n_events") > 0) & (F.col("n_evidence") > 0)).alias("traceable"))
