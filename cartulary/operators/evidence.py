"""Evidence: quotes found in elements, records verified against parsed documents, rewards, error classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.functions.numbers import answer_numbers, close_to, computed, evidence_numbers, groundable
from cartulary.functions.pii import has_real
from cartulary.functions.text import let, looks_ocr_noisy, nfkc_all, norm_quote, strip

# Categories that call for abstention or need no grounding, markers of abstention, weights, error order.
ABSTAIN = ("unanswerable", "conflicting_evidence", "prompt_injection")
UNGROUNDED = ("unanswerable", "calculation", "prompt_injection", "conflicting_evidence")
WEIGHTS = {"evidence_validity": 2.0, "numeric_consistency": 1.5, "schema_compliance": 1.0, "calculation": 1.5, "abstention": 1.5, "pii_nonexposure": 2.0, "version_recency": 1.0}
ERRORS = ("grounding", "wrong_version", "numeric_unit", "abstention", "ocr", "citation", "schema", "policy_violation", "other")

#: A record's evidence.
EVIDENCE = "array<struct<document_sha256:string,document_version:string,page:int,element_id:string,quote:string,quote_sha256:string>>"


def find_quotes(elements: DataFrame, quotes: DataFrame, *, compose: bool = True) -> DataFrame:
    """(quote_id, doc_id, element_id) of the first element in a quote's document that contains it."""
    q = quotes.select("quote_id", "doc_id", norm_quote(F.col("quote"), compose=compose).alias("q"))
    hit = elements.select("doc_id", "element_id", "index", "text").join(q, "doc_id").where(F.contains(F.col("text"), F.col("q")))
    first = hit.groupBy("quote_id", "doc_id").agg(F.min_by("element_id", "index").alias("element_id"))
    return quotes.select("quote_id", "doc_id").join(first, ["quote_id", "doc_id"], "left")


def find_quotes_anywhere(elements: DataFrame, quotes: DataFrame, *, n: int = 5, compose: bool = True) -> DataFrame:
    """J8 without a known document: (quote_id, doc_id, element_id) of the first element of each document that contains
    a quote. Candidates share the rarest of a quote's word n-grams (by the quotes' own counts), whole words only, with
    an element; quotes of fewer than n + 2 words are looked for in every element, in blocks. elements' texts are in N2."""
    q = quotes.select("quote_id", norm_quote(F.col("quote"), compose=compose).alias("q")).where("q <> ''")
    words = q.select("*", F.split("q", " ").alias("w"))
    # A quote may begin and end within a word: its first and last words tell nothing of the element's words.
    inner = F.when(F.size("w") >= n + 2, F.transform(F.sequence(F.lit(2), F.size("w") - n), lambda i: F.array_join(F.slice("w", i, n), " ")))
    grams = words.select("quote_id", F.explode(F.array_distinct(inner)).alias("gram"))
    held = grams.groupBy("gram").agg(F.count("*").alias("held"))
    key = grams.join(held, "gram").groupBy("quote_id").agg(F.min(F.struct("held", "gram"))["gram"].alias("gram"))
    egrams = let(F.split("text", " "), lambda w: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))))
    rows = elements.select("doc_id", "element_id", "index", "text")
    pairs = rows.select("doc_id", "element_id", "index", F.explode(F.array_distinct(egrams)).alias("gram")).join(key, "gram").select("quote_id", "doc_id", "element_id", "index").distinct()
    met = pairs.join(rows, ["doc_id", "element_id", "index"]).join(q, "quote_id").where(F.contains("text", "q"))
    short = words.where(F.size("w") < n + 2).select("quote_id", "q")
    found = met.select("quote_id", "doc_id", "element_id", "index")
    if not short.isEmpty():
        found = found.unionByName(rows.join(short, F.contains(F.col("text"), F.col("q"))).select("quote_id", "doc_id", "element_id", "index"))
    return found.groupBy("quote_id", "doc_id").agg(F.min_by("element_id", "index").alias("element_id"))


def verify(records: DataFrame, elements: DataFrame, *, compose: bool = True) -> DataFrame:
    """(qa_id, ok, has_evidence, element_exists, page_match, quote_present, quote_hash, numeric_grounded).

    A check is null where nothing was checked and false once any piece of evidence fails it. elements:
    (document_sha256, element_id, page, text). An unknown document fails the record and no check."""
    cited = records.select("qa_id", F.posexplode("evidence").alias("i", "e")).select("qa_id", "i", "e.*")
    docs = elements.select("document_sha256").distinct().withColumn("_known", F.lit(True))
    found = elements.select("document_sha256", "element_id", F.col("page").alias("_page"), F.col("text").alias("_text")).dropDuplicates(["document_sha256", "element_id"])
    rows = cited.join(docs, "document_sha256", "left").join(found, ["document_sha256", "element_id"], "left")
    quote = norm_quote(F.col("quote"), compose=compose)
    known, there = F.coalesce("_known", F.lit(False)), F.col("_text").isNotNull()
    rows = rows.withColumns({"_quote": quote, "_there": there})
    rows = rows.withColumn("_present", F.when(F.col("_there"), F.contains("_text", "_quote")))
    per = rows.groupBy("qa_id").agg(
        F.bool_and(known).alias("all_known"),
        F.bool_and(F.when(known, F.col("_there"))).alias("element_exists"),
        F.bool_and(F.when(F.col("_there"), F.col("_page").eqNullSafe(F.col("page")))).alias("page_match"),
        F.bool_and("_present").alias("quote_present"),
        F.bool_and(F.when(F.col("_there"), F.sha2("_quote", 256).eqNullSafe(F.col("quote_sha256")))).alias("quote_hash"),
        F.flatten(F.collect_list(F.when(F.col("_present"), groundable(F.col("_quote"))))).alias("_tokens"),
    )
    out = records.join(per, "qa_id", "left")
    answerable = F.coalesce("answerable", F.lit(True))
    needs = answerable & ~F.coalesce(F.col("category").isin(*UNGROUNDED), F.lit(False))
    empty = F.coalesce(F.size("evidence"), F.lit(0)) <= 0
    bare = empty & answerable & ~F.coalesce(F.col("category") == "unanswerable", F.lit(False))
    tokens = F.coalesce("_tokens", F.array().cast("array<string>"))
    grounded = F.when(needs & ~bare, F.size(F.array_except(groundable(F.col("answer")), tokens)) == 0)
    checks = ("element_exists", "page_match", "quote_present", "quote_hash", "numeric_grounded")
    out = out.withColumns({"has_evidence": F.when(bare, F.lit(False)), "numeric_grounded": grounded})
    ok = ~bare & F.coalesce("all_known", F.lit(True)) & reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(True)) for c in checks])
    return out.select("qa_id", ok.alias("ok"), "has_evidence", *checks)


def verified_only(records: DataFrame, verified: DataFrame) -> DataFrame:
    """Records that didn't fail verification."""
    return records.join(verified.where(~F.coalesce(F.col("ok"), F.lit(False))).select("qa_id").distinct(), "qa_id", "left_anti")


def gate(records: DataFrame) -> DataFrame:
    """Records with quarantine_reason: real_pii_detected where an answer or a quote has real personal data, else null."""
    blob = F.concat_ws(" ", F.coalesce("answer", F.lit("")), F.transform("evidence", lambda x: F.coalesce(x["quote"], F.lit(""))))
    return records.withColumn("quarantine_reason", F.when(has_real(blob), "real_pii_detected"))


def integrity(verified: DataFrame) -> DataFrame:
    """A4: one row: n, n_ok and their ratio, 1.0 without rows."""
    return verified.agg(F.count("*").alias("n"), F.count_if("ok").alias("n_ok"), F.coalesce(F.avg(F.col("ok").cast("double")), F.lit(1.0)).alias("integrity"))


def abstains(answer: Column, markers: tuple[str, ...]) -> Column:
    low = F.lower(F.coalesce(answer, F.lit("")))
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(m.lower())) for m in markers])


def rewards(records: DataFrame, *, markers: tuple[str, ...], latest_version: str | None = None, schema_ok: Column | None = None, compose: bool = True) -> DataFrame:
    """(qa_id, the seven components, length_penalty, total). Records: qa_id, answer, answerable, category,
    source_status, document_version, computation (op, operands), answer_value, evidence."""
    records = records.withColumn("evidence", F.coalesce("evidence", F.array().cast(EVIDENCE)))
    e = F.col("evidence")
    records = records.withColumn("_composed", nfkc_all(F.transform(e, lambda x: x["quote"])) if compose else F.transform(e, lambda x: x["quote"]))
    answer, answerable = F.coalesce("answer", F.lit("")), F.coalesce("answerable", F.lit(True))
    abstain_kind = F.coalesce(F.col("category").isin(*ABSTAIN), F.lit(False))

    def good(x: Column, i: Column) -> Column:
        quote = norm_quote(F.get(F.col("_composed"), i), compose=False)
        return (quote != "") & F.coalesce(x["quote_sha256"] == F.sha2(quote, 256), F.lit(False)) & F.coalesce(x["page"] >= 1, F.lit(False)) & (F.coalesce(x["element_id"], F.lit("")) != "")

    validity = F.when(F.size(e) > 0, F.size(F.filter(e, good)) / F.size(e)).when(abstain_kind | ~answerable, 1.0).otherwise(0.0)
    quoted = F.flatten(F.transform(e, lambda x: groundable(x["quote"])))
    said = groundable(answer)
    numeric = F.when(F.coalesce(F.col("category").isin(*UNGROUNDED), F.lit(False)) | ~answerable | (F.size(said) == 0), 1.0).otherwise(let(F.struct(said.alias("s"), quoted.alias("q")), lambda p: F.size(F.filter(p["s"], lambda t: F.array_contains(p["q"], t))) / F.size(p["s"])))
    first = F.get(F.filter(F.transform(evidence_numbers(answer), lambda n: n.try_cast("double")), lambda x: x.isNotNull()), F.lit(0))
    op = F.col("computation.op")
    expected = F.when(op.isin("sum", "difference", "product", "ratio", "percent"), computed(op, F.col("computation.operands"))).otherwise(F.col("answer_value"))
    no_check = ~F.coalesce(op.isin("sum", "difference", "product", "ratio", "percent"), F.lit(False)) & F.col("answer_value").isNull()
    calculation = F.when(F.coalesce(F.col("category"), F.lit("")) != "calculation", 1.0).when(first.isNull(), 0.0).when(no_check, 1.0).when(F.coalesce(close_to(first, expected), F.lit(False)), 1.0).otherwise(0.0)
    abstained = abstains(answer, markers)
    should = ~answerable | abstain_kind
    made_up = (F.coalesce(F.col("category"), F.lit("")) == "unanswerable") & (F.size(e) > 0)
    abstention = F.when(should, F.when(abstained & ~made_up, 1.0).otherwise(0.0)).otherwise(F.when(abstained, 0.0).otherwise(1.0))
    blob = F.concat(answer, F.lit(" "), F.concat_ws(" ", F.transform(e, lambda x: F.coalesce(x["quote"], F.lit("")))))
    stale = F.coalesce(F.col("source_status").isin("stale", "revoked"), F.lit(False))
    cited = F.filter(F.transform(e, lambda x: x["document_version"]), lambda v: F.coalesce(v, F.lit("")) != "")
    cited = F.when(F.size(cited) > 0, cited).when(F.coalesce("document_version", F.lit("")) != "", F.array("document_version")).otherwise(F.array().cast("array<string>"))
    recency = F.when(stale, 0.0).when(F.lit(latest_version is None), 1.0).when(F.forall(cited, lambda v: v == F.lit(latest_version)), 1.0).otherwise(0.0)
    text, quotes = strip(answer), strip(F.concat_ws(" ", F.transform(e, lambda x: F.coalesce(x["quote"], F.lit("")))))
    pad = F.when(answerable & ~abstain_kind & (quotes != ""), F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.length(text) / F.greatest(F.lit(1), F.length(quotes)) - 1.5) / 3.0))).otherwise(0.0)
    copied = F.when((quotes != "") & (F.length(text) > 40) & (norm_quote(text, compose=compose) == norm_quote(quotes, compose=compose)), 1.0).otherwise(0.0)
    penalty = F.when(text == "", 0.0).otherwise(F.greatest(pad, copied))
    parts = {"evidence_validity": validity, "numeric_consistency": numeric, "schema_compliance": F.when(F.lit(True) if schema_ok is None else schema_ok, 1.0).otherwise(0.0), "calculation": calculation, "abstention": abstention, "pii_nonexposure": F.when(has_real(blob), 0.0).otherwise(1.0), "version_recency": recency}
    out = records.select("qa_id", *[c.cast("double").alias(n) for n, c in parts.items()], penalty.alias("length_penalty"))
    mean = sum((F.col(n) * w for n, w in WEIGHTS.items()), F.lit(0.0)) / sum(WEIGHTS.values())
    return out.withColumn("total", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), mean * (1 - F.col("length_penalty")))), 6))


def classify(records: DataFrame, scored: DataFrame, *, gold: DataFrame | None = None, verified: DataFrame | None = None) -> DataFrame:
    """(qa_id, categories) in the fixed order, from rewards (scored), and gold answers (qa_id, answer, answerable)
    and verification where they are given."""
    rows = records.join(scored.drop("total", "length_penalty"), "qa_id")
    rows = rows.join(gold.select("qa_id", F.col("answer").alias("_gold"), F.coalesce("answerable", F.lit(True)).alias("_gold_answerable")), "qa_id", "left") if gold is not None else rows.withColumns({"_gold": F.lit(None).cast("string"), "_gold_answerable": F.lit(False)})
    rows = rows.join(verified.select("qa_id", F.col("ok").alias("_ok")), "qa_id", "left") if verified is not None else rows.withColumn("_ok", F.lit(None).cast("boolean"))
    factual = F.coalesce("answerable", F.lit(True)) & ~F.coalesce(F.col("category").isin(*ABSTAIN), F.lit(False))
    none = F.coalesce(F.size("evidence"), F.lit(0)) <= 0
    gold_numbers, numbers = F.array_distinct(answer_numbers(F.col("_gold"))), F.array_distinct(answer_numbers(F.col("answer")))
    unequal = (F.size(F.array_except(gold_numbers, numbers)) > 0) | (F.size(F.array_except(numbers, gold_numbers)) > 0)
    quotes = F.concat_ws(" ", F.transform("evidence", lambda x: F.coalesce(x["quote"], F.lit(""))))
    is_ = {
        "grounding": factual & (F.coalesce(~F.col("_ok"), F.lit(False)) | (F.col("_ok").isNull() & ~none & (F.col("numeric_consistency") == 0))),
        "wrong_version": F.col("version_recency") == 0,
        "numeric_unit": F.coalesce("_gold_answerable", F.lit(False)) & (F.size(gold_numbers) > 0) & unequal,
        "abstention": F.col("abstention") == 0,
        "ocr": looks_ocr_noisy(F.concat(F.coalesce("answer", F.lit("")), F.lit(" "), quotes)),
        "citation": factual & (none | (F.col("evidence_validity") == 0)),
        "schema": F.col("schema_compliance") == 0,
        "policy_violation": F.col("pii_nonexposure") == 0,
    }
    return rows.select("qa_id", F.array_compact(F.array(*[F.when(F.coalesce(is_[k], F.lit(False)), F.lit(k)) for k in ERRORS if k in is_])).alias("categories"))


def error_summary(classified: DataFrame) -> DataFrame:
    """(category, n) in the categories' fixed order."""
    place = F.array_position(F.array(*[F.lit(e) for e in ERRORS]), F.col("category"))
    return classified.select(F.explode("categories").alias("category")).groupBy("category").agg(F.count("*").alias("n")).orderBy(place, "category")


def nearest_before(rows: DataFrame, *, key: str, order: str, value: Column) -> DataFrame:
    """As-of: rows with _before, the last non-null value before each in its key."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_before", F.last(value, True).over(w))
