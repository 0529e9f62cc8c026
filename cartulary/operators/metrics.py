"""Answer metrics: one row an example, failure classes, aggregates, paired bootstrap."""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.numbers import all_in, answer_dates, answer_numbers, answer_units
from cartulary.functions.text import char_bag, char_f1, composed_quotes, exact_match, nfkc_all, norm_answer
from cartulary.operators.quality import looks_like_abstention
from cartulary.operators.retrieval import recall_at_k

GROUNDED_SHARE = 0.6


def citation_page(pages: Column, gold: Column) -> Column:
    """Null without gold pages, false without predicted ones, else whether all predicted are gold."""
    g, p = (F.array_distinct(F.array_compact(x)) for x in (gold, pages))
    return F.when(F.size(g) > 0, (F.size(p) > 0) & (F.size(F.array_except(p, g)) == 0))


def citation_span(citations: Column, gold: Column, *, compose: bool = True) -> Column:
    """Null without gold evidence; true if a citation shares an id or a hash, or one quote contains the other."""
    text = lambda e: norm_answer(e["quote"], compose=compose)
    filled = lambda x: F.coalesce(x, F.lit("")) != ""

    def meets(c: Column) -> Column:
        def one(g: Column) -> Column:
            same = (filled(g["element_id"]) & F.coalesce(c["element_id"] == g["element_id"], F.lit(False))) | (filled(g["quote_sha256"]) & F.coalesce(c["quote_sha256"] == g["quote_sha256"], F.lit(False)))
            return same | (filled(g["quote"]) & (text(c) != "") & (F.contains(text(g), text(c)) | F.contains(text(c), text(g))))

        return F.exists(gold, one)

    return F.when(F.size(gold) > 0, F.coalesce(F.size(citations) > 0, F.lit(False)) & F.coalesce(F.exists(citations, meets), F.lit(False)))


def grounded(answer: Column, abstained: Column, quotes: Column, *, compose: bool = True) -> Column:
    """Abstained; or all numbers are in the quotes; or 0.6 of the distinct characters are."""
    quoted = F.concat_ws(" ", quotes)
    numbers = answer_numbers(answer)
    a, e = (F.array_distinct(char_bag(norm_answer(x, compose=compose))) for x in (answer, quoted))
    share = F.size(F.array_intersect(a, e)) / F.size(a)
    return abstained | F.when(F.size(numbers) > 0, F.size(F.array_except(numbers, answer_numbers(quoted))) == 0).when(F.size(a) == 0, F.lit(False)).otherwise(share >= GROUNDED_SHARE)


def score_examples(gold: DataFrame, predictions: DataFrame, *, k: int = 5, pii_terms: tuple[str, ...] = (), compose: bool = True) -> DataFrame:
    """A row for each gold record (qa_id, category, answerable, answer, evidence), with its prediction's
    (qa_id, answer, abstained, citations, retrieved) if there is one."""
    p = predictions.select("qa_id", F.col("answer").alias("_answer"), F.col("abstained").alias("_abstained"), F.col("citations").alias("_citations"), F.col("retrieved").alias("_retrieved"), F.lit(True).alias("_there"))
    rows = gold.join(p, "qa_id", "left")
    said, want = F.coalesce("_answer", F.lit("")), F.coalesce("answer", F.lit(""))
    answerable = F.coalesce("answerable", F.lit(True))
    rows = rows.withColumns({"_said": said, "_want": want, "_ok": answerable, "_ab": F.coalesce("_abstained", F.lit(False)) | looks_like_abstention(said)})
    s, w = F.col("_said"), F.col("_want")
    if_answerable = lambda c: F.when(F.col("_ok"), c)
    pages = lambda c: F.transform(c, lambda e: e["page"])
    none = F.array().cast(gold.schema["evidence"].dataType)
    rows = rows.withColumns({"_ev": F.coalesce("evidence", none), "_ci": F.coalesce("_citations", F.array().cast(predictions.schema["citations"].dataType))})
    evidence, cited = F.col("_ev"), F.col("_ci")
    span = citation_span(cited, evidence, compose=False)
    if compose:
        quotes = lambda c: nfkc_all(F.transform(c, lambda e: e["quote"]))
        rows = rows.withColumns({"_evq": quotes("_ev"), "_ciq": quotes("_ci")})
        span = citation_span(composed_quotes(cited, F.col("_ciq")), composed_quotes(evidence, F.col("_evq")), compose=False)
    out = rows.select(
        "qa_id",
        F.coalesce("category", F.lit("unknown")).alias("category"),
        F.col("_ok").alias("answerable"),
        F.col("_ab").alias("abstained"),
        if_answerable(exact_match(s, w, compose=compose)).alias("em"),
        if_answerable(char_f1(s, w, compose=compose)).alias("f1"),
        if_answerable(all_in(answer_numbers(w), answer_numbers(s))).alias("numeric_exact"),
        if_answerable(all_in(answer_units(w), answer_units(s))).alias("unit_exact"),
        if_answerable(all_in(answer_dates(w), answer_dates(s))).alias("date_exact"),
        if_answerable(citation_page(pages(cited), pages(evidence))).alias("citation_page_correct"),
        if_answerable(span).alias("citation_span_correct"),
        (F.coalesce("_there", F.lit(False)) & (s != "")).alias("schema_valid"),
        grounded(s, F.col("_ab"), F.transform(evidence, lambda e: F.coalesce(e["quote"], F.lit(""))), compose=compose).alias("grounded"),
        F.exists(F.array(*[F.lit(t) for t in pii_terms if t] or [F.lit(None).cast("string")]), lambda t: F.coalesce(F.contains(s, t), F.lit(False))).alias("pii_leaked"),
        recall_at_k(F.transform(evidence, lambda e: e["element_id"]), F.col("_retrieved"), k).alias("recall_at_k"),
    )
    return out.withColumn("error_categories", failure_categories())


def failure_categories() -> Column:
    """R14, over the columns of an example's row. Null metrics are no failure."""
    no = lambda c: F.coalesce(~F.col(c), F.lit(False))
    ok = F.col("answerable")
    marks = [
        (ok & (F.coalesce("f1", F.lit(0.0)) < 0.5), "wrong_answer"),
        (ok & (no("numeric_exact") | no("unit_exact") | no("date_exact")), "numeric_unit"),
        (ok & (no("citation_page_correct") | no("citation_span_correct")), "citation"),
        (ok & F.coalesce(F.col("recall_at_k") == 0, F.lit(False)), "retrieval"),
        (ok & F.col("abstained"), "over_abstention"),
        (~ok & ~F.col("abstained"), "missed_abstention"),
        (no("grounded"), "grounding"),
        (no("schema_valid"), "schema"),
        (F.col("pii_leaked"), "pii"),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in marks]))


def aggregate(examples: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Means and rates over what isn't null, and the confusion of abstention; by category too if asked for."""
    ok = F.col("answerable")
    rate = lambda c: F.round(F.avg(F.when(ok, F.col(c).cast("double"))), 4)
    over_all = lambda c: F.round(F.avg(F.col(c).cast("double")), 4)
    tp, fp, fn = F.count_if(F.col("abstained") & ~ok), F.count_if(F.col("abstained") & ok), F.count_if(~F.col("abstained") & ~ok)
    return examples.groupBy(*by).agg(
        F.count("*").alias("n_examples"),
        F.count_if(ok).alias("n_answerable"),
        F.count_if(~ok).alias("n_unanswerable"),
        *[rate(c).alias(f"{c}_rate") for c in ("em", "f1", "numeric_exact", "unit_exact", "date_exact", "citation_page_correct", "citation_span_correct", "recall_at_k")],
        *[over_all(c).alias(f"{c}_rate") for c in ("schema_valid", "grounded", "pii_leaked")],
        tp.alias("abstain_tp"),
        fp.alias("abstain_fp"),
        fn.alias("abstain_fn"),
        F.round(F.try_divide(tp, tp + fp), 4).alias("abstain_precision"),
        F.round(F.try_divide(tp, tp + fn), 4).alias("abstain_recall"),
        *([F.round(F.avg(F.when(~ok, (~F.col("retrieved_any")).cast("double"))), 4).alias("no_answer_retrieval_rate")] if "retrieved_any" in examples.columns else []),
    )


def taxonomy(examples: DataFrame) -> DataFrame:
    """(category, n), most frequent first, then by name."""
    return examples.select(F.explode("error_categories").alias("category")).groupBy("category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category")


def best_over_references(prediction: Column, references: Column, metric) -> Column:
    """The greatest of a metric over an array of references."""
    return F.array_max(F.transform(references, lambda r: metric(prediction, r)))


def paired_bootstrap(a: DataFrame, b: DataFrame, metric: str, *, n: int = 2000, seed: int = 12345, group: str = "arm") -> DataFrame:
    """(arm, n_pairs, delta, low, high, significant): mean of a - b over shared answerable examples and its
    resampled interval. Resampling needs all differences of a comparison in order (an evaluation set, which is small),
    so each comparison is one group."""
    pick = lambda d, name: d.where("answerable").select(group, "qa_id", F.col(metric).cast("double").alias(name))
    both = pick(a, "x").join(pick(b, "y").drop(group), "qa_id").where("x is not null and y is not null").select(group, "qa_id", (F.col("x") - F.col("y")).alias("d"))

    def resample(pdf: pd.DataFrame) -> pd.DataFrame:
        d = pdf.sort_values("qa_id")["d"].tolist()
        rng = random.Random(seed)
        means = sorted(sum(d[rng.randrange(len(d))] for _ in d) / len(d) for _ in range(n))
        low, high = means[int(0.025 * n)], means[int(0.975 * n) - 1]
        return pd.DataFrame({group: [pdf[group].iloc[0]], "n_pairs": [len(d)], "delta": [sum(d) / len(d)], "low": [low], "high": [high], "significant": [low > 0 or high < 0]})

    return both.groupBy(group).applyInPandas(resample, f"{group} {both.schema[group].dataType.simpleString()}, n_pairs long, delta double, low double, high double, significant boolean")


def score_pairs(gold: DataFrame, candidates: DataFrame, *, by: tuple[str, ...] = ()) -> DataFrame:
    """N and the means of em and f1 to 4 places over gold records (qa_id, answer, category) that have a candidate
    (qa_id, answer), in all or by category; noughts without a pair."""
    said = candidates.select("qa_id", F.col("answer").alias("_said"))
    rows = gold.join(said, "qa_id").select("*", F.coalesce("_said", F.lit("")).alias("_p"), F.coalesce("answer", F.lit("")).alias("_g"))
    rows = rows.select(*[F.coalesce(F.col(c), F.lit("?")).alias(c) for c in by], exact_match(F.col("_p"), F.col("_g")).alias("_em"), char_f1(F.col("_p"), F.col("_g")).alias("_f1"))
    mean = lambda c: F.coalesce(F.round(F.avg(c), 4), F.lit(0.0))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), mean("_em").alias("em"), mean("_f1").alias("f1"))


def generate(rows: DataFrame, predict, *, output: str = "answer") -> DataFrame:
    """A model as a table function: predict(list of rows as dicts) -> texts, a batch at a time, one predict a task."""
    schema = rows.withColumn(output, F.lit(None).cast("string")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{output: predict(pdf.to_dict("records"))})

    return rows.mapInPandas(run, schema)


def prompt_key(prompt: Column) -> Column:
    """What a generation is recorded under."""
    return F.sha2(prompt, 256)


def judge_key(source: Column, question: Column, answer: Column) -> Column:
    """What a verdict is recorded under."""
    return F.sha1(F.concat(*[F.concat(F.coalesce(x, F.lit("")), F.lit("\0")) for x in (source, question, answer)]))


def replay(rows: DataFrame, recorded: DataFrame, *, key: str = "prompt_sha256", strict: bool = True) -> DataFrame:
    """Rows joined with what was recorded for their key. Nothing recorded is an error, or null if not strict."""
    if not strict:
        return rows.join(recorded, key, "left")
    met = rows.join(recorded.withColumn("_there", F.lit(True)), key, "left")
    miss = F.raise_error(F.concat(F.lit("nothing is recorded for "), F.substring(key, 1, 12)))
    return met.where(F.when(F.col("_there"), F.lit(True)).otherwise(miss.cast("boolean"))).drop("_there")
