"""Runs and their reports: documents of a batch, records of a benchmark, arms, processes, serving, settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartulary.operators.layout import manifest_counts
from cartulary.operators.report import nearest_rank


def latest_outputs(fresh: DataFrame, cached: DataFrame) -> DataFrame:
    """Rows of documents that were processed now, and the kept rows of all others, with cached."""
    rest = cached.join(fresh.select("document").distinct(), "document", "left_anti")
    return fresh.withColumn("cached", F.lit(False)).unionByName(rest.withColumn("cached", F.lit(True)), allowMissingColumns=True)


def batch_totals(documents: DataFrame, pairs: DataFrame, *, order: str, allow_partial: bool = False) -> DataFrame:
    """One row over a batch's documents (document, error: null if it succeeded): how many succeeded and failed, the
    failure rate, sums of the manifest counts of those that succeeded, and the status."""
    counts = manifest_counts(pairs, order=order, by=("document",))
    names = ("total", "text", "image", "figures")
    rows = documents.join(counts, "document", "left")
    ok = F.col("error").isNull()
    sums = [F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).alias("pairs" if c == "total" else c) for c in names]
    failed = F.count_if(~ok)
    status = F.when(failed == 0, "ok").otherwise("partial" if allow_partial else "failed")
    return rows.agg(F.count_if(ok).alias("documents"), failed.alias("failed"), F.coalesce(F.try_divide(failed, F.count("*")), F.lit(0.0)).alias("failure_rate"), *sums, status.alias("status"))


def resolve_file(files: DataFrame, name: str | None = None) -> DataFrame:
    """One row: the path of the named file, else the first by path; no row where there is none."""
    wanted = files.where(F.regexp_extract("path", r"([^/]*)$", 1) == name) if name else files
    return wanted.agg(F.min("path").alias("path")).where("path is not null")


def read_results(spark: SparkSession, path: str, *, schema: str, pattern: str = "eval_*.json", where: Column | None = None) -> DataFrame:
    """Rows of all result files of a folder (one JSON document each), those that fit a condition."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").option("pathGlobFilter", pattern).json(path)
    return rows.where(where) if where is not None else rows


def benchmark_records(sources: list[tuple[DataFrame, str, str]], fields: tuple[str, ...], *, set_id: str) -> DataFrame:
    """Records of several sources (rows, family, split) in a benchmark's columns; what a source lacks is null."""
    out = None
    for rows, family, split in sources:
        have = set(rows.columns)
        picked = rows.select(*[(F.col(c) if c in have else F.lit(None).cast("string")).alias(c) for c in fields], (F.coalesce("review_status", F.lit("owner_review_pending")) if "review_status" in have else F.lit("owner_review_pending")).alias("review_status"))
        picked = picked.withColumns({"document_family_id": F.lit(family), "split": F.lit(split), "benchmark_set_id": F.lit(set_id)})
        out = picked if out is None else out.unionByName(picked)
    return out.orderBy("qa_id")


def missing_settings(settings: DataFrame, values: DataFrame, provider: str) -> DataFrame:
    """Names of settings (name, aliases, required_for) that a provider needs and that have no filled value (name,
    value) under their name or an alias."""
    needed = settings.where(F.exists(F.coalesce("required_for", F.array().cast("array<string>")), lambda p: F.lower(p) == provider.strip().lower()))
    named = needed.select("name", F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("alias"))
    filled = values.where(F.coalesce("value", F.lit("")) != "").select(F.col("name").alias("alias")).distinct()
    return needed.select("name").join(named.join(filled, "alias").select("name").distinct(), "name", "left_anti")


def resolved(value, config: dict, name: str, default):
    """A given value, else the configuration's, else the default."""
    if value is not None:
        return value
    return default if config.get(name) is None else config[name]


def arm_summary(runs: DataFrame, metrics: tuple[str, ...], arms: tuple[str, ...]) -> DataFrame:
    """For each arm (also those without a run) and metric: status, mean and population deviation over seeds to 4
    places, and n. runs: (arm, seed, metrics)."""
    spark = runs.sparkSession
    every = spark.createDataFrame([(i, a) for i, a in enumerate(arms)], "pos int, arm string")
    long = runs.select("arm", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in metrics])).alias("m")).select("arm", "m.metric", "m.x")
    got = long.where(F.col("x").isNotNull()).groupBy("arm", "metric").agg(F.round(F.avg("x"), 4).alias("mean"), F.round(F.stddev_pop("x"), 4).alias("std"), F.count("*").alias("n"))
    names = every.select("*", F.explode(F.array(*[F.lit(m) for m in metrics])).alias("metric"))
    out = names.join(got, ["arm", "metric"], "left")
    return out.select("arm", "metric", F.when(F.col("n").isNull(), "not_measured").otherwise("measured").alias("status"), "mean", "std", F.coalesce("n", F.lit(0)).alias("n"))


def process_metrics(runs: DataFrame) -> DataFrame:
    """Runs (run, pages, elements, raw, accepted, passed, failed, elapsed in seconds) with rejected, qa_yield, rates a
    second and a minute and evidence_pass_rate; null is `not measured`."""
    rate = lambda a, b, places: F.round(F.try_divide(F.nullif(F.col(a).cast("double"), F.lit(0.0)), F.when(b > 0, b)), places)
    elapsed = F.col("elapsed").cast("double")
    return runs.withColumns(
        {
            "rejected": F.greatest(F.col("raw") - F.col("accepted"), F.lit(0)),
            "qa_yield": F.round(F.try_divide(F.col("accepted").cast("double"), F.col("raw")), 4),
            "pages_per_sec": rate("pages", elapsed, 4),
            "elements_per_sec": rate("elements", elapsed, 4),
            "accepted_per_min": rate("accepted", elapsed / 60.0, 2),
            "evidence_pass_rate": F.round(F.try_divide(F.col("passed").cast("double"), F.col("passed") + F.col("failed")), 4),
        }
    )


def reject_reasons(failures: DataFrame) -> DataFrame:
    """(reason, n) of what was dropped, noughts left out."""
    return failures.groupBy("reason").agg(F.sum("n").alias("n")).where("n > 0")


def perplexity(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Exp of the summed negative log-likelihood (natural) over the summed tokens; NaN without tokens."""
    n = F.sum("tokens")
    return scored.groupBy(*by).agg(F.when(n > 0, F.exp(F.sum("nll") / n)).otherwise(F.lit(float("nan"))).alias("perplexity"), F.coalesce(n, F.lit(0)).alias("tokens"))


def rank_candidates(rows: DataFrame, metric: str, *, id_col: str = "candidate", k: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Candidates by a metric, greatest first, ties by id as text; all of them, or the first k (of each group). With a
    k, tasks keep their own k first, so a group is never gathered."""
    order = [F.desc(F.col(metric).cast("double")), F.col(id_col).cast("string")]
    if k is None and not by:
        return rows.orderBy(*order)
    window = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    ranked = rows.withColumn("rank", F.row_number().over(window.orderBy(*order)))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def throughput_ratios(sweeps: DataFrame, latency: DataFrame, memory: DataFrame) -> DataFrame:
    """One row of ratios between the arms a and b. sweeps: (arm, batch, tok_per_s); latency: (arm, ttft, e2e);
    memory: (arm, gib)."""
    speed = sweeps.groupBy("batch").agg(F.max(F.when(F.col("arm") == "a", F.col("tok_per_s"))).alias("a"), F.max(F.when(F.col("arm") == "b", F.col("tok_per_s"))).alias("b"))
    most = F.max(F.when(F.col("a").isNotNull(), F.struct("batch", "a", "b")))
    at_one = lambda c: F.max(F.when(F.col("batch") == 1, F.col(c)))
    sweep = speed.agg(
        F.round(F.try_divide(at_one("b"), at_one("a")), 3).alias("single_stream_b_vs_a"),
        F.round(F.try_divide(most["a"], most["b"]), 3).alias("batched_a_vs_b"),
        F.min(F.when(F.col("a") > F.col("b"), F.col("batch"))).alias("crossover_batch"),
    )
    side = lambda d, c, arm: F.max(F.when(F.col("arm") == arm, F.col(c)))
    lat = latency.agg(F.round(F.try_divide(side(latency, "e2e", "a"), side(latency, "e2e", "b")), 3).alias("e2e_b_faster_x"), F.round(F.try_divide(side(latency, "ttft", "b"), side(latency, "ttft", "a")), 3).alias("ttft_a_faster_x"))
    mem = memory.agg(F.round(F.try_divide(side(memory, "gib", "a"), side(memory, "gib", "b")), 1).alias("memory_saving_x"))
    return sweep.crossJoin(F.broadcast(lat)).crossJoin(F.broadcast(mem))  # one row each


def serving_percentiles(requests: DataFrame, columns: tuple[str, ...] = ("ttft", "tpot", "e2e"), *, by: tuple[str, ...] = ()) -> DataFrame:
    """(groups, metric, n, p50, p95, p99) of each column over completed requests, and of the values in `itl`, an array,
    if there is one; nearest rank, to 4 places."""
    done = requests.where("ok")
    values = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("x")) for c in columns]
    flat = F.array(*values)
    if "itl" in requests.columns:
        flat = F.concat(flat, F.transform(F.coalesce("itl", F.array().cast("array<double>")), lambda x: F.struct(F.lit("itl").alias("metric"), x.cast("double").alias("x"))))
    long = done.select(*by, F.explode(flat).alias("m")).select(*by, "m.metric", "m.x")
    got = nearest_rank(long, "x", (0.5, 0.95, 0.99), by=(*by, "metric"))
    return got.withColumns({c: F.round(c, 4) for c in ("p50", "p95", "p99")})


def model_card(summary: dict, *, name: str, base_model: str, arm: str) -> str:
    """K9: a model's card as text: its base, and its arm's metrics, of which what wasn't measured says so."""
    metrics = summary.get("arms", {}).get(arm, {}).get("metrics", {})
    shown = lambda m: f"{m['mean']} ± {m['std']} (n={m['n']})" if isinstance(m, dict) and m.get("n") else "not measured"
    return "\n".join(["---", f"base_model: {base_model}", "---", "", f"# {name}", "", f"Arm: {arm}.", "", "| metric | value |", "|---|---|", *[f"| {k} | {shown(v)} |" for k, v in sorted(metrics.items())], ""])


def report_markdown(table: DataFrame, title: str, *, limit: int = 200) -> str:
    """K8: a small table as a Markdown report; a report shows `limit` rows at most and says how many there are."""
    rows = table.limit(limit + 1).collect()
    head = table.columns
    cell = lambda v: "–" if v is None else f"{v:.4f}".rstrip("0").rstrip(".") if isinstance(v, float) else str(v).replace("|", "\\|")
    lines = [f"# {title}", "", "| " + " | ".join(head) + " |", "|" + "---|" * len(head), *["| " + " | ".join(cell(r[c]) for c in head) + " |" for r in rows[:limit]]]
    return "\n".join([*lines, *(["", f"First {limit} rows."] if len(rows) > limit else []), ""])
