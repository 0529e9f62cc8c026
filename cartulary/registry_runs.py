"""Registered queries of provenance, figures, failures, runs, prompts, trust and settings, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartulary.functions import numbers, text
from cartulary.operators import audit, evidence, failures, layout, metrics, prompts, provenance, report, review, runs, training, trust
from cartulary.registry import registered, sql_collapse, sql_norm_answer, table

# Pairs of a run: a supplier is a document, every other line a figure's.
PAIRS = """SELECT l_suppkey AS document, l_orderkey * 10 + l_linenumber AS pos, CASE WHEN l_linenumber % 2 = 0 THEN 'image' ELSE 'text' END AS source,
    CASE WHEN l_partkey % 5 <> 0 THEN l_partkey % 7 END AS figure_index, 'img/' || l_partkey % 3 || '.png' AS image_path, l_linenumber AS page, l_linestatus AS section, l_returnflag = 'R' AS context_used FROM lineitem"""


def _run_pairs(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("document"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        F.when(F.col("l_linenumber") % 2 == 0, "image").otherwise("text").alias("source"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_partkey") % 7).alias("figure_index"),
        F.concat(F.lit("img/"), F.col("l_partkey") % 3, F.lit(".png")).alias("image_path"),
        F.col("l_linenumber").alias("page"),
        F.col("l_linestatus").alias("section"),
        (F.col("l_returnflag") == "R").alias("context_used"),
    )


FIGURES = f"""WITH p AS ({PAIRS}), g AS (SELECT document, coalesce(figure_index::VARCHAR, 'path ' || image_path) AS figure, arg_min_null(figure_index, pos) AS figure_index, arg_min_null(page, pos) AS page,
    arg_min_null(section, pos) AS section, regexp_extract(arg_min_null(image_path, pos), '([^/]*)$', 1) AS image_path, bool_or(context_used) AS context_used, count(*) AS questions FROM p WHERE source = 'image' GROUP BY ALL)"""


@registered(FIGURES + " SELECT * FROM g")
def figure_linkage(spark, sf_dir):
    return layout.figure_linkage(_run_pairs(spark, sf_dir), order="pos", by=("document",))


MANIFEST = FIGURES + """, c AS (SELECT document, count(*) AS total, count(*) FILTER (source <> 'image') AS text, count(*) FILTER (source = 'image') AS image FROM p GROUP BY 1),
    f AS (SELECT document, count(*) AS figures, count(*) FILTER (context_used) AS figures_with_context FROM g GROUP BY 1),
    m AS (SELECT document, total, text, image, coalesce(figures, 0) AS figures, coalesce(figures_with_context, 0) AS figures_with_context FROM c LEFT JOIN f USING (document))"""


@registered(MANIFEST + " SELECT * FROM m")
def manifest_counts(spark, sf_dir):
    return layout.manifest_counts(_run_pairs(spark, sf_dir), order="pos", by=("document",))


@registered(
    MANIFEST
    + """, d AS (SELECT s_suppkey AS document, CASE WHEN s_acctbal < 0 THEN 'no text layer' END AS error FROM supplier)
    SELECT count(*) FILTER (error IS NULL) AS documents, count(error) AS failed, count(error)::DOUBLE / count(*) AS failure_rate, coalesce(sum(total) FILTER (error IS NULL), 0)::BIGINT AS pairs,
    coalesce(sum(text) FILTER (error IS NULL), 0)::BIGINT AS text, coalesce(sum(image) FILTER (error IS NULL), 0)::BIGINT AS image, coalesce(sum(figures) FILTER (error IS NULL), 0)::BIGINT AS figures,
    CASE WHEN count(error) = 0 THEN 'ok' ELSE 'failed' END AS status FROM d LEFT JOIN m USING (document)"""
)
def batch_totals(spark, sf_dir):
    documents = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("document"), F.when(F.col("s_acctbal") < 0, "no text layer").alias("error"))
    return runs.batch_totals(documents, _run_pairs(spark, sf_dir), order="pos")


@registered("SELECT doc_id AS document, length(text) AS size, doc_id % 3 <> 0 AS cached FROM documents")
def cached_outputs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document"), F.length("text").cast("long").alias("size"))
    return runs.latest_outputs(docs.where("document % 3 = 0"), docs)


MODALITY = "CASE l_linenumber % 4 WHEN 0 THEN 'figure' WHEN 1 THEN 'table' WHEN 2 THEN 'text' END"


def _modal(spark, sf_dir):
    k = F.col("l_linenumber") % 4
    return table(spark, sf_dir, "lineitem").select(
        "l_linestatus",
        F.when(k == 0, "figure").when(k == 1, "table").when(k == 2, "text").alias("modality"),
        F.when(F.col("l_quantity") > 25, "below").alias("caption"),
        F.lit(None).cast("string").alias("section_path"),
        F.when(F.col("l_discount") > 0.08, "near").alias("context"),
    )


@registered(f"SELECT l_linestatus, count(*) FILTER (m = 'text') AS text, count(*) FILTER (m = 'table') AS \"table\", count(*) FILTER (m = 'figure') AS figure, count(*) AS total FROM (SELECT l_linestatus, {MODALITY} AS m FROM lineitem) GROUP BY ALL")
def modality_counts(spark, sf_dir):
    return layout.modality_counts(_modal(spark, sf_dir), by=("l_linestatus",))


@registered(f"SELECT l_linestatus, count(*) AS figures, round(avg((l_quantity > 25 OR l_discount > 0.08)::INT), 4) AS linkage_rate FROM lineitem WHERE {MODALITY} = 'figure' GROUP BY ALL")
def caption_linkage(spark, sf_dir):
    return layout.caption_linkage(_modal(spark, sf_dir), by=("l_linestatus",))


# Blocks: a document's lines, twenty to a page, in three columns.
SQL_HEADING = "regexp_matches(trim(raw), '^(?:(?:제?\\s*\\d+[\\.\\)]|[0-9]+\\.)|[가-힣A-Za-z]{1,20}\\s*$)') AND length(trim(raw)) <= 40"
BLOCKS = "SELECT doc_id, k // 20 + 1 AS page, raw, ((k % 20) // 3 * 10)::DOUBLE AS y0, (k % 3 * 100)::DOUBLE AS x0 FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(0, len(string_split(text, chr(10))))) AS k FROM (SELECT DISTINCT doc_id, text FROM documents))"
ELEMENTS = f"""WITH b AS ({BLOCKS}), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY y0, x0) - 1 AS i, {sql_collapse('raw')} AS text FROM b WHERE trim(raw) <> ''),
    e AS (SELECT doc_id, page, 'p' || page || '-b' || i AS element_id, text, last_value(CASE WHEN {SQL_HEADING} THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id, page ORDER BY i) AS section_path FROM n)"""


def _blocks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").distinct()
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "raw"))
    return lines.select(
        F.col("doc_id").cast("string").alias("document_sha256"),
        (F.floor(F.col("at") / 20) + 1).cast("int").alias("page"),
        (F.col("at") % 3 * 100.0).alias("x0"),
        (F.floor(F.col("at") % 20 / 3) * 10.0).alias("y0"),
        F.lit(0.0).alias("x1"),
        F.lit(0.0).alias("y1"),
        "raw",
    )


@registered(ELEMENTS + " SELECT doc_id::VARCHAR AS document_sha256, page, element_id, sha256(text) AS text_sha256, section_path FROM e")
def block_elements(spark, sf_dir):
    got = provenance.block_elements(_blocks(spark, sf_dir))
    return got.select("document_sha256", "page", "element_id", F.sha2("text", 256).alias("text_sha256"), "section_path")


@registered(ELEMENTS + " SELECT doc_id::VARCHAR AS qa_id, page, element_id, sha256(trim(left(text, 40))) AS quote_sha256, section_path FROM e")
def evidence_items(spark, sf_dir):
    elements = provenance.block_elements(_blocks(spark, sf_dir))
    quotes = elements.select(F.col("document_sha256").alias("qa_id"), "document_sha256", F.lit("v1").alias("document_version"), "element_id", F.left("text", F.lit(40)).alias("quote"))
    return provenance.build_evidence(elements, quotes).select("qa_id", "page", "element_id", "quote_sha256", "section_path")


@registered(
    """SELECT o_orderkey, CASE WHEN s = 'auto' AND (m OR g) THEN 'hi_res' ELSE s END AS effective_strategy, m OR g AS infer_table_structure, g AS gpu_accelerated
    FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'auto' WHEN 'F' THEN 'fast' ELSE 'hi_res' END AS s, o_orderkey % 3 = 0 AS m, o_custkey % 2 = 0 AND o_orderkey % 5 <> 0 AS g FROM orders)"""
)
def extraction_plan(spark, sf_dir):
    status = F.col("o_orderstatus")
    configs = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "O", "auto").when(status == "F", "fast").otherwise("hi_res").alias("strategy"),
        F.when(F.col("o_orderkey") % 3 == 0, "yolox").otherwise("").alias("hi_res_model_name"),
        (F.col("o_orderkey") % 5 != 0).alias("gpu_boost"),
        (F.col("o_custkey") % 2 == 0).alias("gpu_ready"),
    )
    return provenance.extraction_plan(configs).select("o_orderkey", "effective_strategy", "infer_table_structure", "gpu_accelerated")


@registered("SELECT l_orderkey, min(l_quantity)::DOUBLE AS x0, min(l_discount)::DOUBLE AS y0, max(l_quantity)::DOUBLE AS x1, max(l_discount)::DOUBLE AS y1 FROM lineitem GROUP BY 1")
def bbox_envelopes(spark, sf_dir):
    points = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.array(F.col("l_quantity").cast("double"), F.col("l_discount").cast("double"))).alias("p"))
    return points.select("l_orderkey", provenance.bbox_envelope(F.col("p")).alias("b")).select("l_orderkey", "b.*")


@registered(
    """SELECT item_id, concat_ws(chr(10) || chr(10), CASE WHEN item_id % 3 <> 0 THEN '[Section] s' || item_id END, CASE WHEN item_id % 2 = 0 THEN '[Context before the figure]' || chr(10) || left(text, 30) END,
    '[Caption / context after the figure]' || chr(10) || right(text, 30)) AS context FROM benchmark"""
)
def figure_contexts(spark, sf_dir):
    i = F.col("item_id")
    section, before = F.when(i % 3 != 0, F.concat(F.lit("s"), i)).otherwise(""), F.when(i % 2 == 0, F.left("text", F.lit(30)))
    return table(spark, sf_dir, "benchmark").select("item_id", layout.assemble_context(section, before, F.right("text", F.lit(30))).alias("context"))


FAILING = """SELECT doc_id::VARCHAR AS qa_id, list_filter([CASE WHEN length(text) < 300 THEN 'short' END, CASE WHEN contains(text, '#') THEN 'marks' END], lambda x: x IS NOT NULL) AS categories, text FROM documents"""


def _failing(spark, sf_dir):
    e = F.struct(F.sha2("text", 256).alias("document_sha256"), F.lit("v1").alias("document_version"), F.lit(1).alias("page"), F.lit("p1-b0").alias("element_id"), F.lit("q").alias("quote"), F.sha2(F.lit("q"), 256).alias("quote_sha256"))
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("qa_id"), "text", F.lit("what").alias("question"), F.lit(True).alias("answerable"), F.lit("c").alias("category"), F.array(e).alias("evidence"))
    kinds = F.array_compact(F.array(F.when(F.length("text") < 300, "short"), F.when(F.contains("text", F.lit("#")), "marks")))
    mined = failures.mine_failures(rows, rows.select("qa_id", kinds.alias("categories")), dev_ids=rows.select("qa_id").distinct(), final_ids=rows.select("qa_id").where("qa_id = '-1'"))
    answers = mined.select("qa_id", F.concat(F.lit("fixed "), "qa_id").alias("corrected_answer"), F.lit("r1").alias("reviewer")).where("qa_id % 2 = 0").distinct()
    return failures.build_corrections(mined, answers, final_ids=rows.select("qa_id").where("qa_id = '-1'"))


@registered(f"WITH f AS ({FAILING}) SELECT 'corr-' || qa_id AS qa_id, 'fixed ' || qa_id AS answer, qa_id AS dev_qa_id, array_to_string(categories, ',') AS categories, sha256(text) AS cited FROM f WHERE len(categories) > 0 AND qa_id::INT % 2 = 0")
def failure_corrections(spark, sf_dir):
    got = _failing(spark, sf_dir)
    return got.select("qa_id", "answer", "derived_from.dev_qa_id", F.array_join("derived_from.error_categories", ",").alias("categories"), F.col("derived_from.evidence")[0]["document_sha256"].alias("cited"))


@registered(f"WITH f AS ({FAILING}), l AS (SELECT 'corr-' || qa_id || '<-' || qa_id AS line FROM f WHERE len(categories) > 0 AND qa_id::INT % 2 = 0) SELECT 'ds-' || left(sha256('base' || coalesce(string_agg(chr(0) || line, '' ORDER BY line), '')), 12) AS dataset_version, 'base' AS base_version, count(*) AS n_rows FROM l")
def corrected_version(spark, sf_dir):
    corrections = _failing(spark, sf_dir)
    return failures.corrected_version(corrections, base_version="base", final_ids=corrections.select("qa_id").where("qa_id = '-1'"))


FIELDS = ("qa_id", "question", "category", "answer")


@registered(
    """SELECT doc_id AS qa_id, 'what' AS question, NULL::VARCHAR AS category, source AS answer, CASE WHEN lang = 'en' THEN 'approved' ELSE 'owner_review_pending' END AS review_status, lang AS document_family_id,
    CASE WHEN lang = 'en' THEN 'dev' ELSE 'train' END AS split, 'set/v1' AS benchmark_set_id FROM documents WHERE lang IN ('en', 'de')"""
)
def benchmark_records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", F.col("doc_id").alias("qa_id"), F.lit("what").alias("question"), F.col("source").alias("answer"))
    sources = [(docs.where("lang = 'en'").withColumn("review_status", F.lit("approved")), "en", "dev"), (docs.where("lang = 'de'"), "de", "train")]
    return runs.benchmark_records(sources, FIELDS, set_id="set/v1")


@registered("SELECT source AS category, count(*) AS n FROM documents GROUP BY 1")
def category_counts(spark, sf_dir):
    return audit.category_counts(table(spark, sf_dir, "documents").withColumnRenamed("source", "category"))


@registered("SELECT 'p' || l_partkey AS document_family_id, array_to_string(list_sort(list(DISTINCT 'v' || l_linenumber)), ',') AS versions FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_linenumber) > 1")
def family_versions(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("document_family_id"), F.concat(F.lit("v"), "l_linenumber").alias("document_version"))
    return audit.family_versions(rows).select("document_family_id", F.array_join("versions", ",").alias("versions"))


ARMS = ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "none such")


@registered(
    f"""WITH a AS (SELECT unnest({list(ARMS)}) AS arm), m AS (SELECT c_mktsegment AS arm, 'balance' AS metric, c_acctbal AS x FROM customer WHERE c_custkey % 4 = 1 UNION ALL SELECT c_mktsegment, 'rich', (c_acctbal > 5000)::INT FROM customer WHERE c_custkey % 4 = 1),
    g AS (SELECT arm, metric, round(avg(x), 4) AS mean, round(stddev_pop(x), 4) AS std, count(x) AS n FROM m GROUP BY ALL)
    SELECT a.arm, k.metric, CASE WHEN n IS NULL THEN 'not_measured' ELSE 'measured' END AS status, mean, std, coalesce(n, 0) AS n FROM a CROSS JOIN (SELECT unnest(['balance', 'rich']) AS metric) k LEFT JOIN g ON g.arm = a.arm AND g.metric = k.metric"""
)
def arm_summary(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_custkey % 4 = 1").select(F.col("c_mktsegment").alias("arm"), F.col("c_acctbal").alias("balance"), (F.col("c_acctbal") > 5000).cast("int").alias("rich"))
    return runs.arm_summary(c, ("balance", "rich"), ARMS)


PROCESS = "SELECT o_custkey AS run, count(*) AS pages, sum(o_orderkey % 50) AS elements, count(*) + 2 AS raw, count(*) FILTER (o_orderstatus = 'F') AS accepted, count(*) FILTER (o_orderstatus = 'O') AS passed, count(*) FILTER (o_orderstatus = 'P') AS failed, (o_custkey % 7)::DOUBLE AS elapsed FROM orders GROUP BY o_custkey"


@registered(
    f"""WITH r AS ({PROCESS}) SELECT run, greatest(raw - accepted, 0) AS rejected, round(accepted::DOUBLE / raw, 4) AS qa_yield, CASE WHEN elapsed > 0 THEN round(nullif(pages, 0) / elapsed, 4) END AS pages_per_sec,
    CASE WHEN elapsed > 0 THEN round(nullif(elements, 0) / elapsed, 4) END AS elements_per_sec, CASE WHEN elapsed > 0 THEN round(nullif(accepted, 0) / (elapsed / 60), 2) END AS accepted_per_min,
    CASE WHEN passed + failed > 0 THEN round(passed::DOUBLE / (passed + failed), 4) END AS evidence_pass_rate FROM r"""
)
def process_metrics(spark, sf_dir):
    status = F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("run")).agg(
        F.count("*").alias("pages"), F.sum(F.col("o_orderkey") % 50).alias("elements"), (F.count("*") + 2).alias("raw"), F.count_if(status == "F").alias("accepted"), F.count_if(status == "O").alias("passed"), F.count_if(status == "P").alias("failed")
    )
    got = runs.process_metrics(rows.withColumn("elapsed", (F.col("run") % 7).cast("double")))
    return got.select("run", "rejected", "qa_yield", "pages_per_sec", "elements_per_sec", "accepted_per_min", "evidence_pass_rate")


@registered("SELECT o_orderstatus AS reason, count(*)::BIGINT AS n FROM orders GROUP BY 1")
def reject_reasons(spark, sf_dir):
    got = runs.reject_reasons(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("reason"), F.lit(1).alias("n")))
    return got.select("reason", F.col("n").cast("long").alias("n"))


@registered("SELECT l_returnflag, round(exp(sum(l_extendedprice / 1e5) / sum(l_quantity)), 9) AS perplexity, sum(l_quantity)::DOUBLE AS tokens FROM lineitem GROUP BY 1")
def perplexity(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_extendedprice") / 1e5).alias("nll"), F.col("l_quantity").cast("double").alias("tokens"))
    return runs.perplexity(rows, by=("l_returnflag",)).withColumn("perplexity", F.round("perplexity", 9))


@registered("SELECT s_nationkey, s_suppkey, s_acctbal FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey::VARCHAR) <= 3")
def top_k_per_group(spark, sf_dir):
    return runs.rank_candidates(table(spark, sf_dir, "supplier"), "s_acctbal", id_col="s_suppkey", k=3, by=("s_nationkey",)).select("s_nationkey", "s_suppkey", "s_acctbal")


@registered(
    """WITH s AS (SELECT p_size AS batch, max(p_retailprice) FILTER (p_partkey % 2 = 0) AS a, max(p_retailprice) FILTER (p_partkey % 2 = 1) AS b FROM part GROUP BY 1),
    n AS (SELECT avg(s_acctbal) FILTER (s_suppkey % 2 = 0) AS ta, avg(s_acctbal) FILTER (s_suppkey % 2 = 1) AS tb, max(s_acctbal) FILTER (s_suppkey % 2 = 0) AS ea, max(s_acctbal) FILTER (s_suppkey % 2 = 1) AS eb FROM supplier)
    SELECT round(max(b) FILTER (batch = 1) / max(a) FILTER (batch = 1), 3) AS single_stream_b_vs_a, round(arg_max(a, batch) / arg_max(b, batch) FILTER (a IS NOT NULL), 3) AS batched_a_vs_b, min(batch) FILTER (a > b) AS crossover_batch,
    round(any_value(ea) / any_value(eb), 3) AS e2e_b_faster_x, round(any_value(tb) / any_value(ta), 3) AS ttft_a_faster_x, round(any_value(ea) / any_value(eb), 1) AS memory_saving_x FROM s, n"""
)
def throughput_ratios(spark, sf_dir):
    arm = lambda c: F.when(F.col(c) % 2 == 0, "a").otherwise("b").alias("arm")
    sweeps = table(spark, sf_dir, "part").groupBy(arm("p_partkey"), F.col("p_size").alias("batch")).agg(F.max("p_retailprice").alias("tok_per_s"))
    latency = table(spark, sf_dir, "supplier").groupBy(arm("s_suppkey")).agg(F.avg("s_acctbal").alias("ttft"), F.max("s_acctbal").alias("e2e"))
    return runs.throughput_ratios(sweeps, latency, latency.select("arm", F.col("e2e").alias("gib")))


@registered(
    """WITH v AS (SELECT event_type, unnest(['ttft', 'e2e', 'itl', 'itl']) AS metric, unnest([value, value * 2, event_id % 10, user_id % 10]::DOUBLE[]) AS x FROM events WHERE value > 5),
    r AS (SELECT *, row_number() OVER (PARTITION BY event_type, metric ORDER BY x) AS r, count(*) OVER (PARTITION BY event_type, metric) AS n FROM v)
    SELECT event_type, metric, n, round(max(x) FILTER (r = round_even(0.5 * (n - 1), 0)::BIGINT + 1), 4) AS p50, round(max(x) FILTER (r = round_even(0.95 * (n - 1), 0)::BIGINT + 1), 4) AS p95, round(max(x) FILTER (r = round_even(0.99 * (n - 1), 0)::BIGINT + 1), 4) AS p99 FROM r GROUP BY ALL"""
)
def serving_percentiles(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", (F.col("value") > 5).alias("ok"), F.col("value").alias("ttft"), (F.col("value") * 2).alias("e2e"), F.array((F.col("event_id") % 10).cast("double"), (F.col("user_id") % 10).cast("double")).alias("itl"))
    return runs.serving_percentiles(e, ("ttft", "e2e"), by=("event_type",))


@registered("SELECT doc_id, CASE lower(lang) " + " ".join(f"WHEN '{a}' THEN '{name}'" for name, aliases in prompts.LANGUAGES.items() for a in aliases) + " ELSE lang END AS language FROM documents")
def language_names(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", prompts.resolve_language(F.col("lang")).alias("language"))


TEMPLATE = "{persona_role} writes {num_questions} for {artifact} ({persona_label}): {persona_method} in {language_directive}. {context}"
PERSONAS = {k: {"label": k.title(), "text_role": k + " of {domain}", "artifact": "quiz", "method": "asks on {domain}", "image_role": "r", "image_method": "m"} for k in ("teacher", "critic")}


@registered(
    """WITH p AS (SELECT item_id, text, 'd' || item_id % 3 AS domain, CASE WHEN item_id % 2 = 0 THEN 'teacher' ELSE 'critic' END AS persona, CASE WHEN item_id % 3 = 0 THEN 'Korean' ELSE 'Portuguese' END AS lang FROM benchmark)
    SELECT item_id, persona || ' of ' || domain || ' writes 5 for quiz (' || CASE persona WHEN 'teacher' THEN 'Teacher' ELSE 'Critic' END || '): asks on ' || domain || ' in ' || lang || '. ' || text AS prompt FROM p"""
)
def text_prompts(spark, sf_dir):
    i = F.col("item_id")
    persona = F.when(i % 2 == 0, "teacher").otherwise(F.lit(None).cast("string"))
    field = lambda f: prompts.persona_of(persona, PERSONAS, "critic", f)
    made = prompts.text_prompt(TEMPLATE, context=F.col("text"), domain=F.concat(F.lit("d"), i % 3), num_questions=F.lit("5"), role=field("text_role"), artifact=field("artifact"), label=field("label"), method=field("method"), language=F.when(i % 3 == 0, "KO").otherwise(" Portuguese "))
    return table(spark, sf_dir, "benchmark").select("item_id", made.alias("prompt"))


@registered("SELECT item_id, 'Below: ' || text || chr(10) || 'In: ' || chr(10) || 'Out: ' || item_id || '</s>' AS prompt FROM benchmark")
def instruction_prompts(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", prompts.instruction_prompt("Below: %s\nIn: %s\nOut: %s", F.col("text"), F.lit(None).cast("string"), F.col("item_id").cast("string"), end="</s>").alias("prompt"))


def _trust_sql(kind: str) -> str:
    pattern, but = trust.PATTERNS[kind]
    quoted = pattern.replace("'", "''")
    found = f"regexp_extract_all(l, '{quoted}', 1)"
    return f"SELECT doc_id, line, '{kind}' AS kind, unnest(" + (f"list_filter({found}, lambda x: NOT regexp_matches(x, '{but}'))" if but else found) + ") AS value FROM s"


@registered("WITH s AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line FROM (SELECT doc_id, replace(text, 'example.', 'sample.') AS text FROM documents)) " + " UNION ALL ".join(_trust_sql(k) for k in trust.PATTERNS))
def trust_findings(spark, sf_dir):
    # Made-up addresses are of example domains, which the scan leaves alone; here they are of another.
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.replace("text", F.lit("example."), F.lit("sample.")).alias("text"))
    return trust.scan_lines(files).withColumnRenamed("path", "doc_id")


@registered("SELECT doc_id::VARCHAR AS qa_id, NULL::VARCHAR AS quote, sha256(text) AS quote_sha256, true AS quote_redacted, true AS source_redacted FROM documents")
def redacted_evidence(spark, sf_dir):
    e = F.struct(F.col("text").alias("quote"), F.sha2("text", 256).alias("quote_sha256"))
    records = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("qa_id"), F.array(e).alias("evidence"))
    return review.redact_for_report(records).select("qa_id", F.col("evidence")[0].alias("e"), "source_redacted").select("qa_id", "e.quote", "e.quote_sha256", "e.quote_redacted", "source_redacted")


@registered("SELECT n_name AS name FROM nation WHERE n_regionkey = 1 AND n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000) AND n_nationkey + 1 NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000)")
def missing_settings(spark, sf_dir):
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    other = n.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("alias"))
    settings = n.join(other, F.col("k") == F.col("n_nationkey") + 1, "left").select(F.col("n_name").alias("name"), F.array_compact(F.array("alias")).alias("aliases"), F.array(F.concat(F.lit("Region"), "n_regionkey")).alias("required_for"))
    values = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("name"), F.when(F.col("s_acctbal") > 8000, "x").otherwise("").alias("value"))
    return runs.missing_settings(settings, values, "region1")


@registered("""SELECT sha256('[' || string_agg('{"path":"d/' || doc_id || '","sha256":"' || sha256(text) || '"}', ',' ORDER BY '{"path":"d/' || doc_id || '","sha256":"' || sha256(text) || '"}') || ']') AS artifact_set_sha256, count(*) AS n FROM documents""")
def artifact_set(spark, sf_dir):
    return audit.artifact_set_hash(table(spark, sf_dir, "documents").select(F.concat(F.lit("d/"), "doc_id").alias("path"), F.sha2("text", 256).alias("sha256")))


@registered("SELECT avg(n_chars)::DOUBLE AS mean, min(n_chars) AS least, max(n_chars) AS most, count(*) AS n FROM documents")
def length_stats(spark, sf_dir):
    return report.length_stats(table(spark, sf_dir, "documents"), "n_chars")


@registered("SELECT doc_id AS qa_id, source AS category, 'be exact' AS system, CASE WHEN doc_id % 4 = 0 THEN 'what' ELSE 'what' || chr(10) || chr(10) || '[근거]' || chr(10) || text || ' ' || lang END AS asked, 'a' || doc_id AS said FROM documents")
def sft_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("qa_id"), F.col("source").alias("category"), F.lit("what").alias("question"), F.concat(F.lit("a"), "doc_id").alias("answer"), (F.col("doc_id") % 4 != 0).alias("answerable"), F.array(F.struct(F.col("text").alias("quote")), F.struct(F.col("lang").alias("quote"))).alias("evidence"))
    m = F.col("messages")
    return training.sft_rows(docs, system="be exact").select("qa_id", "category", m[0]["content"].alias("system"), m[1]["content"].alias("asked"), m[2]["content"].alias("said"))


GOLD = "SELECT item_id, 'c' || item_id % 3 AS category, text AS gold, CASE WHEN item_id % 5 = 0 THEN upper(text) ELSE left(text, (length(text) // 3)::INT) END AS answer FROM benchmark WHERE item_id % 7 <> 2"


@registered(
    f"""WITH b AS ({GOLD}), a AS (SELECT item_id, category, replace({sql_norm_answer('gold')}, ' ', '') AS g, replace({sql_norm_answer('answer')}, ' ', '') AS p, {sql_norm_answer('gold')} = {sql_norm_answer('answer')} AS same FROM b),
    g AS (SELECT item_id, c, count(*) AS n FROM (SELECT item_id, unnest(string_split(g, '')) AS c FROM a) GROUP BY ALL), p AS (SELECT item_id, c, count(*) AS n FROM (SELECT item_id, unnest(string_split(p, '')) AS c FROM a) GROUP BY ALL),
    k AS (SELECT item_id, sum(least(g.n, p.n)) AS n FROM g JOIN p USING (item_id, c) GROUP BY ALL),
    f AS (SELECT category, same::INT AS em, coalesce(2 * (n / length(p)) * (n / length(g)) / (n / length(p) + n / length(g)), 0) AS f1 FROM a LEFT JOIN k USING (item_id))
    SELECT category, count(*) AS n, round(avg(em), 4) AS em, round(avg(f1), 4) AS f1 FROM f GROUP BY 1"""
)
def pair_scores(spark, sf_dir):
    i = F.col("item_id")
    items = table(spark, sf_dir, "benchmark").select(i.alias("qa_id"), F.concat(F.lit("c"), i % 3).alias("category"), F.col("text").alias("answer"))
    said = items.where("qa_id % 7 <> 2").select("qa_id", F.when(F.col("qa_id") % 5 == 0, F.upper("answer")).otherwise(F.left("answer", F.floor(F.length("answer") / 3).cast("int"))).alias("answer"))
    return metrics.score_pairs(items, said, by=("category",))


@registered("SELECT doc_id AS qa_id FROM documents WHERE length(text) % 2 = 0")
def verified_only(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("qa_id"), (F.length("text") % 2 == 0).alias("ok"))
    return evidence.verified_only(docs.select("qa_id"), docs)


# Texts with compatibility characters, and what they are in N2 (fixed values).
COMPATIBLE = (("ﬁne １２３", "fine 123"), ("ｶﾞ㌔", "ガキロ"), ("x²  ½", "x2 1⁄2"), ("Ａ　Ｂ", "A B"), ("…", "..."), ("각", "각"))


@registered("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{b}', sha256('{b}'))" for i, (_, b) in enumerate(COMPATIBLE)) + ") AS t(i, composed, quote_sha256)")
def composed_texts(spark, sf_dir):
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(COMPATIBLE)], "i int, x string")
    return rows.select("i", text.norm_quote(F.col("x")).alias("composed"), text.quote_sha256(F.col("x")).alias("quote_sha256"))


NOISY = r"text <> '' AND (regexp_matches(text, '[\x{FFFD}\x{25A0}-\x{25FF}\x{2400}-\x{243F}]|[|]{2,}|_{3,}') OR (length(text) >= 8 AND length(regexp_replace(text, '[\p{L}\p{N}\s.,%()\-]', '', 'g'))::DOUBLE / length(text) > 0.4))"


@registered(f"SELECT doc_id, CASE WHEN length(t) <= 80 THEN t ELSE regexp_replace(left(t, 80), '\\s+$', '') || ' …' END AS clipped, {NOISY} AS noisy FROM (SELECT doc_id, text, regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') AS t FROM documents)")
def document_scalars(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clip(F.col("text"), 80).alias("clipped"), text.looks_ocr_noisy(F.col("text")).alias("noisy"))


@registered(
    """SELECT o_orderkey, o_orderkey % 40 / 2.0 AS version, CASE o_orderkey % 3 WHEN 0 THEN date_trunc('year', o_orderdate)::DATE WHEN 1 THEN date_trunc('month', o_orderdate)::DATE ELSE o_orderdate::DATE END AS day FROM orders"""
)
def order_versions_and_dates(spark, sf_dir):
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    said = F.when(k % 3 == 0, F.date_format(day, "yyyy")).when(k % 3 == 1, F.date_format(day, "yyyy-M")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", numbers.version_number(F.concat(F.lit("v"), (k % 40 / 2.0).cast("string"))).alias("version"), numbers.partial_date(said).alias("day"))


@registered("SELECT o_orderkey, list_sort([o_custkey % 9, o_orderkey % 5])[2]::DOUBLE AS most, round(o_totalprice * 0.001 + (o_custkey % 9) * 0.5, 6) AS cost FROM orders")
def order_costs(spark, sf_dir):
    units = {"tokens": F.col("o_totalprice"), "calls": F.col("o_custkey") % 9}
    rates = {"tokens": 0.001, "calls": 0.5}
    best = metrics.best_over_references(F.lit(0), F.array(F.col("o_custkey") % 9, F.col("o_orderkey") % 5), lambda _, r: r.cast("double"))
    return table(spark, sf_dir, "orders").select("o_orderkey", best.alias("most"), numbers.cost(units, rates).alias("cost"))
