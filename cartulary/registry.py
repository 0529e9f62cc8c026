"""What is registered: every operator's query and, where SQL can express it, the equivalent DuckDB SQL.

Each query is a function of (spark, folder of tables); each reads whole tables. Where the tables have no rows of an
operator's kind, the same literal rows stand on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartulary.functions import jsons, numbers, pii, policy, text
from cartulary.operators import audit, evidence, layout, lookup, metrics, quality, report, retrieval, review, rubric, training, versions
from cartulary.session import shipped

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def registered(sql: str | None = None):
    def add(function):
        _queries[function.__name__] = shipped(function)
        if sql:
            _sql[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: ranked retrieval of documents for the benchmark's items."""
    return _queries["bm25_search"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _all()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(_sql)


def _all() -> None:
    """The other module of queries registers its own when it is imported."""
    from cartulary import registry_runs  # noqa: F401


# SQL of the normalisers, for texts without compatibility characters.
def _marks(marks: str) -> str:
    return "[" + "".join("\\" + c if c.isascii() else c for c in dict.fromkeys(marks)).replace("'", "''") + "]"


def sql_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def sql_norm_key(x: str) -> str:
    return sql_collapse(f"regexp_replace(lower({x}), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s]', ' ', 'g')")


def sql_norm_answer(x: str) -> str:
    return f"lower({sql_collapse(f'''regexp_replace({x}, '{_marks(text.ANSWER_MARKS)}', '', 'g')''')})"


def sql_norm_index(x: str) -> str:
    return f"lower({sql_collapse(f'''regexp_replace({x}, '{_marks(text.INDEX_MARKS)}', ' ', 'g')''')})"


def sql_words(x: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+'))"


REFUSED = " OR ".join("contains(lower({x}), '" + m.replace("'", "''") + "')" for m in quality.REFUSALS)
PAIRS = "SELECT doc_id, 'document of ' || source AS question, trim(text) AS answer FROM documents"
REASON = f"""CASE WHEN question = '' OR answer = '' THEN 'empty' WHEN length(question) < 6 OR length(answer) < 4 THEN 'too_short'
WHEN {sql_norm_key('question')} = {sql_norm_key('answer')} THEN 'q_equals_a'
WHEN {REFUSED.format(x='question')} OR {REFUSED.format(x='answer')} THEN 'refusal' END"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.with_question_answer(docs.select("doc_id", F.concat(F.lit("document of "), "source").alias("question"), F.col("text").alias("ANSWER")).withColumnRenamed("ANSWER", "answer"))


WATERFALL = f"""WITH p AS ({PAIRS}), r AS (SELECT doc_id, answer, {REASON} AS reason FROM p),
k AS (SELECT {sql_norm_key('answer')} AS k, min(doc_id) AS first FROM r WHERE reason IS NULL GROUP BY 1),
w AS (SELECT doc_id, coalesce(reason, CASE WHEN doc_id <> first THEN 'duplicate' END) AS reason
      FROM r LEFT JOIN k ON {sql_norm_key('answer')} = k.k)"""


def _waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir)
    checked = pairs.select("doc_id", quality.reject_reason(F.col("question"), F.col("answer")).alias("reason"), F.sha2(text.norm_key(F.col("answer")), 256).alias("key"))
    # Rows that fail are keys of their own, so that all go through one pass and none is a copy of another.
    key = F.when(F.col("reason").isNull(), F.col("key")).otherwise(F.concat(F.lit("failed "), "doc_id"))
    marked = quality.keep_first(checked, key, "doc_id")
    return marked.select("doc_id", F.coalesce("reason", F.when(~F.col("kept"), "duplicate")).alias("reason"))


@registered(WATERFALL + "SELECT doc_id, reason FROM w")
def quality_waterfall(spark, sf_dir):
    return _waterfall(spark, sf_dir).select("doc_id", "reason")


@registered(WATERFALL + "SELECT count(*) AS n_input, count(*) FILTER (reason IS NULL) AS n_kept, count(reason) AS n_removed, " + ", ".join(f"count(*) FILTER (reason = '{r}') AS n_{r}" for r in quality.REASONS) + " FROM w")
def quality_counts(spark, sf_dir):
    return quality.reason_counts(_waterfall(spark, sf_dir))


@registered("SELECT doc_id, length(text) BETWEEN 10 AND 2000 AND trim(text) <> '' AS kept FROM documents")
def length_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", quality.length_filter(F.col("text")).alias("kept"))


@registered("SELECT doc_id, text, doc_id = min(doc_id) OVER (PARTITION BY text) AS kept FROM documents")
def exact_keep_first(spark, sf_dir):
    return quality.keep_first(table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("text"), "doc_id")


SIMILAR = f"""WITH s AS (SELECT min(doc_id) AS id, any_value({sql_words('text')}) AS words FROM documents GROUP BY {sql_norm_key('text')}),
x AS (SELECT id, len(words) AS n, unnest(words) AS w FROM s),
c AS (SELECT a.id AS i, b.id AS j, a.n AS m, b.n AS n, count(*) AS k FROM x a JOIN x b ON a.w = b.w AND a.id < b.id AND a.n >= 0.9 * b.n AND b.n >= 0.9 * a.n GROUP BY ALL),
e AS (SELECT i, j FROM c WHERE k::DOUBLE / (m + n - k) >= 0.9)"""


@registered(SIMILAR + " SELECT i, j FROM e")
def similar_pairs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    keys = quality.row_keys(docs, text=F.col("text"), order="doc_id")
    return quality.similar_pairs(quality.row_sets(docs, text=F.col("text"), order="doc_id"), threshold=0.9, first=quality.first_rows(keys))


# The scan itself, row by row: a row with a kept, similar row before it is dropped.
GREEDY = SIMILAR.replace("WITH s AS", "WITH RECURSIVE s AS") + f""", b AS (SELECT id, list(e.i) FILTER (e.i IS NOT NULL) AS before FROM (SELECT i AS id FROM e UNION SELECT j FROM e) n LEFT JOIN e ON e.j = n.id GROUP BY id),
o AS (SELECT *, row_number() OVER (ORDER BY id) AS k FROM b),
r AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS kept UNION ALL SELECT o.k, CASE WHEN len(list_intersect(coalesce(o.before, []), r.kept)) > 0 THEN r.kept ELSE list_append(r.kept, o.id::BIGINT) END FROM r JOIN o ON o.k = r.k + 1),
z AS (SELECT kept FROM r ORDER BY k DESC LIMIT 1), g AS (SELECT id FROM o, z WHERE NOT list_contains(z.kept, o.id::BIGINT)),
k AS (SELECT {sql_norm_key('text')} AS key, min(doc_id) AS first FROM documents GROUP BY 1)
SELECT doc_id, CASE WHEN first IN (SELECT id FROM g) THEN 'near_duplicate' WHEN doc_id <> first THEN 'duplicate' END AS reason FROM documents JOIN k ON {sql_norm_key('text')} = k.key"""


@registered(GREEDY)
def greedy_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.greedy_dedup(rows, text=F.col("text"), order="doc_id", threshold=0.9).select("doc_id", "reason")


QUERY = "SELECT item_id, text AS question FROM benchmark"


def _questions(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("question"))


@registered(
    f"""WITH q AS ({QUERY}), d AS (SELECT doc_id, t, string_split(replace(t, ' ', ''), '') AS c FROM (SELECT doc_id, {sql_norm_index('text')} AS t FROM documents)),
    u AS (SELECT item_id, t, string_split(replace(t, ' ', ''), '') AS c FROM (SELECT item_id, {sql_norm_index('question')} AS t FROM q)),
    dt AS (SELECT doc_id, list_filter(string_split(t, ' '), lambda x: x <> '') || list_transform(range(1, len(c)), lambda i: c[i] || c[i + 1]) AS toks FROM d),
    qt AS (SELECT DISTINCT item_id, unnest(list_filter(string_split(t, ' '), lambda x: x <> '') || list_transform(range(1, len(c)), lambda i: c[i] || c[i + 1])) AS tok FROM u),
    n AS (SELECT count(*) AS n, avg(len(toks)) AS mean FROM dt),
    p AS (SELECT doc_id, len, tok, count(*) AS tf FROM (SELECT doc_id, len(toks) AS len, unnest(toks) AS tok FROM dt) WHERE tok IN (SELECT tok FROM qt) GROUP BY ALL),
    f AS (SELECT tok, count(*) AS df FROM p GROUP BY tok),
    s AS (SELECT item_id, doc_id, sum(greatest(ln(1 + (n - df + 0.5) / (df + 0.5)), 1e-6) * (tf * 2.5) / (tf + 1.5 * (0.25 + 0.75 * len / mean))) AS score
          FROM qt JOIN p USING (tok) JOIN f USING (tok) CROSS JOIN n GROUP BY ALL)
    SELECT item_id AS query_id, doc_id AS element_id, round(score, 6) AS score, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id::VARCHAR) - 1 AS rank
    FROM s WHERE score > 0 QUALIFY rank < 5"""
)
def bm25_search(spark, sf_dir):
    got = retrieval.bm25(table(spark, sf_dir, "documents"), _questions(spark, sf_dir), corpus_id="doc_id", query_id="item_id")
    return got.select("query_id", "element_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


LEX = f"""WITH q AS ({QUERY}), d AS (SELECT doc_id, list_filter(string_split({sql_norm_answer('text')}, ' '), lambda x: x <> '') AS toks FROM documents),
    u AS (SELECT item_id, list_filter(string_split({sql_norm_answer('question')}, ' '), lambda x: x <> '') AS toks FROM q),
    dt AS (SELECT doc_id, n, tok, count(*) AS tf FROM (SELECT doc_id, len(toks) AS n, unnest(toks) AS tok FROM d) GROUP BY ALL),
    qt AS (SELECT item_id, tok, count(*) AS qf FROM (SELECT item_id, unnest(toks) AS tok FROM u) GROUP BY ALL),
    s AS (SELECT item_id, doc_id, sum(least(qf, tf)) / sqrt(n) AS score FROM qt JOIN dt USING (tok) GROUP BY item_id, doc_id, n),
    r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id::VARCHAR) - 1 AS rank FROM s QUALIFY rank < 5)"""


@registered(LEX + " SELECT item_id AS query_id, doc_id AS element_id, round(score, 6) AS score, rank FROM r")
def lexical_search(spark, sf_dir):
    got = retrieval.lexical(table(spark, sf_dir, "documents"), _questions(spark, sf_dir), corpus_id="doc_id", query_id="item_id")
    return got.select("query_id", "element_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@registered(
    LEX
    + """, g AS (SELECT b.item_id, list(DISTINCT d.doc_id) AS gold FROM benchmark b JOIN documents d ON contains(d.text, b.text) GROUP BY 1),
    h AS (SELECT item_id, list(doc_id ORDER BY rank) AS got FROM r GROUP BY 1)
    SELECT b.item_id AS query_id, CASE WHEN gold IS NOT NULL THEN len(list_intersect(gold, coalesce(got, [])))::DOUBLE / len(gold) END AS recall
    FROM benchmark b LEFT JOIN g USING (item_id) LEFT JOIN h USING (item_id)"""
)
def recall_at_5(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    got = retrieval.lexical(docs, _questions(spark, sf_dir), corpus_id="doc_id", query_id="item_id")
    ranked = got.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "element_id"))), lambda x: x["element_id"]).alias("got"))
    gold = docs.join(F.broadcast(items.withColumnRenamed("text", "quote")), F.expr("contains(text, quote)")).groupBy(F.col("item_id").alias("query_id")).agg(F.collect_set("doc_id").alias("gold"))  # the benchmark's items are few
    rows = items.select(F.col("item_id").alias("query_id")).join(gold, "query_id", "left").join(ranked, "query_id", "left")
    empty = F.array().cast("array<bigint>")
    return rows.select("query_id", retrieval.recall_at_k(F.coalesce("gold", empty), F.coalesce("got", empty), 5).alias("recall"))


@registered("""WITH d AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents), q AS (SELECT item_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM benchmark)
    SELECT item_id AS quote_id, doc_id, 'p1-b0' AS element_id FROM q JOIN d ON contains(d.t, q.t)""")
def quote_lookup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lit("p1-b0").alias("element_id"), F.lit(0).alias("index"), text.norm_quote(F.col("text")).alias("text"))
    quotes = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("quote_id"), F.col("text").alias("quote"))
    return evidence.find_quotes_anywhere(docs, quotes)


@registered(
    """WITH w AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}_]+') AS w FROM documents),
    v AS (SELECT item_id AS id, regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}_]+') AS w FROM benchmark),
    g AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS gram FROM w),
    h AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS gram FROM v)
    SELECT g.id AS doc_id, h.id AS item_id, count(*) AS n_shared FROM g JOIN h USING (gram) GROUP BY ALL"""
)
def contamination(spark, sf_dir):
    return audit.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=8)


def _re(pattern: str) -> str:
    return pattern.replace("'", "''")


@registered("SELECT doc_id, " + ", ".join(f"len(regexp_extract_all(text, '{_re(p)}'))::BIGINT AS n_{k}" for k, p in pii.PATTERNS.items()) + " FROM documents")
def pii_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", *[F.size(pii.values_of(F.col("text"), k)).cast("long").alias(f"n_{k}") for k in pii.PATTERNS])


def _redacted_sql(x: str) -> str:
    for k, p in pii.PATTERNS.items():
        x = f"regexp_replace({x}, '{_re(p)}', '[REDACTED_{k.upper()}]', 'g')"
    return x


@registered(f"SELECT doc_id, sha256({_redacted_sql('text')}) AS redacted_sha256 FROM documents")
def pii_redact(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(pii.redact(F.col("text")), 256).alias("redacted_sha256"))


def _spans_sql() -> str:
    """Matches of each kind with their places (lengths of what stands before), kinds in order of priority, those that
    overlap an earlier kind's left out."""
    parts = ["d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)"]
    for i, k in enumerate(pii.PRIORITY):
        p = _re(pii.PATTERNS[k])
        parts.append(f"a{i} AS (SELECT rid, doc_id, regexp_extract_all(text, '{p}') AS v, regexp_split_to_array(text, '{p}') AS s FROM d)")
        parts.append(
            f"m{i} AS (SELECT rid, doc_id, '{k}' AS kind, v[j] AS value, (list_sum(list_transform(s[1:j], lambda x: length(x))) + coalesce(list_sum(list_transform(v[1:j - 1], lambda x: length(x))), 0))::INT AS b FROM (SELECT *, unnest(range(1, len(v) + 1)) AS j FROM a{i}))"
        )
        before = f" WHERE NOT EXISTS (SELECT 1 FROM k{i - 1} o WHERE o.rid = m.rid AND m.b < o.b + length(o.value) AND o.b < m.b + length(m.value))" if i else ""
        parts.append(f"k{i} AS (" + (f"SELECT * FROM k{i - 1} UNION ALL " if i else "") + f"SELECT m.* FROM m{i} m{before})")
    return ", ".join(parts)


DIGITS = "regexp_replace(value, '\\D', '', 'g')"
BARE = "replace(value, '-', '')"
LUHN = f"length({DIGITS}) >= 12 AND list_sum(list_transform(range(1, length({DIGITS}) + 1), lambda j: CASE WHEN j % 2 = 1 THEN {DIGITS}[length({DIGITS}) - j + 1]::INT WHEN {DIGITS}[length({DIGITS}) - j + 1]::INT > 4 THEN 2 * {DIGITS}[length({DIGITS}) - j + 1]::INT - 9 ELSE 2 * {DIGITS}[length({DIGITS}) - j + 1]::INT END)) % 10 = 0"
FAKE = f"""CASE kind WHEN 'email' THEN regexp_matches(lower(value), '[@.]example\\.(com|org|net)$') WHEN 'card' THEN NOT ({LUHN})
    WHEN 'rrn' THEN try_strptime('19' || left(value, 6), '%Y%m%d') IS NULL AND try_strptime('20' || left(value, 6), '%Y%m%d') IS NULL
    WHEN 'phone' THEN contains({DIGITS}, '55501') OR ends_with({DIGITS}, '0000000') OR contains({DIGITS}, '00000000') WHEN 'account' THEN length(regexp_replace({BARE}, '[^0]', '', 'g')) >= greatest(4, length({BARE}) - 2) END"""


@registered(f"WITH {_spans_sql()} SELECT doc_id, kind, b AS start, b + length(value) AS \"end\", value, {FAKE} AS fake FROM k{len(pii.PRIORITY) - 1}")
def pii_detect(spark, sf_dir):
    hits = table(spark, sf_dir, "documents").select("doc_id", F.explode(pii.detect(F.col("text"))).alias("h"))
    return hits.select("doc_id", "h.kind", "h.start", "h.end", "h.value", "h.fake")


PII_ROWS = (("rrn", "990231-1234567"), ("rrn", "990228-1234567"), ("phone", "010-5550-1234"), ("phone", "010-1234-5678"), ("card", "4111 1111 1111 1111"), ("card", "4111 1111 1111 1112"), ("account", "110-000-000000"), ("account", "110-234-567890"), ("email", "a@mail.example.com"), ("email", "a@firma.de"))


@registered(
    "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}', {'true' if f else 'false'})" for (k, v), f in zip(PII_ROWS, (True, False, True, False, False, True, True, False, True, False), strict=True)) + ") AS t(kind, value, fake)"
)
def pii_fake(spark, sf_dir):
    return spark.createDataFrame(PII_ROWS, "kind string, value string").select("kind", "value", pii.mechanically_fake(F.col("kind"), F.col("value")).alias("fake"))


FACTS = """SELECT o_orderkey AS qa_id, 'c' || o_custkey AS fact, floor(o_totalprice)::BIGINT::VARCHAR AS answer,
    CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'stale' ELSE 'revoked' END AS source_status,
    CASE WHEN o_custkey % 2 = 0 THEN 'mutable' ELSE 'stable' END AS fact_volatility, strftime(o_orderdate, '%Y-%m-%d') AS effective_from,
    left(o_orderpriority, 1) AS document_version, CASE WHEN o_orderkey % 17 = 0 THEN 'rejected' ELSE 'approved' END AS review_status, o_orderkey % 11 <> 0 AS answerable FROM orders"""
SELECTED = f"""WITH r AS ({FACTS}), l AS (SELECT *, source_status <> 'revoked' AS live, source_status = 'active' AS act, bool_or(source_status = 'active') OVER (PARTITION BY fact) AS any_active FROM r),
    p AS (SELECT *, rank() OVER (PARTITION BY fact ORDER BY effective_from DESC, document_version::DOUBLE DESC NULLS LAST) AS rk FROM l WHERE live AND (act OR NOT any_active)),
    t AS (SELECT fact, min_by(qa_id, qa_id) AS qa_id, min_by(answer, qa_id) AS answer, count(DISTINCT answer) AS n FROM p WHERE rk = 1 GROUP BY fact),
    g AS (SELECT fact, bool_or(live) AS any_live, bool_or(act) AS any_act, bool_or(fact_volatility = 'mutable') AS mutable, count(*) AS n_considered FROM l GROUP BY fact),
    s AS (SELECT fact, n_considered, mutable, CASE WHEN NOT any_live THEN 'none_in_effect' WHEN n > 1 THEN 'conflict_no_order' WHEN any_act THEN 'selected_latest_active'
          WHEN mutable THEN 'only_stale_mutable' ELSE 'selected_stable_from_stale' END AS reason, qa_id, answer FROM g LEFT JOIN t USING (fact)),
    d AS (SELECT fact, CASE WHEN starts_with(reason, 'selected') THEN qa_id END AS selected_id, CASE WHEN starts_with(reason, 'selected') THEN answer END AS answer, reason, NOT starts_with(reason, 'selected') AS abstain, mutable, n_considered FROM s)"""


def _facts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("qa_id"),
        F.concat(F.lit("c"), "o_custkey").alias("fact"),
        F.floor("o_totalprice").cast("string").alias("answer"),
        F.when(F.col("o_orderstatus") == "O", "active").when(F.col("o_orderstatus") == "F", "stale").otherwise("revoked").alias("source_status"),
        F.when(F.col("o_custkey") % 2 == 0, "mutable").otherwise("stable").alias("fact_volatility"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("effective_from"),
        F.lit(None).cast("string").alias("effective_until"),
        F.left("o_orderpriority", F.lit(1)).alias("document_version"),
        F.when(F.col("o_orderkey") % 17 == 0, "rejected").otherwise("approved").alias("review_status"),
        (F.col("o_orderkey") % 11 != 0).alias("answerable"),
        F.col("o_orderkey").alias("pos"),
    )


@registered(SELECTED + " SELECT * FROM d")
def version_selection(spark, sf_dir):
    return versions.select_sources(_facts(spark, sf_dir))


@registered(SELECTED + """ SELECT r.qa_id, CASE WHEN review_status = 'rejected' THEN 'held' WHEN source_status IN ('stale', 'revoked') THEN 'archive' WHEN NOT answerable THEN 'active'
    WHEN NOT mutable THEN 'active' WHEN abstain THEN 'held' WHEN r.qa_id = selected_id THEN 'active' ELSE 'archive' END AS part FROM r JOIN d USING (fact)""")
def export_partition(spark, sf_dir):
    return versions.partition_for_export(_facts(spark, sf_dir)).select("qa_id", "part")


@registered(SELECTED + """ SELECT count(*) AS n_mutable_facts, count(*) FILTER (NOT abstain) AS resolved, count(*) FILTER (abstain) AS abstained,
    count(*) FILTER (NOT abstain AND source_status = 'active') AS recency_ok FROM d LEFT JOIN r ON r.qa_id = selected_id WHERE mutable""")
def mutable_facts(spark, sf_dir):
    return versions.mutable_fact_report(_facts(spark, sf_dir))


CITED = "SELECT 'l' || l_orderkey AS qa_id, 'p' || l_partkey % 50 AS document_id, 'v' || l_linenumber AS document_version FROM lineitem"


@registered(f"WITH c AS ({CITED}) SELECT DISTINCT qa_id FROM c WHERE document_id = 'p7' AND document_version <> 'v2'")
def affected_by_version(spark, sf_dir):
    return versions.affected_by_version(_cited(spark, sf_dir), new_version="v2", document_id="p7")


def _cited(spark, sf_dir):
    item = F.struct(F.concat(F.lit("p"), F.col("l_partkey") % 50).alias("document_id"), F.concat(F.lit("v"), "l_linenumber").alias("document_version"))
    return table(spark, sf_dir, "lineitem").select(F.concat(F.lit("l"), "l_orderkey").alias("qa_id"), F.lit(None).cast("string").alias("document_version"), F.array(item).alias("evidence"))


@registered(f"WITH c AS ({CITED}), a AS (SELECT DISTINCT qa_id FROM c WHERE document_id = 'p7' AND document_version <> 'v2') SELECT 'ds-' || left(sha256('v2' || coalesce(string_agg(chr(0) || qa_id, '' ORDER BY qa_id), '')), 12) AS dataset_version, count(*) AS n_affected FROM a")
def dataset_version(spark, sf_dir):
    got = versions.dataset_version(versions.affected_by_version(_cited(spark, sf_dir), new_version="v2", document_id="p7"), "v2")
    return got.select("dataset_version", F.col("n_affected").cast("long").alias("n_affected"))


ACTIONS = "CASE event_type WHEN 'purchase' THEN 'accept' WHEN 'click' THEN 'edit' WHEN 'view' THEN 'reopen' ELSE 'reject' END"
LOG = f"SELECT user_id AS qa_id, event_id, ts, {ACTIONS} AS action FROM events"
STATUS = "CASE action WHEN 'accept' THEN 'approved' WHEN 'edit' THEN 'edited' WHEN 'reject' THEN 'rejected' ELSE 'owner_review_pending' END"


def _log(spark, sf_dir):
    kind = F.col("event_type")
    action = F.when(kind == "purchase", "accept").when(kind == "click", "edit").when(kind == "view", "reopen").otherwise("reject")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("qa_id"), "event_id", "ts", "value", action.alias("action"), F.lit("r1").alias("reviewer"))


@registered(f"WITH l AS ({LOG}) SELECT qa_id, action, event_id, {STATUS} AS review_status FROM l QUALIFY row_number() OVER (PARTITION BY qa_id ORDER BY ts DESC, event_id DESC) = 1")
def review_latest(spark, sf_dir):
    return review.latest(_log(spark, sf_dir), order=("ts", "event_id")).drop("reviewer")


BODY = """'{"action":"' || {b}.action || '","edits":[],"evidence_anchor":null,"note":null,"prev_event_id":' || {prev} || ',"qa_id":' || {b}.qa_id || ',"reject_reason":' || CASE WHEN {b}.action = 'reject' THEN '"other"' ELSE 'null' END || ',"reviewer":"r1","timestamp":"' || strftime({b}.ts, '%Y-%m-%dT%H:%M:%SZ') || '"}'"""


def _body(b: str, prev: str) -> str:
    return BODY.replace("{b}", b).replace("{prev}", prev)


@registered(
    f"""WITH RECURSIVE l AS (SELECT *, row_number() OVER (PARTITION BY qa_id ORDER BY ts, event_id) AS n FROM ({LOG})),
    c AS (SELECT qa_id, n, event_id AS no, action, NULL::VARCHAR AS prev, left(sha256({_body('l', "'null'")}), 24) AS id FROM l WHERE n = 1
      UNION ALL SELECT l.qa_id, l.n, l.event_id, l.action, c.id, left(sha256({_body('l', """'"' || c.id || '"'""")}), 24) FROM c JOIN l ON l.qa_id = c.qa_id AND l.n = c.n + 1),
    k AS (SELECT *, lag(id) OVER (PARTITION BY qa_id ORDER BY n) AS before, (no % 97 = 0 AND action <> 'accept') OR no % 89 = 0 AS bad FROM c WHERE no % 83 <> 0)
    SELECT qa_id, id AS event_id, CASE WHEN bad THEN 'bad_hash' ELSE 'broken_chain' END AS fault FROM k WHERE bad OR prev IS DISTINCT FROM before"""
)
def review_chain(spark, sf_dir):
    log = _log(spark, sf_dir).withColumnRenamed("event_id", "no").drop("value")
    log = log.withColumns({"timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "reject_reason": F.when(F.col("action") == "reject", "other")})
    chained = review.chain(log, order=("ts", "no"))
    # Some events are changed, some have another predecessor, some are gone.
    spoilt = chained.where("no % 83 <> 0").withColumns({"action": F.when(F.col("no") % 97 == 0, "accept").otherwise(F.col("action")), "prev_event_id": F.when(F.col("no") % 89 == 0, "x").otherwise(F.col("prev_event_id"))})
    return review.chain_faults(spoilt, order=("ts", "no"))


@registered(f"""WITH l AS ({LOG}), s AS (SELECT qa_id, {STATUS} AS st FROM l QUALIFY row_number() OVER (PARTITION BY qa_id ORDER BY ts DESC, event_id DESC) = 1),
    r AS (SELECT DISTINCT user_id AS qa_id FROM events), a AS (SELECT qa_id FROM r WHERE qa_id % 3 <> 0)
    SELECT r.qa_id, coalesce(st, 'owner_review_pending') AS review_status, CASE WHEN st = 'rejected' THEN 'quarantine' WHEN st IN ('approved', 'edited') AND a.qa_id IS NOT NULL THEN 'train' ELSE 'pending' END AS split
    FROM r LEFT JOIN s USING (qa_id) LEFT JOIN a ON a.qa_id = r.qa_id""")
def review_export(spark, sf_dir):
    log = _log(spark, sf_dir)
    records = log.select("qa_id").distinct()
    return review.export_training(records, log, records.where("qa_id % 3 <> 0"), order=("ts", "event_id")).select("qa_id", "review_status", "split")


@registered(f"""WITH l AS ({LOG}), e AS (SELECT *, 'f' || event_id % 4 AS field, event_id::VARCHAR AS old, ts::VARCHAR AS t FROM l WHERE action = 'edit')
    SELECT qa_id, field, arg_min(event_id, (ts, event_id))::VARCHAR AS original, 'n' || arg_max(event_id, (ts, event_id))::VARCHAR AS value, count(*) AS n_edits FROM e GROUP BY ALL""")
def review_edits(spark, sf_dir):
    log = _log(spark, sf_dir)
    one = F.struct(F.concat(F.lit("f"), F.col("event_id") % 4).alias("field"), F.col("event_id").cast("string").alias("old"), F.concat(F.lit("n"), "event_id").alias("new"))
    return review.edited_fields(log, log.withColumn("edits", F.array(one)), order=("ts", "event_id"))


@registered("""WITH v AS (SELECT l_returnflag, l_extendedprice AS x, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS r, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
    SELECT l_returnflag, n, max(x) FILTER (r = round_even(0.5 * (n - 1), 0)::BIGINT + 1) AS p50, max(x) FILTER (r = round_even(0.95 * (n - 1), 0)::BIGINT + 1) AS p95, max(x) FILTER (r = round_even(0.99 * (n - 1), 0)::BIGINT + 1) AS p99 FROM v GROUP BY ALL""")
def percentiles(spark, sf_dir):
    return report.nearest_rank(table(spark, sf_dir, "lineitem"), "l_extendedprice", (0.5, 0.95, 0.99), by=("l_returnflag",))


@registered("SELECT event_type, count(*) AS n, count(*) FILTER (value > 5) AS completed, sum(event_id % 100) FILTER (value > 5)::BIGINT AS tokens, count(*) FILTER (value > 5 AND event_id % 10 <= 6 AND user_id % 10 <= 7)::DOUBLE / nullif(count(*) FILTER (value > 5), 0) AS goodput FROM events GROUP BY ALL")
def serving_rollup(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", (F.col("value") > 5).alias("ok"), (F.col("event_id") % 100).alias("tokens"), (F.col("event_id") % 10).alias("ttft"), (F.col("user_id") % 10).alias("e2e"))
    return report.serving_rollup(e, sla_ttft=6, sla_e2e=7, by=("event_type",))


@registered("SELECT c_mktsegment, round(avg(c_acctbal), 6) AS c_acctbal_mean, round(stddev_pop(c_acctbal), 6) AS c_acctbal_std, count(c_acctbal) AS c_acctbal_n FROM customer GROUP BY ALL")
def seed_aggregate(spark, sf_dir):
    got = report.seed_aggregate(table(spark, sf_dir, "customer"), ("c_acctbal",), ("c_mktsegment",))
    return got.withColumns({c: F.round(c, 6) for c in ("c_acctbal_mean", "c_acctbal_std")})


@registered("WITH m AS (SELECT p_partkey, p_size, p_retailprice FROM part) SELECT p_partkey FROM m a WHERE NOT EXISTS (SELECT 1 FROM m b WHERE b.p_retailprice <= a.p_retailprice AND b.p_size >= a.p_size AND (b.p_retailprice < a.p_retailprice OR b.p_size > a.p_size))")
def pareto(spark, sf_dir):
    return report.frontier_2d(table(spark, sf_dir, "part"), least="p_retailprice", most="p_size").select("p_partkey")


CANDIDATES = (("a", 0.8, 15.0, None), ("b", 0.79, 6.0, 1.2), ("c", 0.7, 6.0, 1.0), ("d", None, 5.0, 0.5))
CANDIDATE_VALUES = "(VALUES ('a', 0.8::DOUBLE, 15.0::DOUBLE, NULL::DOUBLE), ('b', 0.79, 6.0, 1.2), ('c', 0.7, 6.0, 1.0), ('d', NULL, 5.0, 0.5)) AS t(id, f1, size_gb, ttft)"
CONSTRAINTS = {"f1": {"drop_max": 0.02, "drop_baseline": "a"}, "size_gb": {"max": 8.0}, "ttft": {"max": 2.0}}


def _candidates(spark):
    return spark.createDataFrame(CANDIDATES, "id string, f1 double, size_gb double, ttft double")


@registered(f"SELECT id, coalesce(0.8 - f1 <= 0.02 + 1e-9 AND size_gb <= 8 + 1e-9 AND ttft <= 2 + 1e-9, false) AS feasible FROM {CANDIDATE_VALUES}")
def constraints(spark, sf_dir):
    return report.check_constraints(_candidates(spark), CONSTRAINTS).select("id", "feasible")


@registered("SELECT 'b' AS recommendation")
def recommendation(spark, sf_dir):
    return report.recommend(report.check_constraints(_candidates(spark), CONSTRAINTS), objective="f1")


@registered("SELECT 'd' AS id")
def pareto_small(spark, sf_dir):
    return report.pareto_frontier(_candidates(spark), {"f1": "max", "size_gb": "min"}).select("id")


SPLITS = "SELECT doc_id, source, text, CASE doc_id % 3 WHEN 0 THEN 'dev' WHEN 1 THEN 'final' ELSE 'train' END AS split FROM documents"


def _splits(spark, sf_dir):
    k = F.col("doc_id") % 3
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text", F.when(k == 0, "dev").when(k == 1, "final").otherwise("train").alias("split"))


@registered(f"WITH s AS ({SPLITS}) SELECT sha256(text) AS span, array_to_string(list_sort(list(DISTINCT split)), ',') AS splits FROM s GROUP BY text HAVING count(DISTINCT split) > 1")
def split_leakage(spark, sf_dir):
    rows = _splits(spark, sf_dir).withColumn("span", F.sha2("text", 256))
    return audit.crossing(rows, "span").select("span", F.array_join("splits", ",").alias("splits"))


@registered(f"WITH s AS ({SPLITS}) SELECT source, array_to_string(list_sort(list(DISTINCT split)), ',') AS splits FROM s GROUP BY source HAVING count(DISTINCT split) > 1")
def family_leakage(spark, sf_dir):
    return audit.crossing(_splits(spark, sf_dir), "source").select("source", F.array_join("splits", ",").alias("splits"))


@registered(f"WITH s AS ({SPLITS}) SELECT doc_id FROM s WHERE split = 'train' AND text IN (SELECT text FROM s WHERE split = 'final')")
def holdout_leakage(spark, sf_dir):
    s = _splits(spark, sf_dir)
    return audit.leaked(s.where("split = 'train'"), s.where("split = 'final'"), "text").select("doc_id")


@registered("SELECT sha256(string_agg(item_id::VARCHAR, chr(10) ORDER BY item_id::VARCHAR)) AS id_sha256, count(*) AS n FROM benchmark")
def set_hash(spark, sf_dir):
    return audit.set_hash(table(spark, sf_dir, "benchmark"), "item_id")


@registered("SELECT o_orderkey FROM orders QUALIFY row_number() OVER (ORDER BY o_totalprice, o_orderkey) BETWEEN 101 AND 400")
def ordered_slice(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return audit.slice_rows(o, order=["o_totalprice", "o_orderkey"], start=100, end=400).select("o_orderkey")


@registered("SELECT l_partkey AS id, count(DISTINCT l_linenumber) AS n_rounds FROM lineitem GROUP BY ALL")
def reuse_counts(spark, sf_dir):
    return audit.reuse_counts(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_linenumber").alias("round")))


@registered("WITH a AS (SELECT p_size AS batch, max(p_retailprice) AS s FROM part WHERE p_partkey % 2 = 0 GROUP BY 1), b AS (SELECT p_size AS batch, max(p_retailprice) AS s FROM part WHERE p_partkey % 2 = 1 GROUP BY 1) SELECT min(batch) AS crossover_batch FROM a JOIN b USING (batch) WHERE a.s > b.s")
def crossover(spark, sf_dir):
    p = table(spark, sf_dir, "part").groupBy(F.col("p_size").alias("batch"), (F.col("p_partkey") % 2).alias("k")).agg(F.max("p_retailprice").alias("tok_per_s"))
    return report.crossover(p.where("k = 0"), p.where("k = 1"))


@registered("""WITH a AS (SELECT '/' || n_name AS pointer, n_regionkey::VARCHAR AS value FROM nation WHERE n_nationkey < 20), b AS (SELECT '/' || n_name AS pointer, (n_regionkey % 3)::VARCHAR AS value FROM nation WHERE n_nationkey > 4)
    SELECT pointer, a.value AS left, b.value AS right FROM a FULL JOIN b USING (pointer) WHERE a.value IS DISTINCT FROM b.value""")
def pointer_diff(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    side = lambda where, value: n.where(where).select(F.concat(F.lit("/"), "n_name").alias("pointer"), value.cast("string").alias("value"))
    return report.pointer_diff(side("n_nationkey < 20", F.col("n_regionkey")), side("n_nationkey > 4", F.col("n_regionkey") % 3))


@registered("""WITH c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
    SELECT conv_id, coalesce('<|system|>' || chr(10) || nullif(max_by(text, turn) FILTER (role = 'system'), '') || chr(10), '')
      || coalesce(string_agg(CASE WHEN role = 'user' THEN '<|user|>' || chr(10) || text WHEN role = 'assistant' AND i < n THEN '<|assistant|>' || chr(10) || text END, chr(10) ORDER BY i), '') || chr(10) || '<|assistant|>' || chr(10) AS prompt,
      coalesce(max(text) FILTER (role = 'assistant' AND i = n), '') AS completion, max(n) AS n_messages FROM c GROUP BY conv_id""")
def chat_format(spark, sf_dir):
    got = training.conversations_to_chat(table(spark, sf_dir, "conversations"))
    return got.withColumn("n_messages", F.col("n_messages").cast("long"))


ANSWERS = "SELECT item_id, text AS gold, left(text, (length(text) // 2)::INT) AS answer FROM benchmark"


@registered(f"""WITH a AS (SELECT item_id, replace({sql_norm_answer('gold')}, ' ', '') AS g, replace({sql_norm_answer('answer')}, ' ', '') AS p, {sql_norm_answer('gold')} = {sql_norm_answer('answer')} AS same FROM ({ANSWERS})),
    g AS (SELECT item_id, c, count(*) AS n FROM (SELECT item_id, unnest(string_split(g, '')) AS c FROM a) GROUP BY ALL), p AS (SELECT item_id, c, count(*) AS n FROM (SELECT item_id, unnest(string_split(p, '')) AS c FROM a) GROUP BY ALL),
    k AS (SELECT item_id, sum(least(g.n, p.n)) AS n FROM g JOIN p USING (item_id, c) GROUP BY ALL)
    SELECT item_id, same::INT::DOUBLE AS em, round(coalesce(2 * (n / length(p)) * (n / length(g)) / (n / length(p) + n / length(g)), 0), 9) AS f1 FROM a LEFT JOIN k USING (item_id)""")
def answer_f1(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("gold"), F.left("text", F.floor(F.length("text") / 2).cast("int")).alias("answer"))
    return b.select("item_id", text.exact_match(F.col("answer"), F.col("gold")).alias("em"), F.round(text.char_f1(F.col("answer"), F.col("gold")), 9).alias("f1"))


TYPED = (("2024년 3월에 1,200원", "2024년 3월 1,200원"), ("약 15.5%", "15.5 퍼센트"), ("없음", "42건"), ("7명", "없음"), (None, "3일"))
TYPED_RESULT = ((True, True, False), (True, False, None), (False, False, None), (None, None, None), (False, False, False))


@registered("SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(str(v).lower() if v is not None else "NULL::BOOLEAN" for v in (i, *r)) + ")" for i, r in enumerate(TYPED_RESULT)) + ") AS t(i, numeric_exact, unit_exact, date_exact)")
def typed_exactness(spark, sf_dir):
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(TYPED)], "i int, said string, gold string")
    pairs = {"numeric_exact": numbers.answer_numbers, "unit_exact": numbers.answer_units, "date_exact": numbers.answer_dates}
    return rows.select("i", *[numbers.all_in(f(F.col("gold")), f(F.col("said"))).alias(n) for n, f in pairs.items()])


STORIES = (
    ("무엇을 했나요", "사실입니다."),
    ("무엇을 했나요", "사실이 아니다."),
    ("가장 행복했던 순간은?", "나는 \"왜 그래요?\" 하고 물었다."),
    ("무엇을 했나요", "사실입니다."),
    ("짧다", "그는 집에 갔다."),
    ("어떤 교훈을 얻었나요", "그는 집에 갔다."),
)
STORY_RESULT = ((True, False, True, True, False), (True, True, True, True, False), (True, True, True, False, True), (False, False, True, True, False), (False, True, False, False, False), (True, True, False, False, True))


@registered("SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(str(v).lower() for v in (i, *r)) + ")" for i, r in enumerate(STORY_RESULT)) + ") AS t(pos, format_ok, register_ok, first_person_ok, first_person_warn, leading_warn)")
def rubric_layer_one(spark, sf_dir):
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(STORIES)], "pos int, question string, answer string")
    return rubric.layer_one(rows).select("pos", "format_ok", "register_ok", "first_person_ok", "first_person_warn", "leading_warn")


PROVIDERS = (("ollama", "restricted", "denied", ()), ("azure", "public", "allowed", ()), ("azure", "public", "allowed", ("openai",)), ("azure", "restricted", "allowed", ()), ("open-ai", "public", "allowed", ("open_ai",)), ("mystery", "public", "allowed", ()), ("bedrock", "internal", "denied", ()))


@registered("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{d}')" for i, d in enumerate(("allow", "allow", "deny", "deny", "allow", "deny", "deny"))) + ") AS t(i, decision)")
def egress(spark, sf_dir):
    rows = spark.createDataFrame([(i, p, c, e, list(a)) for i, (p, c, e, a) in enumerate(PROVIDERS)], "i int, provider string, class string, egress string, allowed array<string>")
    return rows.select("i", policy.egress_decision(F.col("provider"), data_class=policy.parsed_class(F.col("class")), egress=F.col("egress"), allowed=F.col("allowed")).alias("decision"))


RESPONSES = ('```json\n[{"QUESTION": "q", "ANSWER": "a"},]\n```', '{"QUESTION": "q1", "ANSWER": "a1"}\n{"QUESTION": "q2", "ANSWER": "a2"}', "nothing", '{"QUESTION": "x", "ANSWER": "y",}')


@registered("SELECT * FROM (VALUES (0, 'q', 'a'), (1, 'q1', 'a1'), (1, 'q2', 'a2'), (3, 'x', 'y')) AS t(i, question, answer)")
def response_pairs(spark, sf_dir):
    rows = spark.createDataFrame(list(enumerate(RESPONSES)), "i int, response string")
    return rows.select("i", F.explode(jsons.parse_pairs(F.col("response"))).alias("p")).select("i", F.col("p.QUESTION").alias("question"), F.col("p.ANSWER").alias("answer"))


@registered()
def page_chunks(spark, sf_dir):
    return layout.chunks(layout.page_elements(table(spark, sf_dir, "pages")), max_chars=1200, soft_limit=800)


ELEMENTS = (
    (1, 0, "Title", "T", 1, None, None, None),
    (1, 1, "NarrativeText", "before one", 1, None, 5.0, 9.0),
    (1, 2, "Image", None, 1, "f1.png", 10.0, 20.0),
    (1, 3, "Caption", "below", 1, None, 21.0, 22.0),
    (1, 4, "NarrativeText", "further", 1, None, 25.0, 26.0),
    (1, 5, "Title", "Next", 1, None, None, None),
    (1, 6, "NarrativeText", "other section", 1, None, 30.0, 31.0),
    (1, 7, "Image", None, 2, "f2.png", 1.0, 4.0),
)


def _elements(spark):
    rows = spark.createDataFrame(ELEMENTS, "doc_id int, index int, category string, text string, page int, image_path string, y0 double, y1 double")
    return rows.withColumns({"x0": F.lit(0.0), "x1": F.lit(1.0)})


@registered("SELECT * FROM (VALUES (1, 2, 1, 'T', 1, 'before one', 2, 'below' || chr(10) || 'further'), (1, 7, 2, 'Next', 0, '', 0, '')) AS t(doc_id, index, figure, section, n_before, context_before, n_after, context_after)")
def figure_context(spark, sf_dir):
    got = layout.figures(_elements(spark))
    return got.withColumns({c: F.col(c).cast("int") for c in ("figure", "n_before", "n_after")})


@registered("SELECT 1 AS doc_id, 2 AS index, 3 AS caption_index, 1.0::DOUBLE AS gap")
def figure_captions(spark, sf_dir):
    return layout.spatial_captions(_elements(spark))


EXAMPLES = """SELECT b.item_id, b.text AS gold, d.text AS quote, b.item_id % 4 <> 0 AS answerable FROM benchmark b LEFT JOIN (SELECT DISTINCT doc_id, text FROM documents) d ON d.doc_id = b.item_id"""


def _examples(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").withColumnRenamed("text", "answer")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "text")
    e = F.struct(F.lit("s").alias("document_sha256"), F.lit("v1").alias("document_version"), F.lit(1).alias("page"), F.col("item_id").cast("string").alias("element_id"), F.left("text", F.lit(200)).alias("quote"), F.sha2(text.norm_quote(F.left("text", F.lit(200))), 256).alias("quote_sha256"))
    rows = items.join(docs, "item_id")
    gold = rows.select(F.col("item_id").cast("string").alias("qa_id"), F.concat(F.lit("c"), F.col("item_id") % 3).alias("category"), (F.col("item_id") % 4 != 0).alias("answerable"), "answer", F.array(e).alias("evidence"))
    half = F.left("answer", F.floor(F.length("answer") * F.when(F.col("item_id") % 2 == 0, 0.9).otherwise(0.3)).cast("int"))
    said = rows.where("item_id % 7 <> 3").select(F.col("item_id").cast("string").alias("qa_id"), F.when(F.col("item_id") % 5 == 0, "cannot say").otherwise(half).alias("answer"), F.lit(False).alias("abstained"), F.array(e).alias("citations"), F.array(F.col("item_id").cast("string")).alias("retrieved"))
    return gold, said


@registered()
def example_scores(spark, sf_dir):
    gold, said = _examples(spark, sf_dir)
    return metrics.score_examples(gold, said)


@registered("""WITH e AS (SELECT item_id, item_id % 4 <> 0 AS ok, item_id % 7 <> 3 AND item_id % 5 = 0 AS ab FROM benchmark JOIN (SELECT doc_id AS item_id FROM documents) USING (item_id))
    SELECT 'c' || item_id % 3 AS category, count(*) AS n_examples, count(*) FILTER (ok) AS n_answerable, count(*) FILTER (ab AND NOT ok) AS abstain_tp, count(*) FILTER (ab AND ok) AS abstain_fp, count(*) FILTER (NOT ab AND NOT ok) AS abstain_fn FROM e GROUP BY ALL""")
def example_aggregate(spark, sf_dir):
    gold, said = _examples(spark, sf_dir)
    got = metrics.aggregate(metrics.score_examples(gold, said), by=("category",))
    return got.select("category", "n_examples", "n_answerable", "abstain_tp", "abstain_fp", "abstain_fn")


@registered()
def example_taxonomy(spark, sf_dir):
    gold, said = _examples(spark, sf_dir)
    return metrics.taxonomy(metrics.score_examples(gold, said))


@registered()
def bootstrap_delta(spark, sf_dir):
    gold, said = _examples(spark, sf_dir)
    a = metrics.score_examples(gold, said).withColumn("arm", F.lit("half"))
    b = metrics.score_examples(gold, said.withColumn("answer", F.lit("x")))
    return metrics.paired_bootstrap(a, b.withColumn("arm", F.lit("none")), "f1")


@registered("SELECT count(*) AS n, count(*) AS n_ok, 1.0::DOUBLE AS integrity FROM benchmark JOIN (SELECT doc_id AS item_id FROM documents) USING (item_id)")
def evidence_integrity(spark, sf_dir):
    gold, _ = _examples(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    elements = docs.select(F.lit("s").alias("document_sha256"), F.col("doc_id").cast("string").alias("element_id"), F.lit(1).alias("page"), text.norm_quote(F.col("text")).alias("text"))
    return evidence.integrity(evidence.verify(gold.withColumns({"answer": F.lit("no number"), "category": F.lit("factual")}), elements))


@registered()
def reward_scores(spark, sf_dir):
    gold, _ = _examples(spark, sf_dir)
    spec = {"computation": F.lit(None).cast("struct<op:string,operands:array<double>>"), "answer_value": F.lit(None).cast("double"), "source_status": F.lit("active"), "document_version": F.lit("v1")}
    return evidence.rewards(gold.withColumns(spec), markers=quality.REFUSALS, latest_version="v1")


@registered("SELECT event_id, max(CASE WHEN event_type = 'purchase' THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS purchase_before FROM events")
def last_purchase_before(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    got = evidence.nearest_before(e, key="user_id", order="event_id", value=F.when(F.col("event_type") == "purchase", F.col("event_id")))
    return got.select("event_id", F.col("_before").alias("purchase_before"))


@registered("SELECT lang, source, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY GROUPING SETS ((), (lang), (lang, source))")
def length_rollup(spark, sf_dir):
    return table(spark, sf_dir, "documents").rollup("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@registered("SELECT least(19, floor(20.0 * (n_chars - lo) / (hi - lo + 1)))::BIGINT AS bin, count(*) AS n FROM documents, (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM documents) GROUP BY ALL")
def length_histogram(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    ends = docs.agg(F.min("n_chars").alias("lo"), F.max("n_chars").alias("hi"))
    rows = docs.crossJoin(F.broadcast(ends))  # one row
    return rows.groupBy(F.least(F.lit(19), F.floor(20.0 * (F.col("n_chars") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1))).alias("bin")).agg(F.count("*").alias("n"))


@registered("SELECT quality, toxic, count(*) AS n, count(*) FILTER (length(text) < 500) AS n_short FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def label_agreement(spark, sf_dir):
    both = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return both.groupBy("quality", "toxic").agg(F.count("*").alias("n"), F.count_if(F.length("text") < 500).alias("n_short"))


@registered("SELECT n_nationkey AS ask_id, coalesce(min(CASE WHEN r_regionkey = n_nationkey THEN r_regionkey END), arg_min(r_regionkey, r_regionkey) FILTER (contains(lower(r_name), lower(left(n_name, 1))))) AS found FROM nation, region GROUP BY n_nationkey")
def question_lookup(spark, sf_dir):
    asked = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ask_id"), F.col("n_nationkey").alias("qa_id"), F.left("n_name", F.lit(1)).alias("question"))
    catalog = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("qa_id"), F.col("r_regionkey").alias("pos"), F.col("r_name").alias("question"))
    return lookup.resolve_questions(asked, catalog)


@registered("SELECT * FROM (VALUES ('uncovered', 'docs/a.png'), ('unused', 'old/*.bin')) AS t(kind, name)")
def ledger_gaps(spark, sf_dir):
    assets = spark.createDataFrame([("img/x.png",), ("img/sub/y.png",), ("docs/a.png",), ("data+1.csv",)], "path string")
    return lookup.ledger_gaps(assets, spark.createDataFrame([("img/*.png",), ("data+?.csv",), ("old/*.bin",)], "pattern string"))


@registered("SELECT * FROM (VALUES ('r', '/a/b', 1.5::DOUBLE, 1.5::DOUBLE, true), ('r', '/c/1', 3.0, 2.0, false), ('r', '/none', 1.0, NULL, false)) AS t(doc, pointer, claimed, found, ok)")
def claim_check(spark, sf_dir):
    docs = spark.createDataFrame([("r", '{"a": {"b": 1.5}, "c": [1, 2]}')], "doc string, body string")
    return lookup.check_claims([("r", "/a/b", 1.5), ("r", "/c/1", 3.0), ("r", "/none", 1.0)], docs)


SCALARS = (("abcdefgh ij", "<think>x</think> 정답: A: yes\nno", "a/b.JPG", "ok text"), ("abc", "plain", "x.bmp", "■■"), ("", "", "", "||| ### ***"))


@registered("SELECT * FROM (VALUES ('abcdef …', 'yes', 'jpeg', false), ('abc', 'plain', 'bmp', true), ('', '', 'png', true)) AS t(clipped, answer, subtype, noisy)")
def scalar_texts(spark, sf_dir):
    rows = spark.createDataFrame(SCALARS, "a string, b string, c string, d string")
    return rows.select(text.clip(F.col("a"), 6).alias("clipped"), text.after_thinking(F.col("b")).alias("answer"), text.image_subtype(F.col("c")).alias("subtype"), text.looks_ocr_noisy(F.col("d")).alias("noisy"))


@registered("SELECT i, v, d FROM (VALUES (0, 2.0::DOUBLE, DATE '2024-01-01'), (1, NULL, DATE '2024-03-01'), (2, 1.5, NULL)) AS t(i, v, d)")
def versions_and_dates(spark, sf_dir):
    rows = spark.createDataFrame([(0, "v2", "2024"), (1, "final", "2024-3"), (2, "rev1.5", "soon")], "i int, a string, b string")
    return rows.select("i", numbers.version_number(F.col("a")).alias("v"), numbers.partial_date(F.col("b")).alias("d"))
