"""Retrieval: a corpus kept by first id, BM25 and lexical ranking, recall.

Queries are taken a block at a time (QUERIES_AT_ONCE at most, so what is sent to the tasks is bounded), and a block is a
matrix of terms by queries. A corpus is read once for each block: a row's counts of the block's terms are kept as a
narrow table; scores are the product of a few rows' weights with the matrix, of which each task keeps the k best of each
query; the best of all tasks' are the result. No posting is ever shuffled, and no query's elements meet in one task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.functions.text import norm_answer, norm_index
from cartulary.tables import materialize

K1, B = 1.5, 0.75
LEAST_IDF = 1e-6
#: Queries whose terms are one matrix, and rows that are scored at once.
QUERIES_AT_ONCE, ROWS_AT_ONCE = 2000, 256


def corpus_of(rows: DataFrame, *, id_col: str, order: str) -> DataFrame:
    """The first row of each id; null and empty ids go."""
    filled = rows.where(F.col(id_col).isNotNull() & (F.col(id_col).cast("string") != ""))
    first = Window.partitionBy(id_col).orderBy(order)
    return filled.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def bigram_tokens(text: str) -> Counter:
    """Words of a normalised text and bigrams of its characters without spaces, counted."""
    bare = text.replace(" ", "")
    return Counter([w for w in text.split(" ") if w]) + Counter(map("".join, zip(bare, bare[1:], strict=False)))


def word_levels(text: str) -> Counter:
    """(word, i) for each i-th time that a word stands in a normalised text: shared ones are the bags' intersection."""
    return Counter((w, i) for w, n in Counter(x for x in text.split(" ") if x).items() for i in range(n))


def _counted(corpus: DataFrame, terms: dict, tokens: Callable[[str], Counter]) -> DataFrame:
    """(element_id, n_tokens, at, tf): counts of those tokens that are terms, by their numbers. Narrow."""
    schema = T.StructType([corpus.schema["element_id"], T.StructField("n_tokens", T.LongType()), T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.IntegerType()))])
    sent = corpus.sparkSession.sparkContext.broadcast(terms)  # of QUERIES_AT_ONCE queries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                b = batch.slice(first, ROWS_AT_ONCE)
                n, at, tf = [], [], []
                for text in b.column("text").to_pylist():
                    counts = tokens(text or "")
                    met = counts.keys() & known.keys()
                    n.append(counts.total())
                    at.append([known[x] for x in met])
                    tf.append([counts[x] for x in met])
                kind = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([b.column("element_id"), pa.array(n, pa.int64()), pa.array(at, kind), pa.array(tf, kind)], names=["element_id", "n_tokens", "at", "tf"])

    return corpus.mapInArrow(run, schema)


def _best(counted: DataFrame, queries: list, matrix: np.ndarray, weigh: Callable, k: int, query_type: T.DataType) -> DataFrame:
    """(query_id, element_id, score): each task's k best of each query, by weigh(tf: rows x terms, n_tokens) @ matrix."""
    element = counted.schema["element_id"]
    schema = T.StructType([T.StructField("query_id", query_type), element, T.StructField("score", T.DoubleType())])
    sent = counted.sparkSession.sparkContext.broadcast((queries, matrix))  # of QUERIES_AT_ONCE queries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        ids, m = sent.value
        best: list[list[tuple]] = [[] for _ in ids]
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                b = batch.slice(first, ROWS_AT_ONCE)
                tf = np.zeros((b.num_rows, len(m)))
                rows = np.repeat(np.arange(b.num_rows), b.column("at").value_lengths().to_numpy())
                tf[rows, b.column("at").flatten().to_numpy()] = b.column("tf").flatten().to_numpy()
                # Sums in another order differ in their last digits; elements that only so differ are tied.
                scores = weigh(tf, b.column("n_tokens").to_numpy().astype(float)) @ m
                names = b.column("element_id").to_pylist()
                rounded = np.round(scores, 9)
                least = np.sort(rounded, axis=0)[-k:][0]
                for q in np.flatnonzero((scores > 0).any(axis=0)).tolist():
                    near = np.flatnonzero((rounded[:, q] >= least[q]) & (scores[:, q] > 0))
                    held = best[q] + [(-rounded[i, q], str(names[i]), names[i], scores[i, q]) for i in near.tolist()]
                    best[q] = sorted(held, key=lambda x: x[:2])[:k]
        flat = [(ids[q], x[2], float(x[3])) for q, held in enumerate(best) for x in held]
        arrow = to_arrow_schema(schema)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in flat], f.type) for i, f in enumerate(arrow)], schema=arrow)

    return counted.mapInArrow(run, schema)


def _search(corpus: DataFrame, queries: DataFrame, tokens: Callable[[str], Counter], weigher: Callable, k: int) -> DataFrame:
    """Top k of each query; weigher(counted, terms) gives weigh(tf, n_tokens). corpus: (element_id, text), queries:
    (query_id, text), normalised."""
    blocks = max(1, -(-queries.count() // (QUERIES_AT_ONCE // 2)))
    kind = queries.schema["query_id"].dataType
    found = None
    for block in range(blocks):
        asked = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).collect()  # about half of QUERIES_AT_ONCE
        terms: dict = {}
        counts = [tokens(r["text"] or "") for r in asked]
        for x in counts:
            for t in x:
                terms.setdefault(t, len(terms))
        matrix = np.zeros((len(terms), len(asked)))
        for q, x in enumerate(counts):
            matrix[[terms[t] for t in x], q] = 1.0
        counted = materialize(_counted(corpus, terms, tokens), "term-counts")
        got = _best(counted, [r["query_id"] for r in asked], matrix, weigher(counted, len(terms)), k, kind)
        found = got if found is None else found.unionByName(got)
    return _top(found, k)


def bm25(corpus: DataFrame, queries: DataFrame, *, k: int = 5, corpus_id: str = "element_id", corpus_text: str = "text", query_id: str = "query_id", query_text: str = "question", compose: bool = True) -> DataFrame:
    """(query_id, element_id, score, rank) of the k best elements of each query; scores over 0 only, ties by id.

    A query's tokens count once each; an element without tokens counts in the number of elements and in no other sum."""

    def weigher(counted: DataFrame, n_terms: int) -> Callable:
        sizes = counted.agg(F.count("*").alias("n"), F.avg("n_tokens").alias("mean")).first()
        met = dict(counted.select(F.explode("at").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect())  # a row for each term at most
        df = np.array([met.get(t, 0) for t in range(n_terms)], dtype=float)
        mean = sizes["mean"] or 1.0
        idf = np.maximum(np.log(1 + (sizes["n"] - df + 0.5) / (df + 0.5)), LEAST_IDF)
        return lambda tf, n: idf * (tf * (K1 + 1)) / (tf + K1 * (1 - B + B * n / mean)[:, None])

    pick = lambda d, i, t, name: d.select(F.col(i).alias(name), norm_index(F.col(t), compose=compose).alias("text"))
    return _search(pick(corpus, corpus_id, corpus_text, "element_id"), pick(queries, query_id, query_text, "query_id"), bigram_tokens, weigher, k)


def lexical(corpus: DataFrame, queries: DataFrame, *, k: int = 5, corpus_id: str = "element_id", corpus_text: str = "text", query_id: str = "query_id", query_text: str = "question", compose: bool = True) -> DataFrame:
    """Shared words (as bags) over the root of the element's words; the k best with any, ties by id as text."""

    def weigher(counted: DataFrame, n_terms: int) -> Callable:
        return lambda tf, n: tf / np.sqrt(np.maximum(n, 1.0))[:, None]

    pick = lambda d, i, t, name: d.select(F.col(i).alias(name), norm_answer(F.col(t), compose=compose).alias("text"))
    return _search(pick(corpus, corpus_id, corpus_text, "element_id"), pick(queries, query_id, query_text, "query_id"), word_levels, weigher, k)


def _top(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), F.col("element_id").cast("string"))
    return scored.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < k)


def recall_at_k(gold: Column, retrieved: Column, k: int) -> Column:
    """Null without gold ids, else the share of gold ids among the first k retrieved."""
    wanted = F.array_distinct(F.filter(gold, lambda g: g.isNotNull() & (g.cast("string") != "")))
    return F.when(F.size(wanted) > 0, F.size(F.array_intersect(wanted, F.slice(retrieved, 1, k))) / F.size(wanted))
