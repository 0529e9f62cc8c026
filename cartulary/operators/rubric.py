"""The rubric's first layer: format, register, first person and leading questions; strict and lenient passes; aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.functions.text import ends_in_bieup, final_hangul_words

# Fixed values of the rubric.
HONORIFIC_ENDS = ("요", "죠")
FORMAL_ENDS = ("니다", "니까")
FIRST_PERSON = ("나는", "내가", "나의", "나도", "나를", "나에게", "내게", "우리", "제가")
THIRD_PERSON = ("그는", "그가", "그녀는", "그녀가", "그 사람은", "그 사람이", "그들은", "그들이")
LEADING = (
    r"가장\s*.{0,12}(순간|기억|경험|일|때|무엇)",
    r"무엇을\s*깨달",
    r"어떤\s*(교훈|의미|가르침|깨달음)",
    r"삶의\s*(의미|본질|지침|목표|가치|교훈)",
    r"인생.{0,4}(의미|본질|교훈|가르침)",
    r"느꼈던\s*가장",
    r"어떤\s*마음가짐",
)
STRICT = ("format", "register", "first_person", "grounded", "coherent", "voice_preserved", "q_grounded")
LENIENT = ("format", "register", "grounded", "coherent")


def _any(x: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(x, F.lit(p)) for p in parts])


def honorific(word: Column) -> Column:
    """a polite ending, or a formal one after a syllable that ends in bieup."""
    polite = reduce(lambda a, b: a | b, [F.endswith(word, F.lit(e)) for e in HONORIFIC_ENDS])
    formal = [F.endswith(word, F.lit(e)) & (F.length(word) > len(e)) & ends_in_bieup(F.substring(word, F.lit(1), F.length(word) - len(e))) for e in FORMAL_ENDS]
    return polite | reduce(lambda a, b: a | b, formal)


def layer_one(pairs: DataFrame, *, order: str = "pos", min_question: int = 6, min_answer: int = 4) -> DataFrame:
    """Pairs (question, answer, and an order column) with format_ok, register_ok, first_person_ok,
    first_person_warn and leading_warn. A repeat is a pair that an earlier pair of allowed lengths has."""
    q, a = F.coalesce("question", F.lit("")), F.coalesce("answer", F.lit(""))
    sized = (F.length(q) >= min_question) & (F.length(a) >= min_answer)
    first = pairs.where(sized).groupBy("question", "answer").agg(F.min(order).alias("_first"))
    rows = pairs.join(first.select(F.col("question").alias("_q"), F.col("answer").alias("_a"), "_first"), (F.col("question") == F.col("_q")) & (F.col("answer") == F.col("_a")), "left").drop("_q", "_a")
    told, third = _any(a, FIRST_PERSON), _any(a, THIRD_PERSON)
    return rows.withColumns(
        {
            "format_ok": sized & F.coalesce(F.col(order) == F.col("_first"), F.lit(False)),
            "register_ok": ~F.exists(final_hangul_words(a), honorific),
            "first_person_ok": told | ~third,
            "first_person_warn": ~told & ~third,
            "leading_warn": F.regexp_like(q, F.lit("(?U)" + "|".join(f"(?:{p})" for p in LEADING))),
        }
    ).drop("_first")


def passes(dims: tuple[str, ...]) -> Column:
    """Every dimension checked and passed; a column <dim>_ok that is null wasn't checked."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(f"{d}_ok"), F.lit(False)) for d in dims])


def aggregate(scored: DataFrame, dims: tuple[str, ...] = STRICT, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts and rates (0.0 without rows) of strict and lenient passes and failures of each dimension."""
    have = [d for d in dims if f"{d}_ok" in scored.columns]
    rate = lambda c: F.coalesce(F.avg(c.cast("double")), F.lit(0.0))
    strict, lenient = passes(tuple(have)), passes(tuple(d for d in LENIENT if d in have))
    return scored.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(strict).alias("n_strict"), F.count_if(lenient).alias("n_lenient"), rate(strict).alias("strict_rate"), rate(lenient).alias("lenient_rate"), *[F.count_if(~F.col(f"{d}_ok")).alias(f"fail_{d}") for d in have])


def with_chunk(scored: DataFrame, *, order: str, per_chunk: int) -> DataFrame:
    """chunk = position // per_chunk, where order is a 0-based position."""
    return scored.withColumn("chunk", F.floor(F.col(order) / per_chunk).cast("long"))


def run_range(runs: DataFrame, key: str, by: tuple[str, ...]) -> DataFrame:
    """Least, greatest and mean of a rate over runs."""
    return runs.groupBy(*by).agg(F.min(key).alias("min"), F.max(key).alias("max"), F.avg(key).alias("mean"))


def split_clean(scored: DataFrame, dims: tuple[str, ...] = STRICT) -> tuple[DataFrame, DataFrame]:
    """K3: (clean, rejected with _failed_dims and _reject_reasons: a map of those with a <dim>_reason)."""
    have = [d for d in dims if f"{d}_ok" in scored.columns]
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(F.col(f"{d}_ok"), F.lit(False)), F.lit(d)) for d in have]))
    named = [F.when(~F.coalesce(F.col(f"{d}_ok"), F.lit(False)), F.struct(F.lit(d).alias("key"), F.col(f"{d}_reason").cast("string").alias("value"))) for d in have if f"{d}_reason" in scored.columns]
    reasons = F.map_from_entries(F.array_compact(F.array(*named))) if named else F.create_map().cast("map<string,string>")
    marked = scored.withColumns({"_failed_dims": failed, "_reject_reasons": reasons})
    return marked.where(F.size("_failed_dims") == 0).drop("_failed_dims", "_reject_reasons"), marked.where(F.size("_failed_dims") > 0)


def nth_first(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    return rows.withColumn("n", F.row_number().over(Window.partitionBy(*key).orderBy(order)))
