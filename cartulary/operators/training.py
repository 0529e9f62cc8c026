"""Training rows: chat formatting, message rows, instruction rows, masks, seeded splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.text import strip


def format_chat(messages: Column) -> Column:
    """struct(prompt, completion) of an array of (role, content): a system header, turns, and the last message as
    completion if the assistant says it."""
    n = F.size(messages)
    system = F.element_at(F.transform(F.filter(messages, lambda m: m["role"] == "system"), lambda m: F.coalesce(m["content"], F.lit(""))), F.lit(-1))
    system = F.when(F.size(F.filter(messages, lambda m: m["role"] == "system")) > 0, system).otherwise(F.lit(""))

    def turn(m: Column, i: Column) -> Column:
        said = F.coalesce(m["content"], F.lit(""))
        return F.when(m["role"] == "user", F.concat(F.lit("<|user|>\n"), said)).when((m["role"] == "assistant") & (i < n - 1), F.concat(F.lit("<|assistant|>\n"), said))

    turns = F.concat_ws("\n", F.array_compact(F.transform(messages, turn)))
    header = F.when(system != "", F.concat(F.lit("<|system|>\n"), system, F.lit("\n"))).otherwise(F.lit(""))
    last = F.element_at(messages, -1)
    completion = F.when((n > 0) & (last["role"] == "assistant"), F.coalesce(last["content"], F.lit(""))).otherwise(F.lit(""))
    return F.struct(F.concat(header, turns, F.lit("\n<|assistant|>\n")).alias("prompt"), completion.alias("completion"))


def conversations_to_chat(turns: DataFrame, *, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """(conv_id, prompt, completion, n_messages) from one row a turn. A conversation is gathered: it is a prompt."""
    whole = turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, "role", F.col("text").alias("content")))).alias("m"))
    return whole.select(key, F.size("m").alias("n_messages"), format_chat(F.col("m")).alias("c")).select(key, "c.prompt", "c.completion", "n_messages")


def message_rows(records: DataFrame, *, system: str, answerable_only: bool = True) -> DataFrame:
    """(qa_id, messages): system, context and question, answer; of records with all of context, question and
    answer, answerable ones unless told otherwise."""
    text = {c: strip(F.coalesce(c, F.lit(""))) for c in ("context", "question", "answer")}
    rows = records.withColumns(text).where("context <> '' and question <> '' and answer <> ''")
    rows = rows.where(F.coalesce("answerable", F.lit(True))) if answerable_only else rows
    asked = F.concat(F.lit("[문맥]\n"), "context", F.lit("\n\n[질문]\n"), "question")
    said = (("system", F.lit(system)), ("user", asked), ("assistant", F.col("answer")))
    return rows.select("qa_id", F.array(*[F.struct(F.lit(role).alias("role"), c.alias("content")) for role, c in said]).alias("messages"))


def sft_rows(records: DataFrame, *, system: str, heading: str = "[근거]") -> DataFrame:
    """K4: (qa_id, category, messages): system, question with its evidence under a heading (an unanswerable question stands
    alone), answer."""
    quotes = F.array_join(F.transform("evidence", lambda e: F.coalesce(e["quote"], F.lit(""))), " ")
    asked = F.when(F.coalesce("answerable", F.lit(True)), F.concat("question", F.lit(f"\n\n{heading}\n"), F.coalesce(quotes, F.lit("")))).otherwise(F.col("question"))
    said = (("system", F.lit(system)), ("user", asked), ("assistant", F.col("answer")))
    return records.select("qa_id", "category", F.array(*[F.struct(F.lit(role).alias("role"), c.alias("content")) for role, c in said]).alias("messages"))


def write_export(parted: DataFrame, path: str, *, system: str) -> None:
    """K4: parted records (part: active, archive, held) as three folders of JSON lines: training rows of the active ones,
    the others as they are."""
    sft_rows(parted.where("part = 'active'"), system=system).write.mode("errorifexists").json(f"{path}/train_sft")
    for part, folder in (("archive", "versioned_archive"), ("held", "held_for_review")):
        parted.where(F.col("part") == part).drop("part").write.mode("errorifexists").json(f"{path}/{folder}")


def seeded_slice(rows: DataFrame, key: str, n: int, *, seed: int = 42, skip: int = 0) -> DataFrame:
    """N rows of an order that a hash of key and seed gives, after the first `skip`: the same rows wherever they lie.
    Tasks keep their own first skip + n rows; those of all tasks meet in one place."""
    order = [F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.col(key)]
    return rows.orderBy(*order).offset(skip).limit(n) if skip else rows.orderBy(*order).limit(n)


def instruction_rows(records: DataFrame) -> DataFrame:
    """K5: (instruction, input, output)."""
    return records.select(F.col("question").alias("instruction"), F.coalesce("context", F.lit("")).alias("input"), F.col("answer").alias("output"))


def masked_labels(prompt_ids: Column, completion_ids: Column, end_id: int, limit: int) -> Column:
    """struct(input_ids, labels): -100 under the prompt, cut at the end, at least one label left."""
    ids = F.slice(F.concat(prompt_ids, completion_ids, F.array(F.lit(end_id))), 1, limit)
    labels = F.slice(F.concat(F.transform(prompt_ids, lambda _: F.lit(-100)), completion_ids, F.array(F.lit(end_id))), 1, limit)
    none = F.forall(labels, lambda x: x == -100)
    return F.struct(ids.alias("input_ids"), F.when(none, F.concat(F.slice(labels, F.lit(1), F.size(labels) - 1), F.array(F.element_at(ids, -1)))).otherwise(labels).alias("labels"))


def seeded_split(rows: DataFrame, key: str, *, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Rows with split, train or test, by a hash of key and seed: the same for a key wherever it lies."""
    return rows.withColumn("split", F.when(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000)) < round(10_000 * test_share), "test").otherwise("train"))
