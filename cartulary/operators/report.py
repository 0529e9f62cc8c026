"""Reports: constraints, dominance, recommendation, percentiles, serving roll-ups, seed aggregates, sweeps, diffs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.tables import materialize

EPSILON = 1e-9
NOTHING_FEASIBLE = "no_feasible_candidate"


def check_constraints(candidates: DataFrame, constraints: dict[str, dict], *, id_col: str = "id") -> DataFrame:
    """Candidates with unmet and undecidable (arrays of fields) and feasible. constraints: field -> min, max, or
    drop_max with drop_baseline, a candidate's id; what isn't measured (null) can't be decided."""
    baselines = {(c["drop_baseline"], f) for f, c in constraints.items() if "drop_max" in c}
    base = {}
    if baselines:
        ids = sorted({i for i, _ in baselines})
        rows = candidates.where(F.col(id_col).isin(*ids)).select(id_col, *[f for f, c in constraints.items() if "drop_max" in c]).collect()  # a row for each named baseline
        base = {(r[id_col], f): r[f] for r in rows for _, f in baselines if f in r}
    unmet, unknown = [], []
    for field, c in constraints.items():
        x = F.col(field).cast("double")
        bad = F.lit(False)
        open_ = x.isNull()
        if "max" in c:
            bad = bad | (x > c["max"] + EPSILON)
        if "min" in c:
            bad = bad | (x < c["min"] - EPSILON)
        if "drop_max" in c:
            b = base.get((c["drop_baseline"], field))
            open_ = open_ | F.lit(b is None)
            if b is not None:
                bad = bad | (F.lit(float(b)) - x > c["drop_max"] + EPSILON)
        unmet.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(field)))
        unknown.append(F.when(open_, F.lit(field)))
    out = candidates.withColumns({"unmet": F.array_compact(F.array(*unmet)), "undecidable": F.array_compact(F.array(*unknown))})
    return out.withColumn("feasible", (F.size("unmet") == 0) & (F.size("undecidable") == 0))


def pareto_frontier(candidates: DataFrame, objectives: dict[str, str], *, id_col: str = "id") -> DataFrame:
    """Candidates that no other dominates; objectives: field -> max or min; unmeasured ones are skipped.

    With two measured objectives a sort does it: see frontier_2d for tables of any size. This form compares each
    candidate with the distinct values of all others and is for tables that a report holds."""
    a, b = candidates.alias("a"), candidates.alias("b")
    worse, better = [], []
    for field, way in objectives.items():
        x, y = (F.col(f"a.{field}").cast("double"), F.col(f"b.{field}").cast("double"))
        if way == "min":
            x, y = -x, -y
        worse.append(F.coalesce(y < x - EPSILON, F.lit(False)))
        better.append(F.coalesce(y > x + EPSILON, F.lit(False)))
    dominated = ~reduce(lambda p, q: p | q, worse) & reduce(lambda p, q: p | q, better) & (F.col(f"a.{id_col}") != F.col(f"b.{id_col}"))
    return a.join(b, dominated, "left_anti")


def frontier_2d(rows: DataFrame, *, least: str, most: str) -> DataFrame:
    """The rows that no other dominates when `least` is to be small and `most` large (both measured): values of least
    with their greatest most (summed in tasks), then a running maximum over those by ranges of `least`."""
    best = rows.groupBy(least).agg(F.max(most).alias("_m"))
    ranged = materialize(best.repartitionByRange(least).withColumn("_p", F.spark_partition_id()), "ranged")  # ranges are drawn once
    within = Window.partitionBy("_p").orderBy(least).rowsBetween(Window.unboundedPreceding, -1)
    tops = sorted((r["_p"], r["m"]) for r in ranged.groupBy("_p").agg(F.max("_m").alias("m")).collect())  # a number for each partition
    before, top = {}, None
    for p, m in tops:
        before[p] = top
        top = m if top is None else max(top, m)
    earlier = F.create_map(*[x for p, m in before.items() for x in (F.lit(p), F.lit(m).cast("double"))])[F.col("_p")] if before else F.lit(None).cast("double")
    ahead = F.greatest(F.max("_m").over(within).cast("double"), earlier)
    front = ranged.withColumn("_ahead", ahead).where(F.col("_ahead").isNull() | (F.col("_m") > F.col("_ahead"))).select(least, F.col("_m").alias(most))
    return rows.join(front, [least, most], "left_semi")


def recommend(checked: DataFrame, *, objective: str, way: str = "max", id_col: str = "id") -> DataFrame:
    """One row: the feasible candidate of the best objective (unmeasured ones last, ties by id), or a sentinel."""
    x = F.col(objective).cast("double") * (-1.0 if way == "min" else 1.0)
    ranked = checked.where("feasible").select(F.struct(F.coalesce(x, F.lit(float("-inf"))).alias("x"), F.col(id_col).alias("id")).alias("r"))
    best = ranked.agg(F.max("r.x").alias("x"))
    picked = ranked.crossJoin(F.broadcast(best)).where(F.col("r.x") == F.col("x")).agg(F.min("r.id").alias("id"))  # best is one row
    return picked.select(F.coalesce(F.col("id").cast("string"), F.lit(NOTHING_FEASIBLE)).alias("recommendation"))


def nearest_rank(rows: DataFrame, value: str, qs: tuple[float, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """One row a group with n and p<q>: the value at round-half-even(q * (n - 1)) in order.

    Values are counted first (in tasks), and the place is found in running counts of distinct values, so a group's
    values are never gathered."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("c"))
    keys = list(by)
    order = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    run = counts.withColumns({"hi": F.sum("c").over(order.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)), "n": F.sum("c").over(order)})
    place = lambda q: F.bround(F.lit(q) * (F.col("n") - 1), 0).cast("long") + 1
    picks = [F.max(F.when((F.col("hi") >= place(q)) & (F.col("hi") - F.col("c") < place(q)), F.col(value))).alias(f"p{round(q * 100)}") for q in qs]
    return run.groupBy(*keys).agg(F.max("n").alias("n"), *picks)


def serving_rollup(requests: DataFrame, *, sla_ttft: float, sla_e2e: float, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts, tokens and goodput over completed requests (ok, tokens, ttft, e2e)."""
    good = F.col("ok") & (F.col("ttft") <= sla_ttft) & (F.col("e2e") <= sla_e2e)
    return requests.groupBy(*by).agg(F.count("*").alias("n"), F.count_if("ok").alias("completed"), F.sum(F.when(F.col("ok"), F.col("tokens"))).cast("long").alias("tokens"), F.try_divide(F.count_if(good), F.count_if("ok")).alias("goodput"))


def length_stats(rows: DataFrame, column: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean, least, most and n of a length."""
    return rows.groupBy(*by).agg(F.avg(column).alias("mean"), F.min(column).alias("least"), F.max(column).alias("most"), F.count(column).alias("n"))


def seed_aggregate(rows: DataFrame, metrics: tuple[str, ...], by: tuple[str, ...]) -> DataFrame:
    """Mean, population deviation and n of each metric over runs; NaN and null left out."""
    clean = lambda c: F.when(~F.isnan(c), F.col(c))
    return rows.groupBy(*by).agg(*[f(clean(m)).alias(f"{m}_{n}") for m in metrics for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("n", F.count))])


def crossover(a: DataFrame, b: DataFrame, *, batch: str = "batch", speed: str = "tok_per_s") -> DataFrame:
    """The least batch at which a's speed is over b's."""
    both = a.select(batch, F.col(speed).alias("_a")).join(b.select(batch, F.col(speed).alias("_b")), batch)
    return both.where("_a > _b").agg(F.min(batch).alias("crossover_batch"))


def pointer_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """(pointer, left, right) of pointers whose values differ or that one side lacks; a, b: (pointer, value)."""
    both = a.select("pointer", F.col("value").alias("left"), F.lit(True).alias("_l")).join(b.select("pointer", F.col("value").alias("right"), F.lit(True).alias("_r")), "pointer", "full")
    return both.where(F.col("_l").isNull() | F.col("_r").isNull() | ~F.col("left").eqNullSafe(F.col("right"))).select("pointer", "left", "right")


def wins(ratio: Column) -> Column:
    return F.when(ratio >= 1, "a").otherwise("b")
