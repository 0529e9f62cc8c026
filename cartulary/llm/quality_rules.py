"""Quality rules: fixed base rules, then robust multivariate outliers.

Each text gives a vector of transformed, length-free statistics. Per language and source, location and scatter are
estimated by the minimum covariance determinant: from a start by medians, concentration steps keep the share
`support` of rows with the least Mahalanobis distance and estimate again, until the determinant no longer falls. To be
inverted the scatter gets a ridge of RIDGE of the group's own standard deviation, squared, on its diagonal. A text
whose squared robust distance is over `cutoff` is rejected; by default the cutoff is a group's own: a far quantile
that its median and upper quartile of distances set, and no less than that of chi-square.

Every concentration step is one pass over the small table of vectors, pre-aggregated to one row of sums for each
group and distance bin, so a group with a third of all rows costs its tasks no more than any other; only sums reach
the shuffle. Groups of fewer than `min_group` rows are pooled within their language, and those still small together.

Defined cases: a null text has no words (it fails the base rules); a null language or source is a group of its own;
equal rows get equal verdicts; an empty table gives an empty table; columns other than those named are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.llm.common import materialize, record_batch, slices, texts_of

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: The vector's statistics.
FEATURES = ("word_length", "symbols", "dup_lines", "repeats", "capitals", "marks", "digits")
#: What is added to the scatter to invert it: this share of the group's standard deviation, and an absolute least for
#: statistics that are constant.
RIDGE, LEAST = 0.01, 1e-6
#: Concentration steps end by themselves; this only bounds them.
STEPS = 60
P = len(FEATURES)
#: A text is an outlier beyond this quantile of its group's distances, as their quartiles set it.
OUTLIER_SHARE = 0.99999
CAPITALS = re.compile(r"[A-Z]")
MARKS = re.compile(r"[!?.,;:]")
DIGITS = re.compile(r"[0-9]")
BINS_PER_OCTAVE, LOW_OCTAVE, HIGH_OCTAVE = 16, -8, 24


def measure(text: str) -> tuple[tuple[int, int, int, int, int], tuple[float, ...]]:
    """((n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), vector) of a whole text."""
    words = text.encode("utf-8").split()  # at \x20 and \x09-\x0D alone
    n = len(words)
    spaces = sum(text.count(c) for c in " \t\n\r\x0b\x0c")
    chars = len(text) - spaces
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    dup = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeats = 0
    if len(set(windows)) < len(windows):
        seen, end = Counter(windows), 0
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeats += i + 3 - max(i, end)
                end = i + 3
    m = max(chars, 1)
    capitals, marks, digits = (len(x.findall(text)) for x in (CAPITALS, MARKS, DIGITS))
    # Shares are drawn towards a usual value by a few made-up observations, so that short texts vary no more than long ones.
    vector = (
        np.log((chars + 250.0) / (n + 50.0)),
        np.log((symbols + 1.0) / (m + 500.0) + 0.004),
        np.log((dup + 0.1) / (len(lines) + 10.0) + 0.05),
        np.log((repeats + 0.5) / (n + 50.0) + 0.05),
        np.log((capitals + 10.0) / (m + 500.0) + 0.01),
        np.log((marks + 15.0) / (m + 500.0) + 0.01),
        np.log((digits + 1.0) / (m + 500.0) + 0.01),
    )
    return (n, chars, symbols, dup, repeats), tuple(float(x) for x in vector)


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def statistics_table(docs: DataFrame, *, id_col: str, text_col: str, group_cols: tuple[str, ...]) -> DataFrame:
    """Narrow: a row of counts and the vector for each row of docs; no text leaves its task."""
    schema = T.StructType(
        [docs.schema[id_col]]
        + [T.StructField(f"g{i}", T.StringType()) for i in range(len(group_cols))]
        + [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        + [T.StructField("base_failed", T.BooleanType())]
        + [T.StructField(f"x{i}", T.DoubleType()) for i in range(P)]
    )
    frame = docs.select(id_col, text_col, *[F.col(c).cast("string").alias(f"g{i}") for i, c in enumerate(group_cols)])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in slices(batches):
            got = [measure(t) for t in texts_of(batch, text_col)]
            out = {id_col: batch.column(id_col)} | {f"g{i}": batch.column(f"g{i}") for i in range(len(group_cols))}
            for j, c in enumerate(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")):
                out[c] = [x[0][j] for x in got]
            out["base_failed"] = [base_failed(x[0][0], x[0][4]) for x in got]
            for j in range(P):
                out[f"x{j}"] = [x[1][j] for x in got]
            yield record_batch(arrow, out)

    return frame.mapInArrow(run, schema)


def _distance():
    """Squared Mahalanobis distance of a row's vector from the centre m under the inverse scatter w (row-major)."""
    d = [F.col(f"x{i}") - F.col("m")[i] for i in range(P)]
    return sum((F.col("w")[i * P + j] * d[i] * d[j] * (1.0 if i == j else 2.0) for i in range(P) for j in range(i, P)), F.lit(0.0))


def _bin(d2):
    low, high = BINS_PER_OCTAVE * LOW_OCTAVE, BINS_PER_OCTAVE * HIGH_OCTAVE
    return F.least(F.greatest(F.floor(F.log2(F.greatest(d2, F.lit(1e-9))) * BINS_PER_OCTAVE), F.lit(low)), F.lit(high)).cast("int")


def _estimate(support: float):
    """For applyInPandas over one group's bins (at most 513 rows): centre and inverse scatter from the nearest bins, or
    those of the step before, and done, if the determinant does not fall."""

    consistent = consistency(support)

    def run(key, bins):
        import pandas as pd

        bins = bins.sort_values("bin")
        n = bins["n"].to_numpy(dtype="float64")
        total = n.sum()
        upto = int(np.searchsorted(np.cumsum(n), support * total)) + 1
        near = bins.iloc[:upto]
        k = near["n"].sum()
        old = np.array(bins["m"].iloc[0])
        shift = np.array([near[f"s{i}"].sum() for i in range(P)]) / k
        cov = np.empty((P, P))
        for i in range(P):
            for j in range(i, P):
                cov[i, j] = cov[j, i] = near[f"s{i}_{j}"].sum() / k - shift[i] * shift[j]
        first, ridge = bins.iloc[0], np.array(bins["ridge"].iloc[0])
        det = float(np.linalg.slogdet(cov + np.diag(ridge))[1])
        if det >= first["det"] - 1e-9:
            return pd.DataFrame({"g": [key[0]], "m": [old.tolist()], "w": [list(first["w"])], "ridge": [ridge.tolist()], "det": [first["det"]], "done": [True]})
        inverse = np.linalg.inv(cov * consistent + np.diag(ridge))
        return pd.DataFrame({"g": [key[0]], "m": [(old + shift).tolist()], "w": [inverse.ravel().tolist()], "ridge": [ridge.tolist()], "det": [det], "done": [False]})

    return run


def consistency(support: float) -> float:
    """What the scatter of the nearest `support` of a normal sample is multiplied by to be the whole sample's."""
    return support / _chi2_cdf(chi2_quantile(support, P), P + 2)


def chi2_quantile(share: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        q = (low + high) / 2
        low, high = (q, high) if _chi2_cdf(q, k) < share else (low, q)
    return q


def _chi2_cdf(x: float, k: int) -> float:
    a, z = k / 2.0, x / 2.0
    if z <= 0:
        return 0.0
    term = total = 1.0 / a
    for n in range(1, 500):
        term *= z / (a + n)
        total += term
        if term < 1e-14 * total:
            break
    return total * math.exp(-z + a * math.log(z) - math.lgamma(a))


def robust_outliers(stats: DataFrame, *, groups: int, support: float = 0.75, steps: int = STEPS, min_group: int = 500) -> DataFrame:
    """stats with d2, each row's squared robust distance within its group, and the group's cutoff (both null where no
    group could be fitted). stats should be a materialised table."""
    names = [f"g{i}" for i in range(groups)]
    fit = stats.where(~F.col("base_failed"))
    sizes = fit.groupBy(*names).count()
    first = sizes.groupBy(names[0]).agg(F.sum(F.when(F.col("count") < min_group, F.col("count"))).alias("rest"))
    key = lambda *cols: F.to_json(F.array(*cols))
    keys = sizes.alias("a").join(first.alias("b"), F.col(f"a.{names[0]}").eqNullSafe(F.col(f"b.{names[0]}"))).select(
        *[F.col(f"a.{n}").alias(n) for n in names],
        F.when(F.col("count") >= min_group, key(*[F.col(f"a.{n}") for n in names])).when(F.col("rest") >= min_group, key(F.col(f"a.{names[0]}"))).otherwise(F.lit("[]")).alias("g"),
    )
    keys = materialize(keys, "quality-groups")
    tag = stats.join(keys.withColumnsRenamed({n: f"k_{n}" for n in names}), on=[stats[n].eqNullSafe(F.col(f"k_{n}")) for n in names], how="left").drop(*[f"k_{n}" for n in names])
    tag = tag.withColumn("g", F.coalesce("g", F.lit("[]")))
    medians = tag.where(~F.col("base_failed")).groupBy("g").agg(
        *[F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 2000).alias(f"q{i}") for i in range(P)],
        F.array(*[F.pow(F.stddev_pop(f"x{i}") * RIDGE, 2) + LEAST**2 for i in range(P)]).alias("ridge"),
    )
    spread = [F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) + F.col("ridge")[i] for i in range(P)]
    start = medians.select(
        "g",
        F.array(*[F.col(f"q{i}")[1] for i in range(P)]).alias("m"),
        F.array(*[1.0 / spread[i] if i == j else F.lit(0.0) for i in range(P) for j in range(P)]).alias("w"),
        "ridge",
        F.lit(math.inf).alias("det"),
        F.lit(False).alias("done"),
    )
    model = materialize(start, "quality-start")
    for step in range(steps):
        rows = tag.where(~F.col("base_failed")).join(model.where(~F.col("done")), "g")
        d = [F.col(f"x{i}") - F.col("m")[i] for i in range(P)]
        bins = rows.withColumn("bin", _bin(_distance())).groupBy("g", "bin").agg(
            F.count("*").alias("n"),
            *[F.sum(d[i]).alias(f"s{i}") for i in range(P)],
            *[F.sum(d[i] * d[j]).alias(f"s{i}_{j}") for i in range(P) for j in range(i, P)],
        )
        bins = bins.join(model.drop("done"), "g")
        moved = bins.groupBy("g").applyInPandas(_estimate(support), "g string, m array<double>, w array<double>, ridge array<double>, det double, done boolean")
        model = materialize(moved.unionByName(model.where("done")), f"quality-step{step}")
        if model.where(~F.col("done")).isEmpty():
            break
    near = tag.where(~F.col("base_failed")).join(model, "g").select("g", _distance().alias("d2"))
    quartiles = near.groupBy("g").agg(F.percentile_approx("d2", [0.5, 0.75], 2000).alias("q"))
    # Cube roots of chi-square variables are nearly normal, so their median and upper quartile give any quantile.
    middle, upper = F.cbrt(F.col("q")[0]), F.cbrt(F.col("q")[1])
    far = F.pow(middle + (upper - middle) * (NormalDist().inv_cdf(OUTLIER_SHARE) / NormalDist().inv_cdf(0.75)), 3)
    model = materialize(model.join(quartiles.select("g", F.greatest(far, F.lit(chi2_quantile(OUTLIER_SHARE, P))).alias("cutoff")), "g"), "quality-cutoffs")
    return tag.join(model, "g", "left").withColumn("d2", F.when(F.col("m").isNotNull(), _distance())).drop("m", "w", "g", "ridge", "det", "done")


def quality_verdicts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source"), cutoff: float | None = None, support: float = 0.75, steps: int = STEPS, min_group: int = 500
) -> DataFrame:
    """One row per row of docs: id, counts, base_failed, d2 (null where no group could be fitted) and kept."""
    stats = materialize(statistics_table(docs, id_col=id_col, text_col=text_col, group_cols=group_cols), "quality-stats")
    scored = robust_outliers(stats, groups=len(group_cols), support=support, steps=steps, min_group=min_group)
    limit = F.col("cutoff") if cutoff is None else F.lit(cutoff)
    return scored.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= limit, F.lit(True))).drop("cutoff")
