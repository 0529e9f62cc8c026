"""Trust scan: lines of text files that hold mail addresses, keys or an evaluation on training data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds, patterns, and what a match of the pattern must not be (addresses of example domains are made up).
PATTERNS = {
    "email": (r"([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})", r"@(?:[A-Za-z0-9-]+\.)*example\.(?:com|org|net)$"),
    "api_key": (r"\b(sk-[A-Za-z0-9]{20,}|AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36})\b", None),
    "aws_secret": (r"(?i:aws_secret_access_key)[\"']?\s*[:=]\s*[\"']([A-Za-z0-9/+=]{40})[\"']", None),
    "train_eval_leak": (r"(train_dataset\s*=\s*\w+\s*,.*\beval_dataset\s*=\s*(?:dataset|train\w*)\b)", None),
}


def findings(kind: str, line: Column) -> Column:
    pattern, but = PATTERNS[kind]
    found = F.regexp_extract_all(line, F.lit(pattern), 1)
    return F.filter(found, lambda x: ~F.regexp_like(x, F.lit(but))) if but else found


def scan_lines(files: DataFrame) -> DataFrame:
    """(path, line, kind, value) of files (path, text); lines are counted from 1."""
    lines = files.select("path", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\r?\n")).alias("at", "l"))
    tagged = lambda k: F.transform(findings(k, F.col("l")), lambda v: F.struct(F.lit(k).alias("kind"), v.alias("value")))
    found = F.concat(*map(tagged, PATTERNS))
    return lines.select("path", (F.col("at") + 1).alias("line"), F.explode(found).alias("f")).select("path", "line", "f.kind", "f.value")
