"""Personal identifiers: patterns, checks of mechanical fakeness, detection with overlaps resolved, redaction."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.functions.numbers import birth_number_ok, luhn_ok

# Patterns in order of redaction, priorities where spans overlap, mail domains that are nobody's.
PATTERNS = {
    "rrn": r"\b(\d{6})-(\d{7})\b",
    "phone": r"\b01[016789]-?\d{3,4}-?\d{4}\b",
    "card": r"\b(?:\d{4}[- ]?){3}\d{4}\b",
    "account": r"\b\d{2,6}-\d{2,6}-\d{2,7}\b",
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
}
PRIORITY = ("rrn", "card", "phone", "email", "account")
NOBODYS_DOMAINS = ("example.com", "example.org", "example.net")

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("value", T.StringType())]))


@F.pandas_udf(SPANS)
def _spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    compiled = [(k, re.compile(PATTERNS[k])) for k in PRIORITY]
    for batch in texts:
        out = []
        for text in batch:
            kept: list[tuple] = []
            for kind, pattern in compiled if isinstance(text, str) else ():
                # Matches of one kind never overlap, so kinds in order of priority settle every overlap.
                new = [m for m in pattern.finditer(text) if not any(m.start() < e and s < m.end() for _, s, e, _ in kept)]
                kept += [(kind, *m.span(), m[0]) for m in new]
            out.append([dict(zip(("kind", "start", "end", "value"), x, strict=True)) for x in sorted(kept, key=lambda x: x[1])])
        yield pd.Series(out)


def mechanically_fake(kind: Column, value: Column) -> Column:
    """Whether an identifier can be nobody's by its form alone."""
    digits = F.regexp_replace(value, r"\D", "")
    zeros = F.length(F.regexp_replace(F.replace(value, F.lit("-"), F.lit("")), "[^0]", ""))
    low = F.lower(value)
    mail = [F.endswith(low, F.lit(sep + d)) for d in NOBODYS_DOMAINS for sep in "@."]
    return (
        F.when(kind == "email", F.greatest(*mail))
        .when(kind == "card", ~luhn_ok(value))
        .when(kind == "rrn", ~birth_number_ok(F.substring(value, 1, 6)))
        .when(kind == "phone", F.contains(digits, F.lit("55501")) | F.endswith(digits, F.lit("0000000")) | F.contains(digits, F.lit("00000000")))
        .when(kind == "account", zeros >= F.greatest(F.lit(4), F.length(F.replace(value, F.lit("-"), F.lit(""))) - 2))
        .otherwise(F.lit(False))
    )


def detect(text: Column) -> Column:
    """Hits by place: array of (kind, start, end, value, fake)."""
    return F.transform(_spans(text), lambda h: F.struct(h["kind"].alias("kind"), h["start"].alias("start"), h["end"].alias("end"), h["value"].alias("value"), mechanically_fake(h["kind"], h["value"]).alias("fake")))


def values_of(text: Column, kind: str) -> Column:
    """All matches of one kind, in the JVM: for counts where overlaps between kinds don't matter."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({_java(PATTERNS[kind])})"), 1)


def has_real(text: Column) -> Column:
    return F.exists(detect(text), lambda h: ~h["fake"])


def redact(text: Column) -> Column:
    """Each kind's matches replaced by its mark, kind by kind."""
    out = F.coalesce(text, F.lit(""))
    for kind, pattern in PATTERNS.items():
        out = F.regexp_replace(out, _java(pattern), f"[REDACTED_{kind.upper()}]")
    return out


def _java(pattern: str) -> str:
    return "(?U)" + pattern
