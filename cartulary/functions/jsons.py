"""JSON: model responses, canonical text, pointers."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIRS = "array<struct<QUESTION:string,ANSWER:string>>"


def parse_pairs(response: Column) -> Column:
    """Pairs from a response: a fenced block if there is one, commas before a closing bracket dropped, an array, one
    object, or objects one after another; an empty array where none can be read."""
    fenced = F.regexp_extract(response, r"(?s)```(?:json)?\s*(.*?)```", 1)
    body = F.regexp_replace(F.trim(F.when(fenced != "", fenced).otherwise(response)), r",\s*([\]}])", "$1")
    array = F.regexp_extract(body, r"(?s)(\[.*\])", 1)
    objects = F.regexp_replace(F.regexp_extract(body, r"(?s)(\{.*\})", 1), r"\}\s*,?\s*\{", "},{")
    read = lambda x: F.from_json(x, PAIRS)
    got = F.coalesce(F.when(array != "", read(array)), F.when(objects != "", read(F.concat(F.lit("["), objects, F.lit("]")))))
    filled = F.filter(got, lambda p: p.isNotNull() & (p["QUESTION"].isNotNull() | p["ANSWER"].isNotNull()))
    return F.coalesce(filled, F.array().cast(PAIRS))


def pointer_value(document: Column, pointer: str) -> Column:
    """The value at a JSON pointer, as text. A part of digits is an array's index or, where there is no array, a key."""
    parts = [p.replace("~1", "/").replace("~0", "~") for p in pointer.split("/")[1:]]
    steps = [(f"[{p}]", f"['{p}']") if p.isdigit() else (f"['{p}']",) for p in parts]
    return F.coalesce(*[F.get_json_object(document, "$" + "".join(path)) for path in product(*steps)])
