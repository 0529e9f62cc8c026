"""Numbers, dates, units, versions, checks and costs in texts and records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartulary.functions.text import collapse

# What counts as a number, date or unit in quotes and in answers.
EVIDENCE_NUMBER = r"\d[\d,\.]*"
EVIDENCE_DATE = r"\d{4}\s*년|\d{1,2}\s*월|\d{1,2}\s*일|\d{4}-\d{2}-\d{2}"
ANSWER_NUMBER = r"-?\d[\d,]*(?:\.\d+)?"
ANSWER_DATE = r"\d{4}\s*[-./년]\s*\d{1,2}\s*[-./월]?\s*\d{0,2}\s*일?|\d{4}년|\d{1,2}월|\d{1,2}일"
ANSWER_UNIT = r"%|퍼센트|원|억\s*원|만\s*원|천\s*원|년|월|일|건|명|개"


def _all(x: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(f"(?U)({pattern})"), 1)


def evidence_numbers(x: Column) -> Column:
    return F.transform(_all(x, EVIDENCE_NUMBER), lambda n: F.regexp_replace(F.replace(n, F.lit(","), F.lit("")), r"\.+$", ""))


def evidence_dates(x: Column) -> Column:
    return F.transform(_all(x, EVIDENCE_DATE), collapse)


def groundable(x: Column) -> Column:
    """Numbers, then dates, that an answer should take from its sources."""
    return F.concat(evidence_numbers(x), evidence_dates(x))


def answer_numbers(x: Column) -> Column:
    return F.transform(_all(x, ANSWER_NUMBER), lambda n: F.replace(n, F.lit(","), F.lit("")))


def answer_dates(x: Column) -> Column:
    return F.transform(_all(x, ANSWER_DATE), lambda d: F.regexp_replace(d, r"(?U)\s+", ""))


def answer_units(x: Column) -> Column:
    return F.transform(_all(x, ANSWER_UNIT), lambda u: F.regexp_replace(u, r"(?U)\s+", ""))


def all_in(gold: Column, predicted: Column) -> Column:
    """M4: null where gold has none, else whether all of gold's are among the predicted."""
    return F.when(F.size(gold) > 0, F.size(F.array_except(gold, predicted)) == 0)


def version_number(x: Column) -> Column:
    """The first number in a version's name; null sorts as the least."""
    return F.nullif(F.regexp_extract(x, r"(\d+(?:\.\d+)?)", 1), F.lit("")).cast("double")


def partial_date(x: Column) -> Column:
    """YYYY, YYYY-MM or YYYY-MM-DD, missing parts as 1; null where it is none."""
    s = F.trim(x)
    part = lambda i: F.regexp_extract(s, r"^(\d{4})(?:-(\d{1,2}))?(?:-(\d{1,2}))?$", i)
    two = lambda i: F.lpad(F.when(part(i) == "", "1").otherwise(part(i)), 2, "0")
    return F.when(part(1) != "", F.try_to_date(F.concat_ws("-", part(1), two(2), two(3)), "yyyy-MM-dd"))


def luhn_ok(x: Column) -> Column:
    digits = F.regexp_replace(x, r"\D", "")
    return (F.length(digits) >= 12) & F.call_function("luhn_check", digits)


def birth_number_ok(six: Column) -> Column:
    """Whether YYMMDD is a date of the 1900s or the 2000s."""
    return F.try_to_date(F.concat(F.lit("19"), six), "yyyyMMdd").isNotNull() | F.try_to_date(F.concat(F.lit("20"), six), "yyyyMMdd").isNotNull()


def computed(op: Column, operands: Column) -> Column:
    """sum, difference, product, ratio or percent of an array of doubles; null for others and for division by zero."""
    plus = F.aggregate(operands, F.lit(0.0), lambda a, x: a + x)
    times = F.aggregate(operands, F.lit(1.0), lambda a, x: a * x)
    first, second = F.get(operands, F.lit(0)), F.get(operands, F.lit(1))
    return F.when(op == "sum", plus).when(op == "difference", first - (plus - first)).when(op == "product", times).when(op == "ratio", F.try_divide(first, second)).when(op == "percent", F.try_divide(100.0 * first, second))


def close_to(value: Column, expected: Column, tolerance: float = 0.01) -> Column:
    return F.abs(value - expected) <= F.greatest(F.lit(tolerance), 1e-4 * F.abs(expected))


def cost(units: dict[str, Column], rates: dict[str, float]) -> Column:
    """The sum of units times their rates, to 6 places."""
    return F.round(sum((F.coalesce(units[k], F.lit(0)) * F.lit(float(rates[k])) for k in units if k in rates), F.lit(0.0)), 6)
