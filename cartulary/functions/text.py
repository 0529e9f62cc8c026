"""Text expressions: strips, keys, normalisers, tokens, set and bag measures.

All take and give Columns and stay in the JVM, but for NFKC, which Spark has no function for (an Arrow UDF).
Classes are Unicode-aware ((?U)), so Hangul and accented letters are letters.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Marks deleted from answers (N3) or made spaces before indexing (N4), and those of the older scorer.
ANSWER_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~·…“”‘’「」『』()"
INDEX_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~·…“”‘’「」『』（）"
BRACKET_MARKS = "'\"《》<>〈〉()‘’“”[]「」『』"
ASCII_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def escaped(marks: str) -> str:
    """The marks as a regular expression's class."""
    return "[" + "".join("\\" + c if c.isascii() else c for c in dict.fromkeys(marks)) + "]"


def let(value: Column, use) -> Column:
    """use(value) with value evaluated once: what a lambda refers to is else evaluated for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


#: Characters of the Unicode property White_Space (fixed values).
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(WHITE))


def collapse(x: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(x, r"(?U)\s+", " "))


@F.pandas_udf(T.StringType())
def nfkc(x: pd.Series) -> pd.Series:
    return x.str.normalize("NFKC")


@F.pandas_udf(T.ArrayType(T.StringType()))
def nfkc_all(x: pd.Series) -> pd.Series:
    """Of an array's texts: a lambda can't hold a Python function."""
    return x.map(lambda a: [None if v is None else unicodedata.normalize("NFKC", v) for v in a], na_action="ignore")


def composed_quotes(items: Column, composed: Column) -> Column:
    """An array of structs with its quotes replaced by those of nfkc_all, a column of its own."""
    return F.transform(items, lambda e, i: e.withField("quote", F.get(composed, i)))


def first_filled(*columns: Column) -> Column:
    """The first that isn't blank, stripped; '' if none."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in columns], F.lit(""))


def norm_key(x: Column) -> Column:
    """Lower case, runs of marks and white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(x), r"(?U)\W+", " "))


def norm_quote(x: Column, *, compose: bool = True) -> Column:
    """NFKC (unless the caller knows that the text has no compatibility characters), collapsed."""
    x = F.coalesce(x, F.lit(""))
    return collapse(nfkc(x) if compose else x)


def norm_answer(x: Column, *, compose: bool = True) -> Column:
    """NFKC, marks deleted, collapsed, lower case."""
    x = F.coalesce(x, F.lit(""))
    return F.lower(collapse(F.regexp_replace(nfkc(x) if compose else x, escaped(ANSWER_MARKS), "")))


def norm_index(x: Column, *, compose: bool = True) -> Column:
    """NFKC, marks as spaces, collapsed, lower case."""
    x = F.coalesce(x, F.lit(""))
    return F.lower(collapse(F.regexp_replace(nfkc(x) if compose else x, escaped(INDEX_MARKS), " ")))


def norm_demo(x: Column, *, compose: bool = True) -> Column:
    """NFKC, everything but letters, digits and underscores as spaces, collapsed, lower case."""
    x = F.coalesce(x, F.lit(""))
    return F.lower(collapse(F.regexp_replace(nfkc(x) if compose else x, r"(?U)[^\w]", " ")))


def norm_korquad(x: Column) -> Column:
    """Brackets and quotes as spaces, lower case, ASCII marks deleted, collapsed."""
    x = F.lower(F.regexp_replace(F.coalesce(x, F.lit("")), escaped(BRACKET_MARKS), " "))
    return collapse(F.regexp_replace(x, escaped(ASCII_MARKS), ""))


def quote_sha256(x: Column, *, compose: bool = True) -> Column:
    return F.sha2(norm_quote(x, compose=compose), 256)


def word_set(x: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(r"(?U)(\w+)"), 1))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets (arrays): 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def char_bigram_tokens(x: Column) -> Column:
    """Words of a text in N4, then bigrams of its characters without spaces; repeats kept."""

    def pairs(chars: Column) -> Column:
        n = F.greatest(F.size(chars) - 1, F.lit(0))
        return F.zip_with(F.slice(chars, F.lit(1), n), F.slice(chars, F.lit(2), n), lambda a, b: F.concat(a, b))

    return let(x, lambda y: F.concat(F.filter(F.split(y, " "), lambda w: w != ""), let(char_bag(y), pairs)))


def char_bag(x: Column) -> Column:
    """The characters of a normalised text without spaces."""
    return F.filter(F.split(F.replace(x, F.lit(" "), F.lit("")), ""), lambda c: c != "")


def _common(a: Column, b: Column) -> Column:
    """The size of two bags' intersection."""
    count = lambda bag, c: F.size(F.filter(bag, lambda y: y == c))
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda s, c: s + F.least(count(a, c), count(b, c)))


def bag_f1(a: Column, b: Column) -> Column:
    """F1 of two bags: both empty 1, one empty 0."""

    def f1(p: Column) -> Column:
        n, x, y = _common(p["a"], p["b"]).cast("double"), F.size(p["a"]), F.size(p["b"])
        return F.when((x == 0) & (y == 0), F.lit(1.0)).when((x == 0) | (y == 0), F.lit(0.0)).otherwise(let(n, lambda k: F.when(k == 0, F.lit(0.0)).otherwise(2 * (k / x) * (k / y) / (k / x + k / y))))

    return let(F.struct(a.alias("a"), b.alias("b")), f1)


def char_f1(prediction: Column, gold: Column, *, normaliser=norm_answer, **options) -> Column:
    return bag_f1(char_bag(normaliser(prediction, **options)), char_bag(normaliser(gold, **options)))


def exact_match(prediction: Column, gold: Column, *, normaliser=norm_answer, **options) -> Column:
    return (normaliser(prediction, **options) == normaliser(gold, **options)).cast("double")


def final_hangul_words(x: Column) -> Column:
    """The Hangul word that ends each sentence, quoted spans left out."""
    bare = F.regexp_replace(x, "\"[^\"]*\"|'[^']*'|“[^”]*”|‘[^’]*’|「[^」]*」|『[^』]*』", " ")
    ends = F.transform(F.split(bare, r"[.!?…\n]+"), lambda s: F.regexp_extract(strip(s), "([가-힣]+)$", 1))
    return F.filter(ends, lambda w: w != "")


def ends_in_bieup(word: Column) -> Column:
    """Whether the last syllable's final consonant is bieup (alone or with siot)."""
    code = F.ascii(F.right(word, F.lit(1)))
    return F.when((code >= 44032) & (code <= 55203), ((code - 44032) % 28).isin(17, 18)).otherwise(F.lit(False))


def clip(x: Column, limit: int) -> Column:
    """F16: the stripped text, or its first limit characters, a space and an ellipsis."""
    end = lambda y: F.regexp_replace(F.substring(y, 1, limit), r"(?U)\s+$", "")
    return let(strip(x), lambda y: F.when(F.length(y) <= limit, y).otherwise(F.concat(end(y), F.lit(" …"))))


def looks_ocr_noisy(x: Column) -> Column:
    """Replacement characters, boxes, runs of bars or underscores; or eight characters and more, over 0.4 of them junk."""
    junk = F.length(F.regexp_replace(x, r"(?U)[\p{L}\p{N}\s.,%()\-]", ""))
    noisy = F.regexp_like(x, F.lit(r"[\x{FFFD}\x{25A0}-\x{25FF}\x{2400}-\x{243F}]|[|]{2,}|_{3,}"))
    return F.coalesce(x != "", F.lit(False)) & (noisy | ((F.length(x) >= 8) & (junk / F.length(x) > 0.4)))


def after_thinking(x: Column, leads: tuple[str, ...] = ("답:", "정답:", "답변:", "[답]", "답)", "A:")) -> Column:
    """What follows the last </think>, leads taken off one after another, first line, stripped."""
    out = strip(F.substring_index(x, "</think>", -1))
    for lead in leads:
        out = F.when(F.startswith(out, F.lit(lead)), strip(F.substring(out, F.lit(len(lead) + 1), F.length(out)))).otherwise(out)
    return strip(F.split(out, "\n")[0])


def image_subtype(path: Column) -> Column:
    """by the file's ending; png where it says nothing."""
    end = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return F.when(end.isin("jpg", "jpeg"), "jpeg").when(end.isin("gif", "bmp"), end).otherwise("png")
