"""Document fingerprints: invertible Bloom lookup sketches, in DataFrame expressions alone.

A text's paragraphs (newline-separated blocks, parted at those sentence ends whose last letter is among a fixed few;
what is still over LONG code points is parted at every sentence end, and what is over it then, behind words that end in
one of the same letters; all partings hang on the text beside them alone, so a change moves no other) are hashed to 40-bit digests; a digest with its 24-bit check value
is one 64-bit cell entry. A sketch of `blocks` blocks has ROWS x WIDTH cells a block; an entry is XORed into one cell of each row of
its block. Subtracting two sketches (XOR, cell by cell) leaves the entries that only one side has; a cell that holds a
single one is known by its check value, and peeling it out of its other cells uncovers more, until no cell is left:
the differing digests are recovered, and with the two sides' numbers of distinct paragraphs give the Jaccard likeness.
Where peeling leaves a block unclear, the pair is tried again with RETRY times the blocks and another salt, until none is.

Blocks for a pair are chosen by its sizes, so most pairs need no retry and a block's work is bounded; the printed
fingerprint is the first attempt's sketch folded to one block (XOR of blocks), of one size for all texts. It depends on
the text's paragraphs alone, not on how many blocks or attempts its pair took.

Sketches are built by one explode of digests and one aggregation within the partitioning that pairing each text with
the next has made: the texts are shuffled once and the sketches never.

Defined cases: a null text is empty and has no paragraph (likeness 1 to another such text); rows that share an id
follow each other by a hash of their texts; one row alone is its own next; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.llm.common import materialize

ROWS, WIDTH = 4, 12
CELLS = ROWS * WIDTH
#: Differing paragraphs that a block is meant to hold at most, on average: well under what CELLS can peel.
FILL = 10
ROUNDS = 7
RETRY = 4
CHECK_BITS = 24
PARTING = r"\n+|(?<=[c-hC-H][.!?])\x20"
LONG = 400
LONG_PARTING = r"(?<=[.!?])\x20|(?<=[。！？؟।])"
LONGER_PARTING = r"(?<=[c-h])\x20|(?<=[、，；：])"
#: A pair that is still unclear after so many sizes is an error (the chance is nil).
MOST_TRIES = 12
#: Rows to try again that are broadcast at most (about 60 bytes each, twice); beyond them the texts are joined by a shuffle.
MOST_BROADCAST = 200_000


def digests(text: Column) -> Column:
    """The distinct paragraphs' entries: digest in the upper 40 bits, check value in the lower 24."""
    def parted(parts: Column, pattern: str) -> Column:
        return F.flatten(F.transform(parts, lambda p: F.when(F.char_length(p) > LONG, F.split(p, pattern)).otherwise(F.array(p))))

    parts = F.filter(parted(parted(F.split(text, PARTING), LONG_PARTING), LONGER_PARTING), lambda p: F.length(F.trim(p)) > 0)
    return F.array_distinct(F.transform(parts, lambda p: _entry(F.shiftright(F.xxhash64(p), CHECK_BITS))))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(7)).bitwiseAND(F.lit((1 << CHECK_BITS) - 1))


def _entry(digest: Column) -> Column:
    return F.shiftleft(digest, CHECK_BITS).bitwiseOR(_check(digest))


def _is_entry(cell: Column) -> Column:
    return (cell != 0) & (_check(F.shiftright(cell, CHECK_BITS)) == cell.bitwiseAND(F.lit((1 << CHECK_BITS) - 1)))


def _places(entry: Column, salt: Column) -> Column:
    """A hash whose parts are an entry's block and its cell in each row."""
    return F.xxhash64(entry, salt)


def _block(places: Column, blocks: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(places, 36), blocks)


def _cell(places: Column, row: int) -> Column:
    return F.pmod(F.shiftright(places, 9 * row).bitwiseAND(F.lit(511)), F.lit(WIDTH)).cast("int") + row * WIDTH


def _let(value: Column, use) -> Column:
    """use(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def peeled(cells: Column, salt: Column) -> Column:
    """The entries that a block's difference holds, or null where peeling leaves a cell that isn't zero."""

    def without(cells: Column, alone: Column) -> Column:
        spots = F.transform(alone, lambda e: F.struct(e.alias("e"), *[_cell(_places(e, salt), r).alias(f"p{r}") for r in range(ROWS)]))
        hit = lambda k, s: reduce(lambda x, y: x | y, [k == s[f"p{r}"] for r in range(ROWS)])
        return F.aggregate(spots, cells, lambda acc, s: F.transform(acc, lambda c, k: F.when(hit(k, s), c.bitwiseXOR(s["e"])).otherwise(c)))

    def taken(state: Column, i: Column) -> Column:
        return _let(
            F.array_distinct(F.filter(state["cells"], _is_entry)),
            lambda alone: F.when(F.size(alone) == 0, state).otherwise(F.struct(without(state["cells"], alone).alias("cells"), F.concat(state["found"], alone).alias("found"))),
        )

    start = F.struct(cells.alias("cells"), F.array().cast("array<bigint>").alias("found"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, taken)
    return _let(end, lambda x: F.when(F.forall(x["cells"], lambda c: c == 0), x["found"]))


def _sketches(rows: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """rows (keys, blocks, e0, e1, e2: entry arrays) to (keys, block, s0, s1, s2: cells of each side)."""

    def tagged(side: int) -> Column:
        return F.transform(f"e{side}", lambda e: F.struct(F.lit(side).alias("side"), e.alias("e")))

    # An entry of no effect for each block, so that every block has a row.
    none = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.lit(-1).alias("side"), b.cast("long").alias("e")))
    flat = rows.select(*keys, "blocks", F.explode(F.concat(none, *map(tagged, range(3)))).alias("x")).select(*keys, "blocks", F.col("x.side").alias("side"), F.col("x.e").alias("e"))
    flat = flat.withColumn("places", _places(F.col("e"), salt))
    flat = flat.select(*keys, F.when(F.col("side") < 0, F.col("e")).otherwise(_block(F.col("places"), F.col("blocks"))).alias("block"), "side", "e", *[_cell(F.col("places"), r).alias(f"c{r}") for r in range(ROWS)])
    sums = [
        F.bit_xor(F.when((F.col("side") == side) & (F.col(f"c{k // WIDTH}") == k), F.col("e")).otherwise(F.lit(0).cast("long"))).alias(f"x{side}_{k}")
        for side in range(3)
        for k in range(CELLS)
    ]
    made = flat.groupBy(*keys, "block").agg(*sums)
    return made.select(*keys, "block", *[F.array(*[F.col(f"x{side}_{k}") for k in range(CELLS)]).alias(f"s{side}") for side in range(3)])


def _differences(sketched: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """(keys, d1, d2: recovered numbers of differing paragraphs, or null where a block isn't clear; fold0, fold1: the
    sketches of the text and the edited text, folded to one block)."""
    out = sketched
    for i in (1, 2):
        found = peeled(F.zip_with("s0", f"s{i}", lambda a, b: a.bitwiseXOR(b)), salt)
        out = out.withColumn(f"d{i}", _let(found, lambda x: F.when(x.isNotNull(), F.size(x))))
    whole = [F.when(F.count_if(F.col(f"d{i}").isNull()) == 0, F.sum(f"d{i}")).alias(f"d{i}") for i in (1, 2)]
    folds = [F.bit_xor(F.col(f"s{s}")[k]).alias(f"f{s}_{k}") for s in (0, 1) for k in range(CELLS)]
    got = out.groupBy(*keys).agg(*whole, *folds)
    return got.select(*keys, "d1", "d2", *[F.concat_ws("", *[F.lpad(F.lower(F.hex(f"f{s}_{k}")), 16, "0") for k in range(CELLS)]).alias(f"fold{s}") for s in (0, 1)])


def _pick(bounds: list, value: Column) -> Column:
    """How many of the ascending bounds are at most value: by a coarse and a fine step."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    coarse = F.array(*[F.lit(x) for x in bounds[::step]])
    fine = F.array(*[F.array(*[F.lit(x) for x in bounds[i : i + step]]) for i in range(0, len(bounds), step)])
    c = F.size(F.filter(coarse, lambda x: x <= value))
    return F.when(value.isNull() | (c == 0), F.lit(0)).otherwise((c - 1) * step + F.size(F.filter(fine[c - 1], lambda x: x <= value)))


def with_next(docs: DataFrame, *, id_col: str, text_col: str, bucket_rows: int = 2000, most_buckets: int = 16384) -> DataFrame:
    """(bucket, id, n, text, following): each row with the text of the next one in ascending order of id.

    Ids are cut into ranges of about bucket_rows by quantiles, a range is a window's partition, and the first row of
    each range is also dealt, as a guest, to the range before: no window over the whole table, one shuffle."""
    ids = docs.select(F.col(id_col).alias("id"))
    total = ids.count()
    k = max(1, min(most_buckets, total // bucket_rows))
    marks = ids.agg(F.percentile_approx("id", [i / k for i in range(1, k)], 10 * k + 10_000).alias("q")).first()["q"] if k > 1 else []
    bounds = sorted(set(marks or []))
    tie = F.xxhash64("text")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("bucket", _pick(bounds, F.col("id")).cast("int")).withColumn("tie", tie)
    firsts = docs.select(F.col(id_col).alias("id")).withColumn("bucket", _pick(bounds, F.col("id")).cast("int")).groupBy("bucket").agg(F.min("id").alias("id"), F.count_if(F.col("id").isNull()).alias("nulls")).orderBy("bucket").collect()  # a row for each bucket
    full = [r["bucket"] for r in firsts]
    before = {b: full[i - 1] for i, b in enumerate(full)}
    n = len(bounds) + 1
    first = {r["bucket"]: None if r["nulls"] else r["id"] for r in firsts}
    kind = docs.schema[id_col].dataType
    first_ids = F.array(*[F.lit(first.get(b)).cast(kind) for b in range(n)])
    hosts = F.array(*[F.lit(before.get(b, 0)) for b in range(n)])
    is_first = F.col("id").eqNullSafe(first_ids[F.col("bucket")])
    own = F.struct(F.col("bucket").alias("b"), F.lit(0).alias("guest"))
    dealt = rows.select("id", "text", "tie", F.explode(F.when(is_first, F.array(own, F.struct(hosts[F.col("bucket")].alias("b"), F.lit(1).alias("guest")))).otherwise(F.array(own))).alias("d"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("id").asc_nulls_first(), "tie")
    seen = dealt.select(F.col("d.b").alias("bucket"), F.col("d.guest").alias("guest"), "id", "text", "tie")
    after = [F.lead(c).over(order).alias(f"next_{c}") for c in ("id", "tie", "text")]
    return seen.select("bucket", "guest", "id", "tie", "text", *after, F.row_number().over(order).alias("n")).where("guest = 0").drop("guest")


KEYS = ["bucket", "n", "id", "tie", "next_id", "next_tie", "n_chars", "sha", "z0", "z1", "z2"]


def _sides(rows: DataFrame, times: int) -> DataFrame:
    """rows (text, next_text and what of KEYS tells them apart) to (KEYS, blocks, e0, e1, e2)."""
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    known = [c for c in KEYS if c in rows.columns]
    rows = rows.select(*known, F.unhex(F.sha2("edited", 256)).alias("sha"), *[digests(F.col(c)).alias(f"e{i}") for i, c in enumerate(("text", "edited", "next_text"))])
    rows = rows.select("*", *[F.size(f"e{i}").alias(f"z{i}") for i in range(3)])
    most = F.col("z0") + F.greatest("z1", "z2")
    return rows.withColumn("blocks", F.greatest(F.lit(1), F.ceil(most * (times / FILL)).cast("int")))


def _compare(rows: DataFrame, attempt: int) -> DataFrame:
    salt = F.lit(attempt)
    return _differences(_sketches(_sides(rows, RETRY**attempt), KEYS, salt), KEYS, salt)


def _texts_of(left: DataFrame, texts: DataFrame, *, small: bool) -> DataFrame:
    """left with text and next_text, both fetched in one pass over texts; where left is small it is sent to the texts'
    tasks, so that only its own texts are shuffled."""
    keys = ["bucket", "n", "id", "tie", "next_id", "next_tie"]
    wanted = left.select(*keys, F.explode(F.array(*[F.struct(F.lit(role).alias("role"), F.col(i).alias("i"), F.col(t).alias("t")) for role, i, t in (("text", "id", "tie"), ("next", "next_id", "next_tie"))])).alias("w"))
    wanted = wanted.select(*keys, "w.role", F.col("w.i").alias("_id"), F.col("w.t").alias("_tie"))
    wanted = F.broadcast(wanted) if small else wanted
    met = texts.withColumnsRenamed({"id": "_i", "tie": "_t"}).join(wanted, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_tie")))
    return met.groupBy(*keys).agg(F.max(F.when(F.col("role") == "text", F.col("text"))).alias("text"), F.max(F.when(F.col("role") == "next", F.col("text"))).alias("next_text"))


def fingerprint_versions(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: the text, its edited text (the last half of its code points replaced by as many of the next
    text's first) and the next text are sketched, and the first is compared with the others.

    (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_paragraphs, n_changed)"""
    got = materialize(_compare(with_next(docs, id_col=id_col, text_col=text_col), 0), "sketches-0")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    done = []
    first = got.select("bucket", "n", "fold0", "fold1")
    for attempt in range(1, MOST_TRIES + 1):
        unclear = F.col("d1").isNull() | F.col("d2").isNull()
        done.append(got.where(~unclear))
        left = materialize(got.where(unclear).select("bucket", "n", "id", "tie", "next_id", "next_tie"), f"unclear-{attempt}")
        n_left = left.count()
        if not n_left:
            break
        if attempt == MOST_TRIES:
            raise RuntimeError("sketches that no size makes clear")
        left = _texts_of(left, texts, small=n_left <= MOST_BROADCAST)
        again = _compare(left, attempt).drop("fold0", "fold1")
        got = materialize(again.join(first, ["bucket", "n"]), f"sketches-{attempt}")
    every = reduce(DataFrame.unionByName, done)

    def likeness(other: str, d: str) -> Column:
        both = F.col("z0") + F.col(other)
        return F.when(both == 0, F.lit(1.0)).otherwise((both - F.col(d)) / (both + F.col(d)))

    return every.select(
        F.col("id").alias(id_col),
        "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"),
        F.col("fold0").alias("fingerprint"),
        F.col("fold1").alias("edited_fingerprint"),
        likeness("z1", "d1").alias("near_edited"),
        likeness("z2", "d2").alias("near_next"),
        F.col("z0").cast("long").alias("n_paragraphs"),
        F.col("d1").alias("n_changed"),
    )
