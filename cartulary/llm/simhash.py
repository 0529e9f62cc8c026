"""SimHash near-duplicates with pivot distance tables.

1. Each whole text gives a 64-bit fingerprint (narrow pass). Equal fingerprints are folded to one row before anything
   is shuffled, so a group of exact copies costs one row for each task.
2. Pairs can only lie in a common bucket. For a few bits (`exact_bands`) the 64 bits are cut into `blocks` parts, and
   two fingerprints at most `max_bits` apart agree on all bits of blocks - max_bits of the parts (pigeonhole), so one
   row for each such choice of parts brings every linked pair together, exactly. For texts at a Jaccard similarity of
   0.8 and more (`shingle_bands`) a row's keys are the first fifth of its distinct shingles and one more, in one order
   for all rows: two such sets always share one of these (prefix filter). The order puts shingles that are frequent by
   a table of counts of fixed size last; it changes the work, not the result.
3. Within buckets, the table of distances to `pivots` reference fingerprints discards a pair whose largest coordinate
   difference is over max_bits (triangle inequality, so never a linked pair); survivors are verified bit by bit.
   A bucket of over `block_rows` fingerprints is cut into blocks of that many, and every pair of blocks is a task's
   group of its own: memory stays bounded and no bucket falls to a single task.
4. A group gives the edges of a spanning forest of its links, never all pairs; components come from hooking and
   pointer jumping over those edges, each round written to the shared folder.
5. `similar_texts` takes the bits as a sieve alone, wide enough for pairs at 0.8 (39 of 256 bits expected, deviation 6,
   sieve 72). Components of what passes get their shingle sets once, and links are those whose exact Jaccard similarity
   is 0.8 or more (`verified_edges`); components of over `block_rows` texts are cut into pairs of blocks as above.

Defined cases: a null or blank text has fingerprint zero and links like any other; repeated ids keep a row each; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.llm.common import materialize, slices, texts_of

SEED = 42
#: Pivots and cuts of the 64 bits; what they are changes the work, not the result.
PIVOTS = 16
BLOCK_ROWS = 4096
PAIRS_AT_ONCE = 1 << 20
#: Size of the table of shingle counts (a power of two); what it is changes the work, not the result.
LEVEL_SLOTS = 1 << 18


def shingle_bytes(text: str, words: int) -> list[bytes]:
    """Space-joined runs of so many words of the text, A-Z lower-cased; all words where there are fewer."""
    parts = text.encode("utf-8").lower().split()
    if not parts:
        return []
    if len(parts) <= words:
        return [b" ".join(parts)]
    joined = b" ".join(parts)
    ends = list(itertools.accumulate(len(p) + 1 for p in parts))
    starts = [0, *ends]
    return [joined[a : b - 1] for a, b in zip(starts, ends[words - 1 :], strict=False)]


def fingerprint(text: str, words: int = 4, seeds: tuple[int, ...] = (SEED,), distinct: bool = False) -> tuple[int, ...]:
    """64 bits for each seed; of each shingle as often as it stands in the text, or once."""
    grams = shingle_bytes(text, words)
    grams = list(dict.fromkeys(grams)) if distinct else grams
    out, digest = [], xxhash.xxh64_intdigest
    for seed in seeds:
        total = np.zeros(64, dtype=np.int64)
        for at in range(0, len(grams), 8192):
            hashes = np.array([digest(g, seed) for g in grams[at : at + 8192]], dtype="<u8")
            total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * total > len(grams), bitorder="little").view("<u8")[0]))
    return tuple(out)


def fingerprints(docs: DataFrame, *, words: int = 4, seeds: tuple[int, ...] = (SEED,), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): fp is an array of signed 64-bit integers, one for each seed."""
    schema = T.StructType([docs.schema[id_col], T.StructField("fp", T.ArrayType(T.LongType(), False))])

    def run(batches):
        for b in slices(batches):
            fps = np.array([fingerprint(t, words, seeds) for t in texts_of(b, text_col)], dtype=np.uint64).reshape(-1, len(seeds))
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(fps.view(np.int64).tolist(), pa.list_(pa.field("element", pa.int64(), False)))], names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints (rows x words)."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int16)


def pivot_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Rows x pivots: Hamming distances."""
    return np.stack([differing(fps, p) for p in pivots], axis=1)


def reference_fingerprints(n: int = PIVOTS, words: int = 1) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 64, (n, words), dtype=np.uint64)


class Forest:
    """Union-find over the rows of one group."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def spanning_links(fps: np.ndarray, max_bits: int, pivots: np.ndarray) -> list[tuple[int, int]]:
    """Index pairs that span every component of the group's links. Breadth first: a row that has been reached is
    compared with the rows that have not, by the pivot table first and by all bits then."""
    n = len(fps)
    table = pivot_table(fps, pivots)
    order = np.argsort(table[:, 0], kind="stable")
    out: list[tuple[int, int]] = []
    left = order
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            keys = table[left, 0]
            lo, hi = np.searchsorted(keys, table[x, 0] - max_bits), np.searchsorted(keys, table[x, 0] + max_bits, "right")
            near = left[lo:hi]
            near = near[np.abs(table[near] - table[x]).max(axis=1) <= max_bits] if len(near) else near
            near = near[differing(fps[near], fps[x]) <= max_bits] if len(near) else near
            if len(near):
                out += [(x, int(y)) for y in near]
                queue += near.tolist()
                taken = np.zeros(n, bool)
                taken[near] = True
                left = left[~taken[left]]
    return out


def _links_of_groups(fps: np.ndarray, ends: np.ndarray, max_bits: int, pivots: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning links of many groups that lie one after another; small groups are compared together, lag by lag."""
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    for s, e in zip(starts[sizes > 64], ends[sizes > 64], strict=True):
        if links := spanning_links(fps[s:e], max_bits, pivots):
            got = np.array(links) + s
            yield got[:, 0], got[:, 1]
    keep = np.repeat(sizes <= 64, sizes)
    index = np.flatnonzero(keep)
    group = np.repeat(np.arange(len(sizes)), sizes)[keep]
    small = fps[keep]
    found: list[np.ndarray] = []
    for lag in range(1, int(sizes[sizes <= 64].max(initial=1))):
        i = np.flatnonzero(group[lag:] == group[:-lag])
        for at in range(0, len(i), PAIRS_AT_ONCE):
            a = i[at : at + PAIRS_AT_ONCE]
            for p in pivots:  # pivot by pivot, so that most pairs are gone after a few
                if not len(a):
                    break
                a = a[np.abs(differing(small[a], p) - differing(small[a + lag], p)) <= max_bits]
            a = a[differing(small[a], small[a + lag]) <= max_bits]
            if len(a):
                found.append(np.stack([a, a + lag]))
    if found:
        pairs = np.concatenate(found, axis=1)
        forest = {}
        for i, j in pairs.T.tolist():
            g = forest.setdefault(int(group[i]), {})
            a, b = i, j
            while g.get(a, a) != a:
                a = g[a]
            while g.get(b, b) != b:
                b = g[b]
            if a != b:
                g[max(a, b)] = min(a, b)
                yield index[[i]], index[[j]]


def exact_bands(nodes: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """(node, choice, key) of 64-bit fingerprints: the bits of each choice of blocks - max_bits of the blocks."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    keys = []
    for k, choice in enumerate(itertools.combinations(range(blocks), blocks - max_bits)):
        mask = sum(masks[c] for c in choice)
        keys.append(F.struct(F.lit(k).alias("choice"), F.col("fp")[0].bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("key")))
    return nodes.select("node", F.inline(F.array(*keys)))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    return np.unique(np.array([xxhash.xxh64_intdigest(g, SEED) for g in shingle_bytes(text, words)], dtype=np.uint64))


def set_node(hashes: np.ndarray) -> int:
    """A signed 64-bit integer that is equal for equal sets."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def set_prints(docs: DataFrame, *, words: int, seeds: tuple[int, ...], id_col: str, text_col: str) -> DataFrame:
    """(id, fp, node): the fingerprint of the distinct shingles, and the node that stands for their set."""
    schema = T.StructType([docs.schema[id_col], T.StructField("fp", T.ArrayType(T.LongType(), False)), T.StructField("node", T.LongType())])

    def run(batches):
        for b in slices(batches):
            texts = texts_of(b, text_col)
            fps = np.array([fingerprint(t, words, seeds, distinct=True) for t in texts], dtype=np.uint64).reshape(-1, len(seeds))
            fps = pa.array(fps.view(np.int64).tolist(), pa.list_(pa.field("element", pa.int64(), False)))
            yield pa.RecordBatch.from_arrays([b.column(id_col), fps, pa.array([set_node(shingle_set(t, words)) for t in texts], pa.int64())], names=[id_col, "fp", "node"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def shingle_levels(docs: DataFrame, *, words: int, text_col: str) -> np.ndarray:
    """For each of LEVEL_SLOTS values of the low bits of a shingle's hash: the octave of how many rows hold one."""

    def run(batches):
        counts = np.zeros(LEVEL_SLOTS, dtype=np.int64)
        for b in slices(batches):
            for t in texts_of(b, text_col):
                np.add.at(counts, (shingle_set(t, words) & np.uint64(LEVEL_SLOTS - 1)).astype(np.int64), 1)
        slot = np.flatnonzero(counts)
        for at in range(0, len(slot), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(slot[at : at + (1 << 16)]), pa.array(counts[slot[at : at + (1 << 16)]])], names=["slot", "n"])

    got = docs.select(text_col).mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    levels = np.zeros(LEVEL_SLOTS, dtype=np.uint8)
    levels[got.column("slot").to_numpy()] = 2 * np.log2(1 + got.column("n").to_numpy())
    return levels


def shingle_bands(docs: DataFrame, levels: np.ndarray, *, words: int, text_col: str) -> DataFrame:
    """(node, choice, key): the prefix of each set of shingles, once for each task that has it. Two sets of a and b
    hashes at a Jaccard similarity of 0.8 share 0.8 a of them at least; were the first of these in their order behind
    the first fifth of a's and one more, fewer than 0.8 a would be left to share, and so for b."""

    def run(batches):
        seen = set()
        for b in slices(batches):
            node, key = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
            for t in texts_of(b, text_col):
                hashes = shingle_set(t, words)
                if not len(hashes) or (n := set_node(hashes)) in seen:
                    continue
                seen.add(n)
                order = np.lexsort((hashes, levels[(hashes & np.uint64(LEVEL_SLOTS - 1)).astype(np.int64)]))
                first = hashes[order[: len(hashes) // 5 + 1]]
                key.append(first)
                node.append(np.full(len(first), n, dtype=np.int64))
            node, key = np.concatenate(node), np.concatenate(key).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.zeros(len(node), np.int32)), pa.array(key)], names=["node", "choice", "key"])

    return docs.select(text_col).mapInArrow(run, "node long, choice int, key long")


def verified_links(sets: list[np.ndarray], fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Index pairs that span every component of the pairs of sets at an exact Jaccard similarity of 0.8 and more."""
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    flat, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(len(flat), dtype=bool)
    out: list[tuple[int, int]] = []
    left = np.arange(len(sets))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = left[(5 * sizes[left] >= 4 * sizes[x]) & (4 * sizes[left] <= 5 * sizes[x])]
            near = near[differing(fps[near], fps[x]) <= max_bits] if len(near) else near
            if not len(near):
                continue
            own = codes[starts[x] : starts[x] + sizes[x]]
            mark[own] = True
            shared = np.array([np.count_nonzero(mark[codes[starts[y] : starts[y] + sizes[y]]]) for y in near.tolist()])
            mark[own] = False
            near = near[9 * shared >= 4 * (sizes[near] + sizes[x])]
            if len(near):
                out += [(x, int(y)) for y in near]
                queue += near.tolist()
                left = left[~np.isin(left, near)]
    return out


def verified_edges(docs: DataFrame, nodes: DataFrame, candidates: DataFrame, *, words: int, max_bits: int, id_col: str, text_col: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): links at a Jaccard similarity of 0.8 and more that span every component of those within a candidate
    component (node, root). Only texts of candidates are hashed again, each node's once."""
    size = candidates.groupBy("root").agg(F.count("*").alias("n"))
    wanted = candidates.join(size, "root").join(nodes, "node").select("node", "root", "n", "least_id")
    rows = docs.select(id_col, text_col).join(wanted, F.col(id_col).eqNullSafe(F.col("least_id"))).select("node", "root", "n", text_col)

    def hashed(batches):
        kind = pa.list_(pa.field("element", pa.int64(), False))
        for b in slices(batches):
            sets = [shingle_set(t, words) for t in texts_of(b, text_col)]
            same = [set_node(x) == n for x, n in zip(sets, b.column("node").to_pylist(), strict=True)]  # ids may be repeated
            got = pa.RecordBatch.from_arrays([b.column("node"), b.column("root"), b.column("n"), pa.array([x.view(np.int64) for x in sets], kind)], names=["node", "root", "n", "grams"])
            yield got.filter(pa.array(same, pa.bool_()))

    dealt = (
        rows.mapInArrow(hashed, T.StructType([T.StructField("node", T.LongType()), T.StructField("root", T.LongType()), T.StructField("n", T.LongType()), T.StructField("grams", T.ArrayType(T.LongType(), False))]))
        .join(nodes.select("node", "fp"), "node")
        .withColumn("parts", F.ceil(F.col("n") / block_rows).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "fp", "grams")
    )

    def run(batches):
        def links(group):
            # A node stands more than once where rows are repeated whole.
            held = {node: (fp, grams) for node, fp, grams in group}
            if len(held) < 2:
                return None
            node = np.array(list(held), dtype=np.int64)
            pairs = verified_links([x for _, x in held.values()], np.stack([x for x, _ in held.values()]), max_bits)
            if not pairs:
                return None
            a, b = node[np.array(pairs)].T
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        key, group = None, []
        for batch in batches:
            for b in slices([batch]):
                keys = list(zip(*[b.column(c).to_pylist() for c in ("root", "i", "j")], strict=True))
                node = b.column("node").to_pylist()
                for at, k in enumerate(keys):
                    if k != key:
                        if (out := links(group)) is not None:
                            yield out
                        key, group = k, []
                    fp, grams = (b.column(c)[at].values.to_numpy(zero_copy_only=False) for c in ("fp", "grams"))
                    group.append((node[at], fp.astype(np.int64).view(np.uint64), grams.astype(np.int64).view(np.uint64)))
        if (out := links(group)) is not None:
            yield out

    return dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(run, "a long, b long").distinct()


def near_edges(nodes: DataFrame, banded: DataFrame, *, max_bits: int, words: int = 1, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): links among nodes (node, fp: each once, materialised) that span every component of those who meet in a band."""
    full = banded.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    # A row in block b of a bucket meets every block j: once in group (min(b, j), max(b, j)).
    dealt = (
        banded.join(full, ["choice", "key"])
        .withColumn("parts", F.ceil(F.col("n") / block_rows).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("node", "choice", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    dealt = dealt.join(nodes, "node")
    refs = reference_fingerprints(pivots, words)

    def run(batches):
        def read(b):
            flat = b.column("fp").combine_chunks() if hasattr(b.column("fp"), "combine_chunks") else b.column("fp")
            fps = flat.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, words)
            keys = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("choice", "key", "i", "j")], axis=1)
            return fps, keys, b.column("node").to_numpy(zero_copy_only=False)

        def work(fps, keys, node, final):
            """Edges of all groups that are complete; the last group waits for its next rows."""
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            ends = np.append(cut, len(fps)) if final else cut
            if not len(ends):
                return (fps, keys, node), None
            done = int(ends[-1])
            edges = list(_links_of_groups(fps[:done], ends, max_bits, refs))
            out = None
            if edges:
                a, b = (np.concatenate(x) for x in zip(*edges, strict=True))
                out = pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])
            return (fps[done:], keys[done:], node[done:]), out

        held = None
        for b in batches:
            if not b.num_rows:
                continue
            new = read(b)
            held, out = work(*(new if held is None else tuple(np.concatenate(x) for x in zip(held, new, strict=True))), False)
            if out is not None:
                yield out
        if held is not None and len(held[0]):
            out = work(*held, True)[1]
            if out is not None:
                yield out

    grouped = dealt.repartition("choice", "key", "i", "j").sortWithinPartitions("choice", "key", "i", "j")
    return grouped.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each component, for every node that has an edge.

    Rounds of large-star and small-star over materialised edge tables, until a round changes nothing; each round's
    shuffles carry at most two rows for each edge, and a node's neighbours are never gathered in one place.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        # Large star: every neighbour greater than the node is tied to the least of the node and its neighbours.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        star = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: every lesser neighbour, and the node itself, is tied to the least neighbour.
        star = materialize(star.where("a <> b").distinct(), "large-star")
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        tied = star.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = materialize(tied.where("a <> b").distinct(), "small-star")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if before == now:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _labelled(prints: DataFrame, nodes: DataFrame, edges: DataFrame, id_col: str, on: str = "fp") -> DataFrame:
    roots = materialize(components(edges), "roots")
    joined = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = materialize(joined.join(ids, "root").select(on, "component_id"), "labels")
    return prints.join(labels, on).select(id_col, "fp", "component_id")


def best_blocks(n: int, max_bits: int, least: int = 6) -> int:
    """Into how many blocks 64 bits are best cut for n fingerprints: more of them make more rows for each fingerprint, but
    longer keys and so fewer chance pairs in a bucket (a pair costs about a hundredth of a row)."""
    cost = lambda b: math.comb(b, max_bits) * (1 + 0.01 * n / 2 ** (64 * (b - max_bits) / b))
    return min(range(least, 3 * max_bits + 1), key=cost)


def near_duplicates(docs: DataFrame, *, words: int = 4, max_bits: int = 4, blocks: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) by 64-bit fingerprints: component_id is the least id that links reach from the row. Exact,
    whatever the number of blocks, which is chosen by the number of distinct fingerprints."""
    prints = materialize(fingerprints(docs, words=words, id_col=id_col, text_col=text_col), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min(id_col).alias("least_id")).withColumn("node", F.col("fp")[0]), "distinct")
    few = nodes.select("node", "fp")
    banded = exact_bands(few, max_bits, blocks or best_blocks(nodes.count(), max_bits))
    return _labelled(prints, nodes, near_edges(few, banded, max_bits=max_bits), id_col)


def similar_texts(docs: DataFrame, *, words: int = 5, seeds: tuple[int, ...] = (42, 43, 44, 45), max_bits: int = 72, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id): component_id is the least id that links reach from the row. Two texts are linked if the
    Jaccard similarity of their sets of `words`-word shingles is 0.8 or more, exactly, and their fingerprints are at
    most max_bits apart (at 0.8, 39 of 256 on average, with a standard deviation of 6)."""
    prints = materialize(set_prints(docs, words=words, seeds=seeds, id_col=id_col, text_col=text_col), "fingerprints")
    nodes = materialize(prints.groupBy("node").agg(F.min(id_col).alias("least_id"), F.min("fp").alias("fp")), "distinct")
    few = nodes.select("node", "fp")
    levels = shingle_levels(docs, words=words, text_col=text_col)
    banded = materialize(shingle_bands(docs, levels, words=words, text_col=text_col), "prefixes")
    found = near_edges(few, banded, max_bits=max_bits, words=len(seeds))
    candidates = materialize(components(found), "candidates")
    edges = verified_edges(docs, nodes, candidates, words=words, max_bits=max_bits, id_col=id_col, text_col=text_col)
    return _labelled(prints, nodes, edges, id_col, "node")


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp[0])), 16, "0")
