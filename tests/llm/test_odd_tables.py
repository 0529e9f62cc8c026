"""Every corpus query and pipeline stage on odd tables, and results against plain versions of the methods."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cartulary.llm import queries, quality_rules, secret_scan, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
NAMES = [f"op{i}_" for i in range(1, 11)]
OPS = {n: next(f for k, f in queries.queries().items() if k.startswith(n)) for n in NAMES} | {"pipeline": corpus_pipeline.run}
#: Names that operators use for columns of their own.
CLASHING = ("fp", "length", "rid", "bucket", "row", "c0", "score", "n", "id", "tie", "node", "word", "g0", "x0", "kept", "ids", "m", "at")


def prose(rng, n):
    vocabulary = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    return ". ".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 12))).capitalize() for _ in range(n)) + "."


def odd_rows():
    rng = random.Random(4)
    rows = [(i, prose(rng, 9), ("en", "de", None)[i % 3], f"s{i % 2}", 10) for i in range(24)]
    rows += [(30, None, None, None, None), (31, "", "en", "s0", 0), (32, " \n\t ", "en", "s0", 4), (33, "x", None, "s1", 1), (34, prose(rng, 3000), "en", "s0", 9)]
    rows += [rows[3], rows[3], (40, rows[5][1], "de", "s1", 5), (3, "another text of the same id", "en", "s0", 7), (41, "password=hunter2hunter2 \U0001f600 漢字 " * 30, "en", "s1", 8)]
    return rows


def tables(spark, root, rows, extra=()):
    frame = spark.createDataFrame(rows, SCHEMA)
    for c in extra:
        frame = frame.withColumn(c, F.lit("clash"))
    frame.repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(20)] + [(None, None, None), (3, None, None), (5, 1, 1)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{root}/labels.parquet")
    return str(root)


def plain(rows):
    return sorted(str(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in rows)


@pytest.mark.parametrize("name", OPS)
def test_odd_tables(spark, tmp_path, name):
    rows = odd_rows()
    assert OPS[name](spark, tables(spark, tmp_path / "empty", [])).count() == 0
    got = OPS[name](spark, tables(spark, tmp_path / "odd", rows)).collect()
    if name == "pipeline":
        assert got
    elif name == "op9_":
        assert sum(r["start"] == 0 for r in got) == len(rows)
    else:
        assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    if name in ("op5_", "pipeline"):  # the order of rows within tasks decides in which order weights learn
        return
    clash = OPS[name](spark, tables(spark, tmp_path / "clash", rows, [c for c in CLASHING])).collect()
    if name == "op9_":
        pick = lambda rs: [(r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rs]
        assert plain(pick(clash)) == plain(pick(got))
    else:
        assert plain(clash) == plain(got)


def test_a_null_id(spark, tmp_path):
    root = tables(spark, tmp_path, [(None, "one text of a null id here", None, None, None), (1, "another text that is of id one", "en", "s", 3)])
    for name, run in OPS.items():
        assert len({r["doc_id"] for r in run(spark, root).collect()}) == (2 if name != "pipeline" else len({r["doc_id"] for r in run(spark, root).collect()})), name


def test_packing_is_of_the_library_s_ids(spark, tmp_path):
    rows = odd_rows()
    got = OPS["op9_"](spark, tables(spark, tmp_path, rows)).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            want[doc_id, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    by: dict = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048


def plain_distances(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared robust distances and the cutoff of one group's vectors, by the method's steps on whole arrays."""
    p = x.shape[1]
    ridge = (x.std(axis=0) * quality_rules.RIDGE) ** 2 + quality_rules.LEAST**2
    low, middle, high = (np.sort(x, axis=0)[max(0, math.ceil(q * len(x)) - 1)] for q in (0.25, 0.5, 0.75))
    m, w, det = middle, np.diag(1 / (((high - low) / 1.349) ** 2 + ridge)), math.inf
    for _ in range(quality_rules.STEPS):
        d2 = np.einsum("ij,jk,ik->i", x - m, w, x - m)
        bins = np.floor(np.log2(np.maximum(d2, 1e-9)) * quality_rules.BINS_PER_OCTAVE).clip(-8 * 16, 24 * 16)
        last = np.sort(bins)[max(0, math.ceil(0.75 * len(x)) - 1)]
        near = x[bins <= last]
        centre, cov = near.mean(axis=0), np.cov(near.T, bias=True)
        new = np.linalg.slogdet(cov + np.diag(ridge))[1]
        if new >= det - 1e-9:
            break
        m, w, det = centre, np.linalg.inv(cov * quality_rules.consistency(0.75) + np.diag(ridge)), new
    d2 = np.einsum("ij,jk,ik->i", x - m, w, x - m)
    half, upper = (np.cbrt(np.sort(d2)[max(0, math.ceil(q * len(x)) - 1)]) for q in (0.5, 0.75))
    far = (half + (upper - half) * quality_rules.NormalDist().inv_cdf(quality_rules.OUTLIER_SHARE) / quality_rules.NormalDist().inv_cdf(0.75)) ** 3
    return d2, max(far, quality_rules.chi2_quantile(quality_rules.OUTLIER_SHARE, p))


def test_quality_distances_are_the_method_s(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        text = "\n".join(prose(rng, 2) for _ in range(rng.randrange(4, 9)))
        if i % 40 == 7:
            text += "".join(f" $#{i}%{j}|&*" for j in range(40))
        rows.append((i, text, ("en", "de")[i % 2], "s"))
    got = {r["doc_id"]: r for r in quality_rules.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), min_group=50).collect()}
    for lang in ("en", "de"):
        measured = [(i, *quality_rules.measure(t)) for i, t, x, _ in rows if x == lang]
        good = [(i, v) for i, c, v in measured if not quality_rules.base_failed(c[0], c[4])]
        d2, cutoff = plain_distances(np.array([v for _, v in good]))
        assert len(good) > 100
        for (i, _), d in zip(good, d2, strict=True):
            assert got[i]["d2"] == pytest.approx(d, rel=1e-6) and got[i]["kept"] == (d <= cutoff), i
    assert any(not r["kept"] and not r["base_failed"] for r in got.values())


def toxic_rows(n=700):
    rng = random.Random(8)
    rows, marks = [], []
    for i in range(n):
        words = prose(rng, 6).split()
        bad = rng.random() < 0.25
        if bad:
            words[rng.randrange(len(words))] = rng.choice(("vilescum", "vilescums", "gruesomeoaf"))
        rows.append((i, " ".join(words), ("en", "de")[i % 2], "s", 1))
        marks.append((i, 1, int(bad)))
    return rows, marks


def test_toxicity_of_tables(spark, tmp_path):
    rows, marks = toxic_rows()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    got = OPS["op7_"](spark, str(tmp_path)).collect()
    truth = {i: t for i, _, t in marks}
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert {r["doc_id"] for r in got if r["held_out"]} == {r["doc_id"] for r in held}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    # The scores of tables are those of the model's arrays, text by text.
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    model = toxicity.fit_toxicity(docs, spark.read.parquet(str(tmp_path / "labels.parquet")))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    for i, text, *_ in rows[:40]:
        assert scores[i] == pytest.approx(float(model.score([model.rows(toxicity.buckets_of(text))])[0]), rel=1e-5)


def test_pipeline_stages_are_their_operators(spark, tmp_path):
    rows, marks = toxic_rows()
    rng = random.Random(3)
    for i in range(40):  # near copies: one word of a hundred differs
        text = rows[i][1].split()
        text[rng.randrange(len(text))] = "changed"
        rows.append((1000 + i, " ".join(text), rows[i][2], "s", 1))
    rows += [(2000, rows[60][1] + " password=hunter2hunter2", "en", "s", 1), (2001, None, None, None, None), (2002, "", "en", "s", 0)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    labels = spark.read.parquet(str(tmp_path / "labels.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)

    def kept(name, docs):
        out = stages[name](spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    after = kept("toxicity", at)
    model = toxicity.fit_toxicity(at, labels)
    limit = lambda lang: model.thresholds.get(lang, model.default_threshold)
    want = {i for i, t, lang, *_ in rows if model.score([model.rows(toxicity.buckets_of(t or ""))])[0] < limit(lang)}
    assert {r["doc_id"] for r in after.collect()} == want
    bad = {i for i, _, t in marks if t}
    assert len(bad & want) < 0.1 * len(bad) and len({i for i, _, t in marks if not t} - want) < 0.05 * len(marks)

    before = {r["doc_id"] for r in after.collect()}
    verdicts = {r["doc_id"]: r["kept"] for r in quality_rules.quality_verdicts(after).collect()}
    after = kept("quality_rules", after)
    assert {r["doc_id"] for r in after.collect()} == {i for i in before if verdicts[i]}

    texts = {r["doc_id"]: r["text"] or "" for r in after.collect()}
    shingles = {i: {" ".join(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if (w := t.lower().split()) else set() for i, t in texts.items()}
    root = {i: i for i in texts}
    for a in texts:
        for b in texts:
            if a < b and root[a] != root[b] and 10 * len(shingles[a] & shingles[b]) >= 8 * len(shingles[a] | shingles[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    assert len(set(root.values())) < len(root)
    after = kept("simhash", after)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(root.values()))

    before = {r["doc_id"]: r["text"] for r in after.collect()}
    after = kept("secret_scan", after)
    for r in after.collect():
        masked = secret_scan.redact(before[r["doc_id"]], secret_scan.find_secrets(before[r["doc_id"]])[1])
        assert r["text"] == masked and (masked == before[r["doc_id"]] or r["n_chars"] == len(masked))
    packed = stages["packing"](spark, after, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in after.collect()}
