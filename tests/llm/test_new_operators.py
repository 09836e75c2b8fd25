"""Resampling, substring dedup and centroid clustering on small tables: awkward rows, ties, repeats, empty tables, and brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelstats.llm import centroids, resampling, substring_dedup

SF = "/root/testdata/sf0.001"
FEATURE_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def feature_words(t):
    return FEATURE_WORD.findall((t or "").encode().translate(LOWER))


def crcs(t, n=2):
    w = feature_words(t)
    return [zlib.crc32(b" ".join(w[i : i + k])) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize(("n", "segment"), [(1, 1 << 22), (2, 1 << 22), (2, 90), (3, 90)])
def test_crcs_of_runs_equal_zlib(monkeypatch, n, segment):
    monkeypatch.setattr(resampling, "SEGMENT", segment)
    rng = random.Random(n)
    parts = ["a", "B", "é", "漢", "9", "  ", ", ", "\n", "-", "zz", "", "Q" * 30]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(120)] + ["", "x" * 5000 + " b", "ab", "cd"]
    found = resampling.ngram_crcs(pa.array(texts, pa.large_string()), n)
    words, got = next(found), [[] for _ in texts]
    for owner, crc in found:
        for i, c in zip(owner.tolist(), crc.tolist()):
            got[i].append(c)
    for t, w, g in zip(texts, words, got):
        assert w == len(feature_words(t)) and sorted(g) == sorted(crcs(t, n))


def plain_resampling(docs, target, percent=25, min_words=20, buckets=10_000):
    own, want = Counter(), Counter()
    for _, t in docs:
        own.update(c % buckets for c in crcs(t))
    for t in target:
        want.update(c % buckets for c in crcs(t))
    s, t = sum(own.values()), sum(want.values())
    gain = [math.floor(1000 * math.log((want[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets)))) for b in range(buckets)]
    rows = []
    for d, x in docs:
        f = crcs(x)
        weight = sum(gain[c % buckets] for c in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(feature_words(x))])
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], -r[1]))
    place = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return Counter((r[0], r[1], r[2], r[3], place.get(id(r))) for r in rows)


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choice("Alpha beta gamma, délta ε 7 eta".split()) for _ in range(n))
    rows = [(i, say(rng.randint(15, 60))) for i in range(60)] + [(70, None), (71, ""), (72, " \n,"), (73, "one"), (74, say(30_000)), (None, say(30)), (None, say(25))]
    return rows + [rows[3], rows[3], (5, say(33))]


def test_resampling(spark, awkward):
    target = ["alpha gamma délta", None, "ε ε ε", ""]
    docs = spark.createDataFrame(awkward, "doc_id long, text string").withColumn("score", F.lit("clash")).repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    rows = resampling.scored(docs, bench).drop("text").persist()
    got = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in resampling.ranked(rows).collect())
    assert got == plain_resampling(awkward, target)
    drawn = resampling.resample(docs, bench)
    assert {(r["doc_id"], r["score"]) for r in drawn.collect()} == {(k[0], k[3]) for k in got if k[4]} and "text" in drawn.columns
    rows.unpersist()


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "text string")
    rows = resampling.scored(none, bench).drop("text")
    assert resampling.ranked(rows).count() == 0 and resampling.resample(none, bench).count() == 0


def test_op11_equals_brute_force(spark):
    table = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*c).collect()]
    got = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in entry.queries()["op11_importance_resampling"](spark, SF).collect())
    assert got == plain_resampling(table("documents", "doc_id", "text"), [t for (t,) in table("benchmark", "text")])


def plain_substrings(rows, width=13):
    words = [WORD.findall(t or "") for _, t in rows]
    least = {}
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - width + 1 if d is not None else 0):
            key = tuple(w[i : i + width])
            least[key] = min(d, least.get(key, d))
    out = Counter()
    for (d, _), w in zip(rows, words):
        gone = {p for i in range(len(w) - width + 1 if d is not None else 0) if least[tuple(w[i : i + width])] < d for p in range(i, i + width)}
        out[d, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)] += 1
    return out


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(12)
    say = lambda n, k=400: " ".join(f"w{rng.randrange(k)}" for _ in range(n))
    shared, other = say(40), say(14)
    rows = [(i, say(rng.randint(0, 30)) + "\n " + shared + "\t" + say(rng.randint(0, 20))) for i in range(60)]
    rows += [(100 + i, say(8) + " " + other + " " + say(8, 2)) for i in range(10)] + [(120, "a " * 400), (121, "a " * 300), (122, "A " * 50)]
    rows += [(130, None), (131, ""), (132, " \n"), (133, "one two"), (134, say(13)), (135, rows[0][1]), (136, say(30_000, 50_000) + " " + other), (None, shared), (None, None)]
    return rows + [rows[4], (7, say(20)), (7, shared), (200, "é " + shared + " \x0b漢")]


@pytest.mark.parametrize("settings", [{}, {"width": 5, "m": 4}, {"width": 3, "m": 3}])
def test_substring_dedup(spark, passages, settings, monkeypatch):
    for partitions in (1, 7):
        docs = spark.createDataFrame(passages, "doc_id long, text string").withColumn("_hits", F.lit(1)).withColumn("lang", F.lit("en")).repartition(partitions)
        out = substring_dedup.dedup_substrings(docs, **settings)
        assert out.columns == ["doc_id", "text", "lang", "n_words", "n_removed"]
        assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in out.collect()) == plain_substrings(passages, settings.get("width", 13))


@pytest.mark.parametrize("words", [[], [b"a", b"w3", b"w399", "é".encode()], [f"w{i}".encode() for i in range(400)]])
def test_substring_dedup_in_small_steps(spark, passages, monkeypatch, words):
    """Many packings a task, many sortings a bucket, every run frequent, and few or many words with numbers."""
    monkeypatch.setattr(substring_dedup, "PACKED", 50)
    monkeypatch.setattr(substring_dedup, "SORTED", 200)
    monkeypatch.setattr(substring_dedup, "_order", lambda docs, m: substring_dedup.Order(np.ones(1 << substring_dedup.BITMAP_BITS, bool), words))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    docs = spark.createDataFrame(passages, "doc_id long, text string").coalesce(1)
    order = spark.sparkContext.broadcast(substring_dedup._order(docs, 2))
    packed = [bytes(r["packed"]) for r in substring_dedup._packed(docs.filter("doc_id IS NOT NULL"), order, 13, 2).collect()]
    assert len(packed) > len(set(packed))
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in substring_dedup.dedup_substrings(docs).collect()) == plain_substrings(passages)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.dedup_substrings(spark.createDataFrame([], "doc_id long, text string"), m=14)


def plain_clusters(rows, k=16, rounds=3, dims=64):
    kept = [(d, [math.floor(64 * float(e)) for e in v]) for d, v in rows if v is not None and len(v) == dims and all(e is not None and math.isfinite(e) for e in v)]
    at = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(at))
    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(near(v)[1], []).append(v)
        at = [[sum(x) // len(held[i]) for x in zip(*held[i])] if i in held else c for i, c in enumerate(at)]
    out = [(d, near(v)[1], near(v)[0]) for d, v in kept]
    total = Counter()
    for _, c, x in out:
        total[c] += x
    return Counter((d, c, x, total[c], sum(total.values())) for d, c, x in out), at


def vectors(seed, n, dims=64):
    rng = random.Random(seed)
    middle = [[rng.uniform(-3, 3) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [c + rng.uniform(-0.3, 0.3) for c in middle[i % 5]]) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(2000, None), (2001, []), (2002, [1.0] * (dims - 1)), (2003, [None] + [1.0] * (dims - 1)), (2004, [float("nan")] * dims), (2005, [float("inf")] + [0.0] * (dims - 1))]
    return rows + [(None, [0.0] * dims), rows[7], rows[7], (7, [0.5] * dims)]


@pytest.mark.parametrize(("n", "dims", "k"), [(150, 64, 16), (60, 2, 16), (3, 64, 70)])
def test_clustering(spark, n, dims, k):
    rows = vectors(n, n, dims)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("clash")).repartition(4)
    out, found = centroids.cluster(frame, k=k, dims=dims)
    want, at = plain_clusters(rows, k=k, dims=dims)
    assert Counter(tuple(r) for r in out.collect()) == want and found.tolist() == at
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia"]


def test_clustering_of_nothing_and_of_too_much(spark):
    schema = "vec_id long, embedding array<double>"
    out, found = centroids.cluster(spark.createDataFrame([], schema))
    assert out.count() == 0 and not len(found)
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], schema))


def test_walk_spares_distances_and_keeps_ties():
    rng = np.random.default_rng(3)
    middle = rng.integers(-400, 400, (50, 16)) + np.arange(50)[:, None] * 40
    x = middle[rng.integers(0, 50, 4000)] + rng.integers(-6, 7, (4000, 16))
    at = np.concatenate([middle, middle[:7]])  # ties go to the smaller number
    distance = ((x[:, None] - at[None]) ** 2).sum(2)
    chosen, best, computed = centroids.nearest(x, at)
    assert (best == distance.min(1)).all() and (chosen == distance.argmin(1)).all()
    assert computed < 0.3 * distance.size
