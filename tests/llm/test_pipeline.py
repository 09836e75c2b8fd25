"""The whole pipeline on a small fixture against a brute-force version, stage by stage on each stage's own input."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelstats.llm.storage import save

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(12)
    say = lambda n: " ".join(rng.choice("alpha beta Gamma delta eps zeta eta theta iota".split()) + str(rng.randrange(50)) for _ in range(n))
    rows = [(i, say(40), "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(100 + i, rows[i % 4][1] + " tail", "en", "s0", 1) for i in range(8)]
    line = "A line that is printed in every one of these documents, word for word."
    rows += [(200 + i, say(30) + "\n" + line, "en", "s1", 1) for i in range(7)]
    rows += [(300, "### " * 30, "en", "s2", 1), (301, "too short", "en", "s2", 1), (302, None, "en", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, docs):
    pytest.importorskip("public_tokenizers")
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out, _ = save(stage(spark, docs, ""), "stage")
        after = out.collect()
        if name == "quality rules":
            assert {r["doc_id"] for r in after} == set(before) - {300, 301, 302}
        elif name == "line dedup":
            lost = [r["doc_id"] for r in after if r["text"] != before[r["doc_id"]]["text"]]
            assert sorted(lost) == [200 + i for i in range(6)] and all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "n-gram Jaccard join":
            sets = {d: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for d, w in ((d, WORD.findall(r["text"].translate(FOLD))) for d, r in before.items())}
            near = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            assert {r["doc_id"] for r in after} == {d for d in before if not any(near(d, o) for o in before if o < d)}
        elif name == "mixing to target weights":
            times = Counter(r["doc_id"] for r in after)
            assert max(times.values()) <= 2 and all(r["text"] == before[r["doc_id"]]["text"] for r in after)
        else:
            assert len(after) == docs.count() and all(r["decodes"] for r in after)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = out


def test_empty(spark, docs):
    pytest.importorskip("public_tokenizers")
    out = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out, _ = save(stage(spark, out, ""), "stage")
    assert out.count() == 0


def test_stages_with_awkward_rows(spark, docs):
    """Null and repeated ids, null texts, a very long text, and columns named like the operators' own."""
    pytest.importorskip("public_tokenizers")
    rng = random.Random(13)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(40_000))
    say = lambda n: " ".join(f"v{rng.randrange(300)}" for _ in range(n))
    one, two, copied = say(30), say(30), say(40)
    rows = [(1, long, "en", "s0", 1), (2, one, "en", "s0", 1), (2, one, "en", "s0", 1), (3, one + " x", "en", "s1", 1), (4, two, "en", "s1", 1), (4, copied, "en", None, 1), (None, say(25), "en", "s1", None), (None, say(25), None, "s1", None), (5, copied, "en", "s0", 1), (6, None, None, None, None)]
    names = ("token", "n", "rep", "component", "copies", "kept", "ids", "n_words", "_row", "batch")
    data = [(*r, *range(len(names))) for r in rows]
    out = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` long" for n in names)).repartition(3)
    columns = out.columns
    for name, stage in corpus_pipeline.STAGES:
        out, _ = save(stage(spark, out, ""), "stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        ids = Counter(r["doc_id"] for r in out.collect())
        if name == "quality rules":
            assert ids == Counter([1, 2, 2, 3, 4, 4, None, None, 5])
        elif name == "n-gram Jaccard join":
            # 3 is a near copy of 2, and 5 a copy of what stands under 4; of the two equal rows one stays, rows without id stay
            assert ids == Counter([1, 2, 4, 4, None, None])
    assert all(r["decodes"] for r in out.collect())


def test_two_threads_do_not_delete_each_other_s_tables(spark):
    """Each drops what it has written itself while the other is at work."""
    from concurrent.futures import ThreadPoolExecutor

    from panelstats.llm import storage

    def work(name):
        at, out = storage.mark(), []
        for i in range(4):
            table, path = storage.save(spark.range(100).withColumn("x", F.lit(f"{name}{i}")), name)
            storage.drop(spark, *[p for p in storage.since(at) if p != path])
            out.append((table.count(), [p.rsplit("/", 1)[1].split("-")[0] for p in storage.since(at)]))
        return out

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(work, ["left", "right"])) == [[(100, [n])] * 4 for n in ("left", "right")]
