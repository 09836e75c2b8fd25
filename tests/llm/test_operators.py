"""Each operator on small tables: null, empty and long texts, repeated rows, empty tables, clashing columns, and brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelstats.llm import bpe, cotraining, graph, line_dedup, lm_scoring, mixing, ngram_join, pii, quality_rules, text, token_files, topk

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(FOLD))


def sentence(rng, n):
    return " ".join(rng.choice(["The", "quick", "fox,", "jumps", "over", "a", "lazy", "dog.", "élan", "straße", "42", "and"]) + rng.choice(["", "", "s", "ed"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = [sentence(rng, rng.randint(12, 60)) for _ in range(30)]
    out = [(i, base[i % 30] if i % 3 else sentence(rng, 30) + "\n" + base[0], "en", f"s{i % 4}" if i % 7 else None, 1) for i in range(60)]
    shared = "This very line is found in a great many of these documents."
    out += [(100 + i, sentence(rng, 20) + "\n  " + shared + ("\n" + shared.upper() if i == 3 else ""), "fr", "hot", None) for i in range(8)]
    near = sentence(rng, 60).split()
    out += [(200 + i, " ".join(near[:i] + ["new"] + near[i + 1 :]), None, "hot", 2) for i in range(6)]
    out += [(300, None, "en", "s1", None), (301, "", None, None, 0), (302, " \n\t", "en", "s2", 3), (303, "one two", "de", "s2", 7), (304, "One TWO", "de", "s2", 7), (305, sentence(rng, 4000), "en", "s3", 5)]
    out += [out[5], (None, sentence(rng, 25), "en", "s1", 4)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_word_hashes_tell_words_apart_and_fold_case():
    texts = pa.array(["The the\tTHE x", "", "élan Élan", " a\x0bb "], pa.large_string())
    data, starts, stops, first = text.word_bounds(texts)
    h = text.word_hashes(data, starts, stops)
    assert first.tolist() == [0, 4, 4, 6, 8] and h[0] == h[1] == h[2] != h[3] and h[4] != h[5]


def repeat_words(w):
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    return len({p for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)})


def test_rules_measure(spark, none):
    cases = ["a b c d e f a b c d e g", "x " * 40, "a\na\n \nb\na", "## $x *", None, "", "é ü\x0bö", " ".join(map(str, range(3000))) + " 1 2 3 4 5"]
    got = {r["doc_id"]: r for r in quality_rules.measure(spark.createDataFrame(list(enumerate(cases)), "doc_id int, text string")).collect()}
    for i, t in enumerate(cases):
        w = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeat_words(w))
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, t
    assert quality_rules.filter_documents(none).count() == 0


def test_rules_reject_a_bad_host_and_keep_columns(spark):
    good, bad = "one two three four five six seven eight nine ten eleven", "# " * 20
    rows = [(i, good, "fine", 9) for i in range(60)] + [(100 + i, bad if i < 57 else good, "bad", 9) for i in range(60)] + [(300, good, None, 9)]
    kept = quality_rules.filter_documents(spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long"))
    assert kept.columns == ["doc_id", "text", "source", "n_words"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(60), 300]


def test_line_dedup(docs, rows, none):
    got = Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup.dedup_lines(docs, min_docs=3).collect())
    held = {}
    key = lambda x: x.strip(text.BLANKS).translate(FOLD)
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= 40:
                held.setdefault(key(line), set()).add(d)
    want = Counter()
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(held.get(key(x), ())) < 3 or d == max(held[key(x)])]
        want[d, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    assert got == want and any(k[3] for k in want)
    assert line_dedup.dedup_lines(none).count() == 0


def components(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = components(pairs, {x for a, b in pairs if a != b for x in (a, b)})
    assert got == want


def test_ngram_join_against_all_pairs(docs, rows, none, monkeypatch):
    sets = {}
    for i, (d, t, *_) in enumerate(rows):
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = {i: r[0] for i, r in enumerate(rows) if r[0] is not None}
    near = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    want = components([(ids[i], ids[j]) for i in ids for j in ids if i < j and near(sets[i], sets[j])], set(ids.values()))
    out = ngram_join.link_components(docs.withColumn("token", F.lit(1))).collect()
    assert len(out) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in out if r["doc_id"] is not None} == want
    assert Counter((r["doc_id"], r["n_shingles"]) for r in out) == Counter((r[0], len(sets[i])) for i, r in enumerate(rows))
    assert want[303] == want[304] == 303 and len({want[200 + i] for i in range(6)}) < 6
    assert ngram_join.link_components(none).count() == 0


def test_ngram_join_opens_groups_of_other_components(spark):
    """Chains in which only neighbours link: pivots prove some links, and the matrix must find the others."""
    rng = random.Random(9)
    seq = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(i, " ".join(seq[i * 4 : i * 4 + 60])) for i in range(60)]
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    assert out == components([(i, j) for i in range(60) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])], range(60))


def test_mixing(docs, none):
    sized = docs.select("doc_id", "source", mixing.size_of().alias("size"))
    out = mixing.plan(sized, sized).collect()
    assert Counter(map(str, out)) == Counter(map(str, mixing.plan(sized, sized).collect()))
    by = {r["source"]: (r["source_size"], r["target"]) for r in out}
    total = sum(s for s, _ in by.values())
    assert sum(t for _, t in by.values()) == pytest.approx(1.5 * total) and all(t <= 2 * s + 1e-9 for s, t in by.values())
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate([*sorted(x for x in by if x), None])}
    assert len({round(t / weight[s], 6) for s, (size, t) in by.items() if t < 2 * size - 1e-9}) <= 1
    assert all(r["copies"] <= 2 for r in out)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in out)
    assert mixing.mix(none).count() == 0


def test_mixing_of_rows_without_id(spark):
    rows = [(None, f"word number {i}" if i % 50 else None, "en", "s0" if i % 3 else "s1", 1) for i in range(600)]
    docs = spark.createDataFrame([*rows, rows[1], rows[1]], DOCS)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = Counter(r["source"] for r in mixed.filter("text IS NOT NULL").collect())
    sized = docs.select("doc_id", "source", mixing.size_of().alias("size"))
    for r in mixing.targets(sized).collect():
        assert 3 * taken[r["source"]] == pytest.approx(r["target"], rel=0.15)
    assert sum(r["text"] == rows[1][1] for r in mixed.collect()) in (0, 3, 6)


@pytest.fixture(scope="module")
def ranks():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_bpe_equals_the_library(docs, rows, none, ranks):
    tiktoken = pytest.importorskip("tiktoken")
    with open(ranks[0], "rb") as f:
        library = tiktoken.Encoding("own", pat_str=ranks[1], mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})
    own = bpe.Encoder(*ranks)
    rng = random.Random(7)
    for _ in range(4000):
        t = "".join(rng.choice(["a", " ", "  ", "\n", "é", "漢", "\x1c", "\x85", "　", "😀", "1", "'s", "!!", "\t", "Th", "​", "\r\n", "ing"]) for _ in range(rng.randint(0, 16)))
        assert np.frombuffer(own.ids(t), "<u4").tolist() == library.encode_ordinary(t), t
    out = bpe.decode(bpe.encode(docs, *ranks), ranks[0]).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in out) and len(out) == len(rows)
    assert bpe.encode(none, *ranks, decoded="d").count() == 0


def test_bpe_states_may_be_dropped(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 5)
    own, whole = bpe.Encoder(*ranks), bpe.Encoder(*ranks)
    for w in ("internationalisation", "straßenbahnhaltestelle", "internationale", "interrogation") * 3:
        assert own.transducer.encode(w.encode()) == own.transducer.merged(w.encode()) == whole.transducer.encode(w.encode())


def test_decoding_holds_back_begun_code_points(ranks):
    own, back = bpe.Encoder(*ranks), bpe.Decoder(ranks[0])
    t = "漢字😀é" * 50
    parts = list(back.stream(own.ids(t), chunk=1))
    assert "".join(parts) == t and "�" not in "".join(parts)


def test_token_files_round_trip(spark, docs, rows, none):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    encoded = {}
    for d, t, *_ in rows:
        encoded.setdefault(d, []).append(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4"))
    start = 0
    out = token_files.read(token_files.write(docs, path, 2)).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    for r in out:
        assert r["start"] == start and any(r["ids"] == e.tolist() for e in encoded[r["doc_id"]]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]
    assert token_files.read(token_files.write(none, path, 2)).count() == 0
    small = token_files.FILE_IDS // 3
    many = spark.createDataFrame([(i, "a " * small) for i in range(7)], "doc_id long, text string").coalesce(1)
    for f in token_files.write(many, path, 2).collect():  # a file closes with the document that fills it
        assert f["n_ids"] - f["lengths"][-1] < token_files.FILE_IDS


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 5000])
@pytest.mark.parametrize("high", [1, 2, 50_000, 2**32])
def test_patched_blocks(n, high):
    rng = np.random.default_rng(n)
    ids = np.where(rng.random(n) < 0.05, rng.integers(0, 2**32, n), rng.integers(0, high, n)).astype(np.uint32)
    payload = token_files.encode_ids(ids)
    assert (token_files.decode_ids(payload) == ids).all()
    assert all((token_files.decode_block(payload, b) == ids[b * 1024 : (b + 1) * 1024]).all() for b in range(-(-n // 1024)))


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 60)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(150, 8)).round(3)
    v[20:60] = v[20]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(200, None), (201, [1.0, None]), (202, [float("nan")] * 8), (203, []), (None, [1.0] * 8), (5, [float(x) for x in v[5]]), (204, [0.5, 0.5])]
    q = topk.quantise(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    whole = {r["vec_id"]: np.array([*r["v"], *[0] * (8 - len(r["v"]))]) for r in q.collect()}
    assert set(whole) == {*range(150), 204} and all(x == np.floor(64 * v[3][i]) for i, x in enumerate(whole[3]))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(q.filter("vec_id % 20 = 0"), q, 20).collect()}
    for a in range(0, 150, 20):
        best = sorted(((-int(whole[a] @ w), b) for b, w in whole.items() if b != a))[:20]
        assert [got[a, i + 1] for i in range(20)] == [(b, -s) for s, b in best]
    assert topk.top_k(q.filter("false"), q.filter("false"), 20).count() == 0


def test_top_k_stops_on_proof_for_clustered_vectors(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(60, 32)) * (rng.random((60, 32)) < 0.2) * 4
    v = centres[rng.integers(0, 60, 1500)] + 0.05 * rng.normal(size=(1500, 32))
    q = topk.quantise(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>"))
    asked = q.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id").toPandas()
    found, read = topk.search_block(topk.index(q, 1).drop("block").toPandas(), asked, 20)
    assert read < 0.9
    whole = np.floor(64 * v).astype(int)
    for a in asked["query_id"]:
        score = whole @ whole[a]
        score[a] = -(10**15)
        best = np.lexsort((np.arange(len(v)), -score))[:20]
        own = found[found["query_id"] == a]
        assert own["vec_id"].tolist() == best.tolist() and own["score"].tolist() == score[best].tolist()


def test_top_k_refuses_what_it_cannot_score(spark):
    big = spark.createDataFrame([(1, [1e9, 2e9]), (2, [1e9, 2e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        topk.top_k(topk.quantise(big), topk.quantise(big), 2).collect()
    with pytest.raises(Exception, match="too large"):
        topk.quantise(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>")).collect()


@pytest.mark.parametrize("settings", [{}, {"head_words": 5}, {"max_filter_mb": 0}])
def test_lm_scores(docs, rows, settings):
    tokens = [(d, [*words(t), None]) for d, t, *_ in rows]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    counts = Counter(w for d, ws in tokens if not held(d) for w in ws)
    n, v = sum(counts.values()), len(counts)
    base = lambda ws: sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
    out = lm_scoring.score(docs, **settings).collect()
    assert len(out) == len(rows)
    want = sorted((str(d), len(ws), sum(counts[w] > 0 for w in ws), round(base(ws), 6)) for d, ws in tokens)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in out) == want
    assert all(r["held_out"] == held(r["doc_id"]) and r["train_tokens"] == n and r["score"] < 0 for r in out)


@pytest.mark.parametrize("settings", [{}, {"max_filter_mb": 0}])
def test_lm_scores_with_pairs_met_once(spark, settings):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    free = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10]
    rows = [(free[i], f"left{i} right{i}", None, None, None) for i in range(300)] + [(held[0], "left7 right7", None, None, None), (held[1], "left7 right8", None, None, None)]
    out = {r["doc_id"]: r["score"] for r in lm_scoring.score(spark.createDataFrame(rows, DOCS), **settings).collect()}
    assert out[held[0]] > out[held[1]] + 1  # the same words, but the pair has been met, once
    assert abs(out[held[0]] - out[free[7]]) < 1e-9


def test_lm_shards_score_as_the_broadcast_filters_do(docs):
    one, two = (sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 9)) for r in lm_scoring.score(docs, **s).collect()) for s in ({}, {"max_filter_mb": 0}))
    assert one == two


@pytest.mark.parametrize("settings", [{}, {"max_filter_mb": 0}])
def test_lm_score_equals_brute_force(docs, rows, settings):
    """With so many bits that no probe errs, the score follows from exact counts, taken down to their levels."""
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    tokens = [(d, [*words(t), None]) for d, t, *_ in rows]
    one, two = Counter(), Counter()
    for d, w in tokens:
        if not held(d):
            one.update(w)
            two.update(zip([None, *w], w))
    level = lambda c: 0.0 if not c else 1.0 if c == 1 else 2 ** (np.floor(np.log2(c)) + 0.5)
    size = sum(one.values()) + 0.1 * (len(one) + 1)

    def score(w):
        total = 0.0
        for a, b in zip([None, *w], w):
            pair = level(two[a, b])
            share = min(1.0, pair / max(level(one[a]), 1.0)) if pair else 0.0
            total += np.log10(lm_scoring.PAIR_WEIGHT * share + (1 - lm_scoring.PAIR_WEIGHT) * (level(one[b]) + 0.1) / size)
        return total

    got = sorted((str(r["doc_id"]), round(r["score"], 5)) for r in lm_scoring.score(docs.withColumn("model", F.lit(1)), bits=256, **settings).collect())
    assert got == sorted((str(d), round(score(w), 5)) for d, w in tokens)


def test_lm_filter_never_misses_a_level():
    rng = np.random.default_rng(0)
    keys, counts = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64)), None
    counts = rng.integers(1, 300, len(keys))
    f = lm_scoring.Filter([lm_scoring.Filter.build(lm_scoring._PAIR, keys, counts)], lm_scoring._PAIR)
    levels = f.levels(keys)
    assert (levels >= lm_scoring.levels_of(lm_scoring._PAIR, counts)).all() and (levels == lm_scoring.levels_of(lm_scoring._PAIR, counts)).mean() > 0.9
    assert (f.levels(rng.integers(2**63, 2**64, 5000, dtype=np.uint64)) > 0).mean() < 0.05


def test_lm_without_training(none, spark):
    assert lm_scoring.score(none).count() == 0


RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(t):
    out = []
    for kind, pattern in RULES.items():
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False, "card": 12 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            out += [(kind, *m.span())] * ok
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_pii_base_rules():
    rng = random.Random(2)
    for _ in range(20000):
        t = "".join(rng.choice(["a", "b.", "@", "1", "23", "256", ".", "-", " ", "+", "00", "(", ")", "%", "é", "\n", "4111111111111111", "@x.y", "+1 555"]) for _ in range(rng.randint(0, 16)))
        assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("a" * 200_000 + "1" * 200_000) == []  # linear in the length


def test_pii_field_finds_what_the_rules_miss():
    """Recall and precision on held-out lines of the labelled table; the rules find none of their spans."""
    rng = random.Random(8)
    corpus = [f"write to {rng.choice('abc')}{i % 60}@mail{i % 9}.example.com or call +1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)} today\nthe fox {rng.randrange(10)} jumped over {rng.randrange(10)} dogs version {i}.0" for i in range(100)]
    field = pii.train(corpus)
    held = pii.labelled_lines(12, seed=99)
    added = pii._added([x for x, _ in held], [pii.base_spans(x) for x, _ in held], field)
    spans = [(kind, a, b, own) for (_, marked), own in zip(held, added) for kind, a, b in marked]
    assert not any(pii.base_spans(x) for x, marked in held if marked)
    assert sum(any(k == kind and s < b and e > a for k, s, e in own) for kind, a, b, own in spans) >= 0.9 * len(spans)
    assert sum(bool(own) for (_, marked), own in zip(held, added) if not marked) <= 0.02 * len(held)
    lines = [x for t in corpus for x in t.split("\n")]
    for x, labels in zip(lines, field.decode([field.encode([m.group() for m in WORD.finditer(x)]) for x in lines])):
        want = [next((1 + pii.KINDS.index(k) for k, a, b in pii.base_spans(x) if m.start() < b and m.end() > a), 0) for m in WORD.finditer(x)]
        assert labels.tolist() == want


def test_pii_field_finds_patterns_that_it_was_not_trained_on():
    """Whole patterns of the labelled table left out, one at a time: exact spans of their lines, and no false lines."""
    found = asked = wrong = 0
    for kind, patterns in pii.MARKED.items():
        for pattern in patterns[::3]:
            table = pii.labelled_lines(12, marked={k: [p for p in ps if (k, p) != (kind, pattern)] for k, ps in pii.MARKED.items()})
            field = pii.Field(sorted({pii.shape(m.group()) for line, _ in table for m in WORD.finditer(line)}))
            field.fit(pii.windows(table, field), rounds=80)
            held, plain = pii.labelled_lines(20, 5, {kind: [pattern]}, []), pii.labelled_lines(5, 6, {})
            added = pii._added([x for x, _ in held], [[]] * len(held), field)
            found += sum(marked[0] in own for (_, marked), own in zip(held, added))
            asked += len(held)
            wrong += sum(map(bool, pii._added([x for x, _ in plain], [[]] * len(plain), field)))
    assert found >= 0.7 * asked and wrong == 0


def test_pii_rows_of_new_shapes_are_kept_and_dropped(monkeypatch):
    field = pii.train([])
    lines = [f"call {a}.{b}.{c} or write" for a in ("12", "123", "1234") for b in ("12", "123", "1234567") for c in ("1", "1234")]
    whole = pii._added(lines, [[]] * len(lines), field)
    assert len(field.ids) + 2 > field.trained
    monkeypatch.setattr(pii.Field, "ROWS", 0)
    assert [pii._added([x], [[]], field)[0] for x in lines] == whole and len(field.ids) + 2 <= field.trained + 2


def test_pii_spans(spark, none):
    rows = [(1, "write to ab@mail.example.com or call +1 (555) 555-1234 today", 5), (2, None, 6), (3, "", 7), (4, "x " * 50_000 + "4111 1111 1111 1111", 8), (5, "ring 555.123.4567\u00a0now\x85then", 9), (5, "ring 555.123.4567\u00a0now\x85then", 9)]
    out = [r.asDict() for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string, spans long")).collect()]
    own = {r["doc_id"]: r for r in out}
    assert len(out) == 6 and [tuple(s) for s in own[1]["base_spans"]] == pii.base_spans(rows[0][1]) and own[2]["spans"] == own[3]["spans"] == [] and own[4]["base_spans"][0]["kind"] == "card"
    assert all(set(map(tuple, r["base_spans"])) <= set(map(tuple, r["spans"])) for r in out)
    assert pii.find(none).count() == 0 and pii.shape("1" + "-1" * 40) == "long"


def test_viterbi_equals_all_paths():
    import itertools

    rng = np.random.default_rng(1)
    field = pii.Field(["1", "2"])
    field.emit, field.move = rng.normal(size=field.emit.shape), rng.normal(size=field.move.shape)
    sequences = [rng.integers(0, 5, n).tolist() for n in (1, 2, 4, 5)]
    for s, labels in zip(sequences, field.decode(sequences)):
        e = field.emissions(field.padded([s])[0])[0]
        value = lambda p: sum(e[i, y] for i, y in enumerate(p)) + sum(field.move[a, b] for a, b in zip(p, p[1:]))  # noqa: E731, B023
        assert value(labels.tolist()) == pytest.approx(max(map(value, itertools.product(range(5), repeat=len(s)))))


def test_cotraining_on_rows_held_out(spark, none):
    rng = random.Random(6)
    rows = [(i, sentence(rng, 40) + "." if i % 4 else " ".join(w + "***" for w in sentence(rng, 40).split()), "en" if i % 2 else None, f"s{i % 5}", 1) for i in range(400)] + [(900, None, None, None, None), (None, "x", "en", "s1", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 200)] + [(3, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in cotraining.score(docs, labels).collect()}
    assert len(out) == 402 and all(out[i]["kept"] == (i % 4 > 0) for i in range(200, 400))
    assert not out[300]["labelled"] and out[7]["labelled"]
    assert all(r["score"] == 1.0 for r in cotraining.score(docs, labels.filter("false")).collect())
    assert cotraining.score(none, labels).count() == 0


def test_cotraining_exchanges_both_ways(spark):
    """Bad texts come from bad sources; some texts look like nothing, and some sources have both."""
    rng = random.Random(11)
    rows = []
    for i in range(1200):
        bad = rng.random() < 0.4
        clear = rng.random() < 0.7
        t = sentence(rng, 40)
        rows.append((i, " ".join(w + "***" for w in t.split()) if bad and clear else t + "." if clear else "12 34 56", "en", f"s{rng.randrange(4) + 4 * bad}" if rng.random() < 0.9 else "mixed", len(t), bad))
    docs = spark.createDataFrame([r[:5] for r in rows], DOCS)
    labels = spark.createDataFrame([(r[0], int(not r[5]), 0) for r in rows[:400]], "doc_id long, quality int, toxic int")
    exchanged: list = []
    out = {r["doc_id"]: r for r in cotraining.score(docs, labels, confident=0.9, exchanged=exchanged).collect()}
    given = {view: sum(n for _, v, n in exchanged if v == view) for view in ("text", "metadata")}
    assert given["text"] > 100 and given["metadata"] > 100
    assert len({round(r["p_metadata"], 6) for r in out.values()}) > 2
    free = [r for r in rows[400:] if r[3] != "mixed" or r[1] != "12 34 56"]
    assert sum(out[r[0]]["kept"] == (not r[5]) for r in free) >= 0.95 * len(free)


def test_cotraining_fits_on_handed_rows_as_on_its_own(spark):
    rng = np.random.default_rng(4)
    x, n = rng.normal(size=(600, 3)), rng.integers(1, 9, 600)
    y = (x[:, 0] + rng.normal(size=600) > 0).astype(float)
    handed = spark.createDataFrame([(x[i].tolist(), float(y[i]), float(n[i])) for i in range(100, 600)], "x array<double>, y double, n double").repartition(5)
    n[:100] = 1
    one, two = cotraining.Logistic().fit(x[:100], y[:100], handed), cotraining.Logistic().fit(np.repeat(x, n, 0), np.repeat(y, n))
    assert np.allclose(one.w, two.w) and np.isclose(one.b, two.b)


def test_digest_columns(docs, ranks):
    out = bpe.encode(docs.filter("doc_id = 303"), *ranks, decoded="decoded").select(*bpe.digests()).head()
    assert out["decoded_sha256"] == hashlib.sha256(b"one two").hexdigest()


def test_columns_named_like_the_operators_own(spark, docs, ranks):
    """Columns of any name are left out or stay as they were; those named like a result give way to it."""
    own = docs.withColumns({c: F.lit(7) for c in ("n_lines", "n_dropped", "_k1", "k1", "batch", "ids", "decoded", "size", "copies", "target", "uid", "held_out", "score", "t", "m", "y", "labelled", "part", "file", "token", "rep", "level", "block", "dim", "v")})
    n = own.count()
    lines = line_dedup.dedup_lines(own)
    assert lines.count() == n and {"k1", "batch"} <= set(lines.columns) and not lines.filter("n_lines = 7 AND n_dropped = 7").count()
    assert bpe.encode(own, *ranks, decoded="decoded").filter("decoded = coalesce(text, '')").count() == n
    assert mixing.mix(own).columns == own.columns and lm_scoring.score(own).count() == n
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(40)], "doc_id long, quality int, y int")
    assert cotraining.score(own, labels).count() == n
    assert token_files.read(token_files.write(own, pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"), 2)).count() == n
    vectors = spark.createDataFrame([(i, [float(i), 1.0], 3, 4) for i in range(9)], "vec_id long, embedding array<double>, v int, block int")
    q = topk.quantise(vectors)
    assert topk.top_k(q.filter("vec_id = 3"), q, 2).count() == 2
    assert bpe.encode(docs.filter("doc_id = 5"), *ranks).count() == 2  # repeated rows are encoded as often as they occur


def test_bpe_bytes_pass_through_states(ranks, monkeypatch):
    """A step met for the first time is finished by the plain rule; when words come again, states alone read them."""
    rng = random.Random(3)
    own = bpe.Encoder(*ranks).transducer
    words = [" " + "".join(rng.choice(["the", "ing", "er", "an", "strasse", "ein", "ou", "tion", "x"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    finished = []
    real = type(own)._finish
    monkeypatch.setattr(type(own), "_finish", lambda self, state, rest: (finished.append(len(rest)), real(self, state, rest))[1])
    shares = []
    for _ in range(40):
        finished.clear()
        for w in words:
            assert own.encode(w.encode()) == own.merged(w.encode())
        shares.append(1 - sum(finished) / sum(map(len, words)))
    assert shares[-1] > 0.9 and shares[-1] >= shares[0]
