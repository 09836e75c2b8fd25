"""Keys, names and templates found by what a match must share, against comparing all with all."""

import difflib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelstats.operators import lines, mapping, matching, structure
from panelstats.plans import printed, research

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def title_key(s):
    return "".join(c for c in s.strip(" .:-–—|ا") if not (c.isdigit() or c.isspace() or c in "()-–.:"))


def test_ten_thousand_rules_equal_the_plain_join(spark):
    rng = random.Random(1)
    say = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    texts = [say(rng.randint(1, 25)) for _ in range(300)]
    rules = [(i, rng.choice("xy"), f"v{i}", rng.choice(texts)[: rng.randint(1, 9)] if i % 3 else say(rng.randint(1, 6)), rng.choice(["exact", "contains", "startswith"]), rng.choice(["any", "k12", "he"])) for i in range(10_000)]
    rules += [(10_000, "z", "none", "", "contains", "any"), (10_001, "z", "odd", "abc", "unknown", "any")]
    df = spark.createDataFrame([(t, rng.choice(["k12", "he"])) for t in texts], "text string, domain string")
    frame = spark.createDataFrame(rules, "rule_order int, dim string, value string, key string, how string, domain string")
    out = mapping.match_rules(df, frame)
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString() and "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    want = {}
    for t, d in df.distinct().collect():
        for _, dim, value, key, how, domain in rules:
            if key and domain in ("any", d) and ((how == "exact" and t == key) or (how == "contains" and key in t) or (how == "startswith" and t.startswith(key))):
                want.setdefault((t, d, dim), value)
    assert {(r["text"], r["domain"], r["dim"]): r["value"] for r in out.collect()} == want and len(want) > 500


@pytest.mark.parametrize("name", ["M3_map_headers", "M4_map_rows", "M10_tables_to_facts", "T13_table_catalogue"])
def test_dictionary_plans_have_no_product_and_few_scans(spark, name):
    plan = printed.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and plan.count("Scan parquet") <= 8


@pytest.mark.parametrize(("least", "pairs"), [(0.82, True), (0.9, True), (0.7, False), (0.6, False), (0.4, False)])
def test_alike_equals_all_pairs(spark, least, pairs):
    rng = random.Random(int(100 * least))
    base = ["".join(rng.choice("abcde ") for _ in range(rng.randint(1, 18))) for _ in range(30)]

    def bent(s):
        s = list(s)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(s) + 1)
            s[i : i + rng.randint(0, 1)] = rng.choice(["", "a", "q"])
        return "".join(s)

    left, right = {bent(rng.choice(base)) for _ in range(80)}, {bent(rng.choice(base)) for _ in range(60)} | {"a", "é", "aaaaaaaa"}
    frames = [spark.createDataFrame([(x,) for x in [*side, *side, ""]] + [(None,)], "name string") for side in (left, right)]
    got = {(r["a"], r["b"]): r["ratio"] for r in matching.alike(*frames, least).collect()}
    want = {(a, b): q for a in left for b in right if a and b and (q := difflib.SequenceMatcher(None, a, b).ratio()) >= least}
    assert matching.pairs_bound(least) is pairs
    assert set(got) == set(want) and all(got[k] == pytest.approx(q) for k, q in want.items())


def test_a_frequent_pair_of_letters_is_no_hot_key(spark):
    names = spark.range(100_000, numPartitions=4).select(F.concat(F.lit("univ "), F.substring(F.translate(F.md5(F.col("id").cast("string")), "0123456789", "ghijklmnop"), 1, 9)).alias("name")).distinct()
    some = names.filter(F.xxhash64("name") % 4000 == 0)
    met = matching.alike_candidates(some, names, 0.82)
    # All names share five letters, so that one shared pair compares all with all.
    assert met.count() < 0.01 * some.count() * names.count()
    got = {(r["a"], r["b"]) for r in matching.alike(some, names, 0.82).collect()}
    every, few = [r[0] for r in names.collect()], [r[0] for r in some.limit(1).collect()]
    for a in few:
        close = lambda b: 2 * sum((Counter(a) & Counter(b)).values()) >= 0.82 * (len(a) + len(b))  # noqa: B023, E731
        assert {b for x, b in got if x == a} == {b for b in every if close(b) and difflib.SequenceMatcher(None, a, b).ratio() >= 0.82}


def test_templates_of_parts_compare_few_titles(spark):
    seen = {}
    whole = lines.matching.alike
    query = printed.QUERIES["T19_template_headers"]

    def counted(left, right, least, name="name"):
        seen["compared"] = matching.alike_candidates(left, right, least, name).count()
        return whole(left, right, least, name)

    try:
        lines.matching.alike = counted
        got = {r["t"]: (r["template"], r["score"]) for r in query(spark, LARGER).collect()}
    finally:
        lines.matching.alike = whole
    parts = spark.read.parquet(f"{LARGER}/part.parquet").collect()
    tables, known = [(p["p_partkey"], title_key(p["p_name"]), p["p_size"]) for p in parts], {}
    templates = {}
    for t, k, size in tables:
        if size % 5 == 0:
            templates[k, size] = min(t, templates.get((k, size), t))
    pairs, want = 0, {}
    for t, k, size in tables:
        best = None
        for (other, s), m in templates.items():
            if s % 4 != size % 4:
                continue
            pairs += 1
            sim = difflib.SequenceMatcher(None, k, other).ratio()
            if sim >= 0.6:
                same = sum(abs(size * i - s * i) < 0.5 for i in (1, 2, 3)) / 3
                score = sim + 0.05 * (s % 2 == size % 2) + 2 * same
                best = max(best or (score, -m), (score, -m))
        if best and best[0] >= 0.72:
            want[t] = (-best[1], pytest.approx(best[0]))
    assert got == want and seen["compared"] < pairs / 10


def test_numbers_that_many_share_pair_no_rankings_with_journals(spark, tmp_path, monkeypatch):
    # 140,000 parts print 700 numbers that are shared: a hundred rankings and journals each.
    part = spark.read.parquet(f"{SF}/part.parquet").limit(1)
    part.drop("p_partkey").join(spark.range(1, 140_001).withColumnRenamed("id", "p_partkey")).select(*part.columns).write.parquet(f"{tmp_path}/part.parquet")
    for name in ("lineitem", "supplier"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    whole, rows = type(part).join, []

    def counted(left, *others, **options):
        out = whole(left, *others, **options)
        rows.append(out.count())
        return out

    monkeypatch.setattr(type(part), "join", counted)
    out = research.QUERIES["J21_source_classes"](spark, str(tmp_path))
    assert out.count() == sum(i % 17 != 0 for i in range(1, 140_001)) and rows and max(rows) <= 2 * 140_000


def test_titles_are_classified_once_each(spark):
    """The expressions that tell a title's domain stand behind an aggregation of the titles, and nulls have a domain too."""
    tables = spark.createDataFrame([(1, "دانشجويان کشور"), (2, "دانشجويان کشور"), (3, None), (4, "کلاس")], "t int, title string")
    out = mapping.with_domain(tables)
    assert {r["t"]: r["domain"] for r in out.collect()} == {1: "he", 2: "he", 3: "other", 4: "k12"}
    assert "regexp_replace" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_the_catalogue_shuffles_cells_once(spark, monkeypatch):
    """body rows and headers are taken out of written rows, so that the cells themselves are not grouped again."""
    seen = []
    whole = printed.mapping.tables_to_facts
    monkeypatch.setattr(printed.mapping, "tables_to_facts", lambda rows, *more: seen.append(rows) or whole(rows, *more))
    printed.QUERIES["T13_table_catalogue"](spark, SF)
    (rows,) = seen
    assert "cells" in rows.columns and "Exchange" not in printed.structure.body_of(rows)._jdf.queryExecution().executedPlan().toString()


def test_facts_broadcast_no_tables_and_read_notes_once(spark, monkeypatch):
    """a frame with a row for each table has small files and many rows, so that it is no broadcast, whatever its files' size says; and what
    notes say on coverage stands in a table of distinct notes, not in the plan of the facts."""
    plans, whole = {}, mapping.written

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return whole(df, name)

    monkeypatch.setattr(mapping, "written", seen)
    out = printed.QUERIES["M10_tables_to_facts"](spark, SF)
    plans["facts"] = out._jdf.queryExecution().executedPlan().toString()
    assert {"paths", "body", "facts"} <= set(plans) and not [name for name, plan in plans.items() if re.search(r"BroadcastHashJoin \[t#", plan)]
    assert "شامل" not in plans["facts"]


def test_facts_of_odd_tables(spark):
    """Marks of titles, rows and headers, notes that hold but for a year, tables without notes, columns without a header, rows of sections that print a year, and cells that are printed twice."""
    counted = "آمار دانشگاه آزاد را به استثنای سال تحصیلی 86-1385 شامل می‌شود"
    tables = [(1, "17-1- دانشجویان کشور (1)", 1400, ["1) شامل نیمه وقت", "2) دانشگاه علمی کاربردی را شامل نمی‌شود", "3) پیام نور به تفکیک استان موجود نیست", counted, "ماخذ: مرکز آمار", None]), (2, "17-2- دانشجویان کشور", 1401, None), (3, None, 1400, []), (4, "7-3- دانش آموزان دوره ابتدايي", 1402, ["شامل نیمه وقت"])]
    grid = [["شرح", "زن (3)", ""], ["1385-1386", "5", "6"], ["1386-1387 (2)", "7", "-"], ["1390-1391", "-", "-"], ["تهران", "8", "9"]]
    cells = [(t, r, c, x) for t in (1, 2, 3, 4) for r, row in enumerate(grid) for c, x in enumerate(row)] + [(4, 4, 1, "10")]
    rows = mapping.written(structure.by_row(structure.laid_out(structure.clean_grid(spark.createDataFrame(cells, "t int, r int, c int, x string")))), "odd")
    out = mapping.tables_to_facts(rows, spark.createDataFrame(tables, "t int, title string, yearbook int, notes array<string>"), mapping.terms(spark)).collect()
    got = {(r["t"], r["r"], r["c"]): (r["year"], r["province"], r["gender"], r["level"], r["university"], r["coverage"] and ",".join(r["coverage"]), r["value"]) for r in out if r["t"] < 4}
    assert got == {
        (1, 1, 1): (1385, "IRN", "female", "all_levels", "excl_azad", "excl_azad,incl_parttime,pnu_not_by_province", 5.0), (1, 1, 2): (1385, "IRN", "total", "all_levels", "excl_azad", "excl_azad,incl_parttime", 6.0),
        (1, 2, 1): (1386, "IRN", "female", "all_levels", "all_reported", "excl_uast,incl_azad,incl_parttime,pnu_not_by_province", 7.0),
        (1, 4, 1): (1386, "THR", "female", "all_levels", "all_reported", "incl_azad,incl_parttime,pnu_not_by_province", 8.0), (1, 4, 2): (1386, "THR", "total", "all_levels", "all_reported", "incl_azad,incl_parttime", 9.0),
        **{(2, r, c): (1384 + min(r, 2), "THR" if r == 4 else "IRN", "female" if c == 1 else "total", "all_levels", "all_reported", None, v) for r, c, v in ((1, 1, 5.0), (1, 2, 6.0), (2, 1, 7.0), (4, 1, 8.0), (4, 2, 9.0))},
    }
    assert sorted((r["r"], r["c"], r["value"], r["level"], r["university"], r["coverage"]) for r in out if r["t"] == 4) == [(i, c, v, "primary", None, []) for i, c, v in ((1, 1, 5.0), (1, 2, 6.0), (2, 1, 7.0), (4, 1, 8.0), (4, 1, 10.0), (4, 2, 9.0))]
    assert {r["metric"] for r in out} == {"students"}
