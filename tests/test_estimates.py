"""Effects, regressions with categories, quantiles, unions and nearest places against plain computations."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelstats.operators import places, statistics, unions
from panelstats.plans import k12

SF = "/root/testdata/sf0.001"


def test_swept_effects_equal_the_dense_ones(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(k, f"u{u}", t, float(rng.normal() + u / 3 + t), float(rng.normal() - t / 2)) for k in "ab" for u in range(7) for t in range(12) if rng.random() < 0.7]
    d = spark.createDataFrame(rows, "k string, unit string, t int, x double, y double")
    dense = {r["k"]: list(r)[1:] for r in statistics.fixed_effects(d, "unit", "t", "x", "y", ["k"]).collect()}
    monkeypatch.setattr(statistics, "DENSE", 3)
    swept = {r["k"]: list(r)[1:] for r in statistics.fixed_effects(d, "unit", "t", "x", "y", ["k"]).collect()}
    assert set(dense) == set(swept) == {"a", "b"} and all(None not in v for v in dense.values())
    for k in "ab":
        assert swept[k] == pytest.approx(dense[k], rel=1e-8, abs=1e-9)


def test_effects_panel_is_read_once(spark):
    clean = k12.cleaned(spark, SF)
    plan = k12.effects_panel(k12.panel.best_value(clean, k12.KEY), clean)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1


def test_regression_with_categories_equals_dense_matrices_under_every_replicate(spark):
    rng = np.random.default_rng(7)
    n = 300
    d = pd.DataFrame({"w": rng.integers(1, 4, n).astype(float), "x": rng.normal(size=n), "zone": rng.integers(0, 5, n), "rep": rng.integers(0, 2, n), "band": rng.choice(["<=10", "11-15", ">15"], n), "region": rng.integers(0, 3, n)})
    d["same"] = np.where(d.region == 1, "one", "other")  # collinear with the region's dummies
    for k in "pq":
        d[k] = 2 * d.x + (d.band == ">15") * 3 + d.region + rng.normal(size=n)
    out = {r["term"]: (r["slope"], r["se"]) for r in statistics.weighted_regression(spark.createDataFrame(d), "w", ["x"], ["p", "q"], "zone", "rep", ["band", "region", "same"]).collect()}
    names = ["constant", "x", "band=<=10", "band=>15", "region=1", "region=2"]
    assert set(out) == set(names)
    z = np.column_stack([np.ones(n), d.x, d.band == "<=10", d.band == ">15", d.region == 1, d.region == 2]).astype(float)
    fit = lambda w, y: np.linalg.lstsq(z * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)[0]
    betas, spread = [], []
    for k in "pq":
        whole = fit(d.w.to_numpy(), d[k].to_numpy())
        betas.append(whole)
        spread.append(sum((fit(np.where(d.zone == q, d.w * 2 * d.rep, d.w), d[k].to_numpy()) - whole) ** 2 for q in range(5)))
    se = np.sqrt(np.mean(spread, 0) + 1.5 * np.var(betas, 0, ddof=1))
    for i, term in enumerate(names):
        assert out[term] == pytest.approx((np.mean(betas, 0)[i], se[i]), abs=1e-8)


@pytest.mark.parametrize("cells", [4096, 7])
def test_quantiles_equal_percentile(spark, cells):
    rng = random.Random(cells)
    rows = [(rng.choice("ab"), rng.choice([None, 1.0, 1.0, 2.5, float(rng.randint(-50, 50)), rng.gauss(0, 1e6)])) for _ in range(600)] + [("one", 3.0), ("same", 4.0), ("same", 4.0), ("none", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    shares = [0.0, 0.02, 0.25, 0.5, 0.98, 1.0]
    got = {r["k"]: list(r)[1:] for r in statistics.exact_quantiles(df, ["k"], "v", shares, cells).collect()}
    want = {r["k"]: list(r)[1:] for r in df.filter("k IS NOT NULL AND v IS NOT NULL").groupBy("k").agg(F.count("*"), *[F.percentile("v", s) for s in shares]).collect()}
    assert set(got) == set(want) == {"a", "b", "one", "same"} and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
    assert list(statistics.exact_quantiles(df, [], "v", [0.5], cells).head())[1] == pytest.approx(df.agg(F.percentile("v", 0.5)).head()[0])


def test_unions_of_bitmaps(spark):
    rng = random.Random(9)
    rows = [(rng.choice("abcd"), rng.choice([None, f"w{rng.randrange(10**9)}", f"w{rng.randrange(40)}"])) for _ in range(3000)]
    df = unions.numbered(spark.createDataFrame(rows, "unit string, id string"), "id").persist()
    ids = {i for _, i in rows if i}
    assert {r["number"] for r in df.filter("id IS NOT NULL").select("number").distinct().collect()} == set(range(len(ids))) and df.filter("id IS NULL AND number IS NOT NULL").count() == 0
    maps = unions.bitmaps(df, ["unit"], "number")
    got = {r["unit"]: r["n"] for r in unions.sizes(maps, ["unit"]).collect()}
    assert got == {u: len({i for x, i in rows if x == u and i}) for u in "abcd"}
    pairs = {r["g"]: r["n"] for r in unions.sizes(unions.merged(maps, {"g": F.col("unit").isin("a", "b")}), ["g"]).collect()}
    assert pairs == {g: len({i for x, i in rows if (x in "ab") == g and i}) for g in (True, False)}
    df.unpersist()


def test_sets_side_by_side_without_sorting_rows(spark, monkeypatch):
    """Several sets of a unit in one pass, bits or-ed in hash tables, and more tasks for more ids."""
    monkeypatch.setattr(unions, "IDS", 100)
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(700) * 10**12]), rng.choice([True, False, None])) for _ in range(4000)] + [("c", 5, False), ("d", None, True)]
    df = unions.numbered(spark.createDataFrame(rows, "unit string, id long, far boolean"), "id")
    assert df.rdd.getNumPartitions() == -(-len({i for _, i, _ in rows if i is not None}) // 100)
    maps = unions.bitmaps(df, ["unit"], "number", {"all": F.lit(True), "far": F.col("far")})
    assert {r["unit"]: (r["all"], r["far"]) for r in unions.sizes(maps, ["unit"], sets=["all", "far"]).collect()} == {
        u: (len({i for x, i, _ in rows if x == u and i is not None}), len({i for x, i, f in rows if x == u and i is not None and f})) for u in ("a", "b", "c", None)}
    every = unions.sizes(unions.merged(maps, {"g": F.lit(1)}, ["all", "far"]), ["g"], sets=["all", "far"]).head()
    assert tuple(every) == (1, len({i for _, i, _ in rows if i is not None}), len({i for _, i, f in rows if i is not None and f}))
    plan = maps._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("stretch", [1.0, 0.75])
def test_nearest_equals_all_pairs(spark, stretch):
    rng = np.random.default_rng(11)
    sites = np.concatenate([rng.normal(size=(200, 2)), rng.normal(size=(20, 2)) * 100, np.round(rng.normal(size=(50, 2)) * 3)])
    points = np.concatenate([rng.normal(size=(100, 2)) * 50, np.round(rng.normal(size=(60, 2)) * 3), [[1e5, 1e5]]])
    frame = lambda name, p: spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(p)], f"{name} int, x double, y double")
    some = frame("id", points).unionByName(spark.createDataFrame([(9999, None, 1.0)], "id int, x double, y double"))
    got = {r["id"]: r["site"] for r in places.nearest(some, frame("site", sites), stretch).collect()}
    d = ((points[:, None, 0] - sites[None, :, 0]) * stretch) ** 2 + (points[:, None, 1] - sites[None, :, 1]) ** 2
    assert got.pop(9999) is None and got == {i: int(k) for i, k in enumerate(d.argmin(1))}
    assert [r["site"] for r in places.nearest(some.limit(2), frame("site", sites[:0])).collect()] == [None, None]
    assert {r["site"] for r in places.nearest(some.filter("x IS NOT NULL"), frame("site", sites[:1])).collect()} == {0}
