import unicodedata

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelstats.functions import labels
from panelstats.operators import checks, panel, statistics
from panelstats.operators.export import nested

FACT = "year int, province string, level string, metric string, gender string, value double, yearbook int, source_file string, source_table string, header_source string"


def fact(year, province, value, yearbook, table="t", header="document"):
    return (year, province, "primary", "students", "total", float(value), yearbook, f"{yearbook}/book", table, header)


def test_best_value_prefers_own_year_then_agreement(spark):
    rows = [fact(1390, "THR", 10, 1390), fact(1390, "THR", 11, 1391), fact(1391, "THR", 5, 1392), fact(1391, "THR", 7, 1393), fact(1391, "THR", 7, 1394), fact(1392, "THR", 1, 1391)]
    best = {r["year"]: r["value"] for r in panel.best_value(spark.createDataFrame(rows, FACT), ["year", "province", "level", "metric", "gender"]).collect()}
    assert best == {1390: 10.0, 1391: 7.0}  # a release older than the year never counts


def test_best_value_does_not_depend_on_the_order_of_rows(spark):
    rows = [fact(1390, p, v, y, t) for p in ("A", "B") for v, y, t in ((1, 1391, "x"), (2, 1391, "y"), (2, 1392, "z"), (1, 1393, "x"))]
    keys = ["year", "province", "level", "metric", "gender"]
    a = sorted(map(str, panel.best_value(spark.createDataFrame(rows, FACT), keys).collect()))
    assert a == sorted(map(str, panel.best_value(spark.createDataFrame(rows[::-1], FACT).repartition(3), keys).collect()))


def test_quality_gate_withholds_a_group_but_not_the_nation(spark):
    rows = spark.createDataFrame([(1, "A", 1.2), (1, "B", 0.1), (1, "C", 0.9), (1, "IRN", 0.9), (2, "A", 0.9), (2, "B", 1.3)], "year int, province string, rate_raw double")
    national = F.col("province") == "IRN"
    got = {(r["year"], r["province"]): (r["status"], r["rate"]) for r in panel.quality_gate(rows, "rate", ["year"], 0.5, 1.0, ~national, national).collect()}
    assert got[1, "C"] == ("year_unreliable", None) and got[1, "IRN"] == ("ok", 0.9) and got[2, "A"] == ("ok", 0.9) and got[2, "B"] == ("implausible_rate", None)


def test_year_ranges(spark):
    rows = spark.createDataFrame([("a", y) for y in (1380, 1381, 1382, 1390, 1390)], "k string, year int")
    assert panel.year_ranges(rows, ["k"]).head()["years"] == "1380-1382,1390"


def test_gender_sum_drops_incomplete_rows(spark):
    rows = [("f", "t", "A", "students", g, v) for g, v in (("total", 100.0), ("male", 60.0), ("female", 41.0))] + [("f", "t", "B", "students", "total", 5.0)]
    out = checks.gender_sum(spark.createDataFrame(rows, "source_file string, source_table string, province string, metric string, gender string, value double"), ["province", "metric"]).collect()
    assert [(r["expected"], r["actual"], r["ok"]) for r in out] == [(101.0, 100.0, True)]


@pytest.mark.parametrize(("text", "want"), [("۱٬۲۳۴", 1234), ("٥٦٧", 567), ("12,345", 12345), ("886(1)", 886), ("-", None), ("…", None), ("×", None), ("000", None), ("7/28", 28.7), ("abc", None), (None, None)])
def test_to_number(spark, text, want):
    assert spark.createDataFrame([(text,)], "s string").select(labels.to_number(F.col("s"))).head()[0] == want


def test_to_number_unswapped(spark):
    assert spark.createDataFrame([("28/7",)], "s string").select(labels.to_number(F.col("s"), False)).head()[0] == 28.7


@pytest.mark.parametrize(("text", "want"), [("99-1398", 1398), ("1398-1399", 1398), ("81-1380(2)", 1380), ("66-1365..", 1365), ("۱۳۹۸", 1398), ("تهران", None), ("آبان 1375", None)])
def test_parse_academic_year(spark, text, want):
    assert spark.createDataFrame([(text,)], "s string").select(labels.parse_academic_year(F.col("s"))).head()[0] == want


def test_norm_makes_spellings_equal(spark):
    rows = spark.createDataFrame([("هيأت علمي",), ("هیات علمی",), ("هیئت علمی",)], "s string").select(labels.norm(F.col("s"))).collect()
    assert len({r[0] for r in rows}) == 1


def test_printed_forms_compose(spark):
    rows = [("\ufee3\ufeaa\ufead\ufeb3\ufeea",), ("\ufefb",), ("\uff11\uff12",), ("\u0627\u0653",), ("\u0648\u0654",), ("plain",)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(labels.composed(F.col("s"))).collect()]
    assert got == [unicodedata.normalize("NFKC", t) for (t,) in rows]


def test_best_quartile_and_markers(spark):
    row = spark.createDataFrame([("A (Q3); B (Q1)", "Q2", "name (1و2)")], "c string, q string, m string").select(labels.best_quartile(F.col("c"), F.col("q")), labels.best_quartile(F.lit("A (-)"), F.col("q")), labels.markers(F.col("m"))).head()
    assert list(row) == ["Q1", "Q2", [1, 2]]


def test_fixed_effects_equal_a_dense_regression(spark):
    rng = np.random.default_rng(1)
    rows = [(f"u{u}", t, float(rng.normal() + u / 3 + t / 7)) for u in range(9) for t in range(7) if (u + t) % 5]
    d = pd.DataFrame(rows, columns=["unit", "t", "x"])
    d["y"] = 0.7 * d.x + d.groupby("unit").ngroup() * 0.2 - d.t * 0.1 + rng.normal(size=len(d)) * 0.3
    got = statistics.fixed_effects(spark.createDataFrame(d), "unit", "t", "x", "y").head()
    units, times = pd.get_dummies(d.unit, dtype=float).to_numpy(), pd.get_dummies(d.t, drop_first=True, dtype=float).to_numpy()
    z = np.column_stack([d.x, units, times])
    inverse = np.linalg.inv(z.T @ z)
    beta = inverse @ z.T @ d.y
    e = d.y - z @ beta
    meat = sum(np.outer(s, s) for s in (z[d.unit == u].T @ e[d.unit == u] for u in d.unit.unique()))
    g, n, k = d.unit.nunique(), len(d), z.shape[1]
    se = np.sqrt((inverse @ meat @ inverse)[0, 0] * g / (g - 1) * (n - 1) / (n - k))
    assert got["coef"] == pytest.approx(beta[0], abs=1e-9) and got["se"] == pytest.approx(se, abs=1e-9)


def test_fixed_effects_of_groups_are_those_of_each_alone(spark):
    rng = np.random.default_rng(2)
    rows = [(k, f"u{u}", t, float(rng.normal() + u / 3), float(rng.normal() + t)) for k in "abc" for u in range(8) for t in range(9) if (u + t) % 5 and not (k == "b" and t < 3) and not (k == "c" and t > 3)]
    d = spark.createDataFrame(rows, "k string, unit string, t int, x double, y double")
    got = {r["k"]: list(r)[1:] for r in statistics.fixed_effects(d, "unit", "t", "x", "y", ["k"]).collect()}
    assert set(got) == {"a", "b", "c"} and got["c"][3] is None and None not in got["a"] + got["b"]
    for k in "ab":
        assert got[k] == pytest.approx(list(statistics.fixed_effects(d.filter(f"k = '{k}'"), "unit", "t", "x", "y").head()))
    assert statistics.t_tail(2.262157, 9) == pytest.approx(0.05, abs=1e-6) and statistics.t_bound(0.05, 24) == pytest.approx(2.063899, abs=1e-5)


def test_fixed_effects_query_has_every_level_and_sample(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["X3_fixed_effects"](spark, "/root/testdata/sf0.01").collect()
    assert {r["spec"] for r in rows} == {"all_valid_years", "excl_reform", "from_break"} and len({r["level"] for r in rows}) == 5
    assert len(rows) == 15 and any(r["p"] is not None for r in rows)


def test_fixed_effects_gate(spark):
    assert statistics.fixed_effects(spark.createDataFrame([("a", 1, 1.0, 1.0)], "unit string, t int, x double, y double"), "unit", "t", "x", "y").head()["coef"] is None


def test_jackknife_equals_replicates_one_by_one(spark):
    rng = np.random.default_rng(2)
    d = pd.DataFrame({"zone": rng.integers(0, 6, 200), "rep": rng.integers(0, 2, 200), "w": rng.random(200) + 0.5, "p1": rng.normal(size=200), "p2": rng.normal(size=200)})
    got = statistics.jackknife_mean(spark.createDataFrame(d), "w", ["p1", "p2"], "zone", "rep").head()
    means, variances = [], []
    for p in ("p1", "p2"):
        mean = np.average(d[p], weights=d.w)
        means.append(mean)
        variances.append(sum((np.average(d[p], weights=np.where(d.zone == z, np.where(d.rep == 1, 2 * d.w, 0), d.w)) - mean) ** 2 for z in range(6)))
    assert got["estimate"] == pytest.approx(np.mean(means)) and got["se"] == pytest.approx(np.sqrt(np.mean(variances) + 1.5 * np.var(means, ddof=1)))


def test_nested_document_leaves_nulls_out(spark):
    import json

    rows = spark.createDataFrame([(1, "A", "x", 1.0, None), (1, "A", "y", None, None), (1, "B", "x", 2.0, 3.0)], "year int, province string, level string, a double, b double")
    assert json.loads(nested(rows, ["year", "province", "level"], ["a", "b"]).head()["doc"]) == {"A": {"x": {"a": 1.0}}, "B": {"x": {"a": 2.0, "b": 3.0}}}
