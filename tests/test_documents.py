"""Nested documents, readers of pages and files, printed tables, footnotes and names on small fixtures."""

import difflib
import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelstats import sources
from panelstats.functions import labels
from panelstats.operators import mapping, statistics, structure
from panelstats.operators.export import flattened, nested
from panelstats.plans import export, higher, k12, printed, research, validation
from panelstats.plans import mapping as plans_mapping
from panelstats.sources.html import cells, decoded


def test_nested_quotes_keys_names_null_and_has_no_empty_branch(spark):
    rows = [(1, 'A"x', "primary", 1.0, None), (1, "B\\", None, None, 2.0), (1, "C", "primary", None, None), (2, None, "é", 3.0, 4.0)]
    df = spark.createDataFrame(rows, "year int, province string, level string, a double, b double")
    docs = {r["year"]: json.loads(r["doc"]) for r in nested(df, ["year", "province", "level"], ["a", "b"]).collect()}
    assert docs == {1: {'A"x': {"primary": {"a": 1.0}}, "B\\": {"null": {"b": 2.0}}}, 2: {"null": {"é": {"a": 3.0, "b": 4.0}}}}
    back = flattened(nested(df, ["year", "province", "level"], ["a", "b"]), ["year", "province", "level"], {"a": "double", "b": "double"}).collect()
    assert sorted((r["province"], r["level"], r["field"], r["value"]) for r in back) == [('A"x', "primary", "a", "1.0"), ("B\\", "null", "b", "2.0"), ("null", "é", "a", "3.0"), ("null", "é", "b", "4.0")]
    assert nested(df.filter("false"), ["year", "province", "level"], ["a", "b"]).count() == 0


def test_html_cells_fill_spans_and_belong_to_the_innermost_table():
    page = "<table><tr><td rowspan=2>a<td>b &amp; c</td></tr><tr><td>d<table><tr><td colspan='2'>in</td></tr></table></td></tr></table><table><tr><th>x"
    assert cells(page) == [(0, 0, 0, "a"), (0, 0, 1, "b & c"), (0, 1, 0, "a"), (0, 1, 1, "d"), (1, 0, 0, "in"), (1, 0, 1, "in"), (2, 0, 0, "x")]
    assert cells("") == cells("<p>no table</p>") == []


@pytest.mark.parametrize(("page", "want"), [(None, ""), ("é", "é"), ("é".encode(), "é"), ("ج".encode("cp1256"), "ج"), (b'<meta charset="windows-1256">' + "ج".encode("cp1256"), "ج"), (b"<meta http-equiv='x' content='text/html; charset=iso-8859-1'>\xe9", "é"), (b'<meta charset="no-such">' + "é".encode(), "é"), (b'<meta charset="utf-8">' + "ج".encode("cp1256"), "ج")])
def test_charset_of_a_page(page, want):
    assert decoded(page).endswith(want)


def test_other_spellings_and_divided_provinces(spark):
    rows = spark.createDataFrame([("باختران",), ("خراسان (1)",), ("کل کشور جمع",)], "text string")
    got = {r["text"]: r["unit"] for r in mapping.paint(mapping.match_province(rows).withColumnRenamed("province", "unit"), "unit", spark.createDataFrame(mapping.HISTORIC, "unit string, successors array<string>")).filter("unit <> 'KHS' AND unit <> 'KHJ'").collect()}
    assert got == {"باختران": "KSH", "خراسان (1)": "KHR", "کل کشور جمع": "IRN"}


def test_html_pages_without_tables_or_text(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, '<option value="">none</option><option value="7">Tehran Province (12)</option><option value="8">44</option>')], "page_id long, html string")
    assert sources.html_tables(pages).count() == 0
    assert [tuple(r) for r in sources.html_options(pages, stop_word="Province").collect()] == [(3, "7", "Tehran", 12)]


def test_rankings_with_mark_of_byte_order(spark, tmp_path):
    (tmp_path / "r.csv").write_text('﻿Rank;Title;SJR;Issn\n1;"A; ""B""";"1.234,5";"12345678, 8765432X"\n2;C;0,75;""\n', encoding="utf-8")
    got = sources.read_rankings(spark, f"file://{tmp_path}/r.csv", ["SJR"], ["Issn"]).orderBy("Rank").collect()
    assert got[0]["Title"] == 'A; "B"' and got[0]["Issn"] == ["12345678", "8765432X"] and got[1]["SJR"] == 0.75 and not got[1]["Issn"]


def test_series_that_are_not_verified_are_no_measurements(spark, tmp_path):
    (tmp_path / "s.csv").write_text("year,value,verified\n1400,1.5,true\n1401,2.5,false\n")
    read = lambda only: sources.read_series(spark, f"file://{tmp_path}/s.csv", "year int, value double, verified boolean", only).count()
    assert read(True) == 1 and read(False) == 2


def one(spark, column, *values, names="abcdef"):
    row = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names[: len(values)]))
    return row.select(column).head()[0]


@pytest.mark.parametrize(("note", "want"), [("1) به استثنای دانشگاه آزاد", (1, "به استثنای دانشگاه آزاد")), ("(۲) متن", (2, "متن")), ("ماخذ: مرکز آمار", None), ("شامل همه", (None, "شامل همه")), (None, (None, ""))])
def test_parse_note(spark, note, want):
    got = one(spark, labels.parse_note(F.col("a")), note)
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize(("notes", "year", "want"), [
    (["به استثنای دانشگاه آزاد اسلامی"], 1390, ["excl_azad"]), (["آمار دانشگاه آزاد را به استثنای سال تحصیلی 86-1385 شامل می‌شود"], 1385, ["excl_azad"]), (["آمار دانشگاه آزاد را به استثنای سال تحصیلی 86-1385 شامل می‌شود"], 1386, ["incl_azad"]),
    (["دانشگاه آزاد نیز شامل می شود", "بجز دانشگاه آزاد"], 1390, ["excl_azad"]), (["شامل نیمه وقت", "پیام نور به تفکیک استان موجود نیست"], 1390, ["incl_parttime", "pnu_not_by_province"]), (["دانشگاه علمی کاربردی را شامل نمی‌شود"], 1390, ["excl_uast"]), ([], 1390, []),
])
def test_coverage_flags(spark, notes, year, want):
    row = spark.createDataFrame([(notes, year)], "n array<string>, y int")
    assert [x for x in row.select(labels.coverage_flags(F.col("n"), F.col("y"))).head()[0] if "uast" not in x or x in want] == want


@pytest.mark.parametrize(("title", "want"), [("دانش آموزان ابتدایی", "k12"), ("دانشجویان دوره پیش دانشگاهی", "he"), ("پیش دانشگاهی", "k12"), ("تربیت معلم", "teacher_training"), ("تربیت معلم دانشگاه", "he"), ("بودجه مدارس", "other"), (None, "other")])
def test_domain(spark, title, want):
    assert one(spark, mapping.classify_domain(F.col("a")), title) == want


@pytest.mark.parametrize(("text", "want"), [("7-3- دانش آموزان", True), ("45- دانش آموزان کشور", True), ("45- کوتاه", False), ("دانش آموزان", False), (None, False)])
def test_is_title(spark, text, want):
    assert one(spark, labels.is_title(F.col("a")), text) is want


def test_match_rules_prefers_the_first_and_keeps_domains_apart(spark):
    texts = spark.createDataFrame([("متو سطه اول", "k12"), ("متوسطه", "k12"), ("متوسطه", "he"), ("زنجان", "k12"), ("زن", "k12")], "text string, domain string")
    got = {(r["text"], r["domain"], r["dim"]): r["value"] for r in mapping.match_rules(texts, mapping.terms(spark)).collect()}
    assert got == {("متو سطه اول", "k12", "level"): "lower_secondary", ("متوسطه", "k12", "level"): "upper_secondary", ("زن", "k12", "gender"): "female"}


def test_provinces_by_their_names(spark):
    got = {r["text"]: r["province"] for r in mapping.match_province(spark.createDataFrame([("آذربايجان شرقی (1)",), ("کهگیلویه  و بویراحمد",), ("کل کشور",), ("ناکجا",), (None,)], "text string")).collect()}
    assert got == {"آذربايجان شرقی (1)": "AZS", "کهگیلویه  و بویراحمد": "KBA", "کل کشور": "IRN"}


def test_grid_with_labels_on_the_right(spark):
    grid = [["جمع", "مرد", "شرح"], ["", "", ""], ["10", "4", "تهران"], ["-", "5", "قم"], ["", "", ""]]
    df = spark.createDataFrame([(1, r, c, x) for r, row in enumerate(grid) for c, x in enumerate(row)] + [(2, 0, 0, "only"), (2, 1, 0, "column")], "t int, r int, c int, x string")
    out = structure.laid_out(structure.clean_grid(df))
    assert {(r["t"], r["label_c"], r["depth"]) for r in out.collect()} == {(1, 2, 2)}
    assert {(r["c"], r["path"]) for r in structure.header_paths(out).collect()} == {(0, "جمع"), (1, "مرد")}
    assert sorted((r["label"], [v["number"] for v in r["values"]]) for r in structure.body_rows(out).collect()) == [("تهران", [10.0, 4.0]), ("قم", [None, 5.0])]


def test_text_line(spark):
    got = one(spark, structure.text_line(F.col("a")), "۱۲ ۳,۴۵۶ - تهران (1)")
    assert got["label"] == "تهران (1)" and got["values"] == ["-", "3456", "12"]


def test_fuzzy_match_equals_all_pairs(spark):
    left, right = ["tehran univ", "Tehran University", "sharif", "zzz", "shiraz universty", ""], ["Tehran University", "Sharif", "Shiraz University", "Yazd"]
    got = {r["name"]: r["match"] for r in mapping.fuzzy_match(*[spark.createDataFrame([(x,) for x in names], "name string") for names in (left, right)]).collect()}
    for a in left:
        best = max((difflib.SequenceMatcher(None, b.lower(), a.lower()).ratio(), b) for b in right)
        assert got[a] == (best[1] if best[0] >= 0.82 else None)


def test_weighted_regression_equals_dense_matrices(spark):
    rng = np.random.default_rng(3)
    d = pd.DataFrame({"w": rng.integers(1, 4, 200).astype(float), "x": rng.normal(size=200), "g": rng.integers(0, 2, 200).astype(float), "zone": rng.integers(0, 6, 200), "rep": rng.integers(0, 2, 200)})
    for k in "pq":
        d[k] = 2 * d.x - d.g + rng.normal(size=200)
    got = {r["term"]: (r["slope"], r["se"]) for r in statistics.weighted_regression(spark.createDataFrame(d), "w", ["x", "g"], ["p", "q"], "zone", "rep").collect()}
    z = np.column_stack([np.ones(200), d.x, d.g])
    fit = lambda w, y: np.linalg.solve((z * w[:, None]).T @ z, (z * w[:, None]).T @ y)
    betas, spread = [], []
    for k in "pq":
        whole = fit(d.w.to_numpy(), d[k].to_numpy())
        replicates = [fit(np.where(d.zone == q, d.w * 2 * d.rep, d.w), d[k].to_numpy()) for q in range(6)]
        betas.append(whole)
        spread.append(sum((r - whole) ** 2 for r in replicates))
    se = np.sqrt(np.mean(spread, 0) + 1.5 * np.var(betas, 0, ddof=1))
    for i, term in enumerate(["constant", "x", "g"]):
        assert got[term] == pytest.approx((np.mean(betas, 0)[i], se[i]), abs=1e-9)


def test_bridge_uses_each_row_once(spark):
    f = lambda rows, schema: spark.createDataFrame(rows, schema)
    out = mapping.bridge(f([("a", 1), ("a", 2), ("b", 3)], "x string, code int"), f([("a", "A"), ("b", "A")], "x string, y string"), f([("A", 9)], "y string, area int"), "x", "y").collect()
    assert len(out) == 1 and out[0]["code"] == 1


def test_name_bridge_names_every_nation(spark):
    sf = "/root/testdata/sf0.01"
    got = plans_mapping.QUERIES["J15_name_bridge"](spark, sf).collect()
    nations = spark.read.parquet(f"{sf}/supplier.parquet").select("s_nationkey").distinct().count()
    assert len(got) == len({r["s_nationkey"] for r in got}) == nations > 5


@pytest.mark.parametrize("name", ["W4_k12_growth", "J12_offsets", "J10_rank_mix", "C8_table_status", "J7_cohort_completion", "E4_outcomes", "E5_relations", "A12_union_sizes", "J18_nearest_capital"])
def test_plans_read_each_table_a_few_times_at_most(spark, name):
    plan = {**k12.QUERIES, **higher.QUERIES, **validation.QUERIES, **export.QUERIES, **research.QUERIES}[name](spark, "/root/testdata/sf0.001")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Scan parquet") <= 8


@pytest.mark.parametrize("of", [labels.is_numeric_cell, labels.to_number, labels.parse_note, lambda c: structure.laid_out(c)])
def test_cells_are_read_by_small_expressions(spark, of):
    # A value that stands in an expression many times makes more code than is compiled, and every row is slow.
    cells = spark.createDataFrame([(1, 0, 0, "a")], "t int, r int, c int, x string")
    plan = (of(cells) if of.__name__ == "<lambda>" else cells.select(of(F.col("x")).alias("y")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") <= 12


@pytest.mark.parametrize(("text", "number", "numeric"), [("000", None, True), ("0", 0.0, True), ("12/34", 34.12, True), ("12/34\n", 34.12, True), ("۱۲", 12.0, True), ("１2", 12.0, True), ("1,200 (3)", 1200.0, True), ("-5", -5.0, True), ("…", None, True), ("متن", None, False), ("متن 5", None, False), ("", None, True), ("1.", 1.0, True), ("1/2/3", None, False), (None, None, True)])
def test_numbers_of_cells(spark, text, number, numeric):
    assert (one(spark, labels.to_number(F.col("a")), text), one(spark, labels.is_numeric_cell(F.col("a")), text)) == (number, numeric)


def test_pages_are_parsed_a_few_at_a_time(spark):
    n = 3 * sources.PAGES_AT_ONCE + 1
    pages = spark.range(n, numPartitions=1).select(F.col("id").alias("page_id"), F.concat(F.lit("<table><tr><td>"), "id", F.lit("<td>x</table>")).alias("html"))
    out = sources.html_tables(pages)
    assert "MapInArrow" in out._jdf.queryExecution().executedPlan().toString()  # frames of 10,000 pages took gigabytes
    assert sorted((r["page_id"], r["c"], r["text"]) for r in out.collect()) == sorted(x for i in range(n) for x in ((i, 0, str(i)), (i, 1, "x")))


def test_rows_of_a_grid_are_aggregated_before_the_shuffle(spark):
    plan = plans_mapping.QUERIES["T1_clean_grid"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_count" in plan


def test_body_forms_agree(spark):
    """Cells, rows and written rows of the body are the same on ragged grids with the label on either side, a cell that is printed twice and rows without label or number."""
    rng = random.Random(9)
    cells = [(t, r, c, rng.choice(["تهران", "قم", "۱۲", "3/4", "-", "", None, "1398-1399", "5(1)"]) if c != 4 * (t % 2) else rng.choice(["قم", "یزد", ""])) for t in range(12) for r in range(9) for c in range(5) if rng.random() < 0.9]
    grid = structure.clean_grid(spark.createDataFrame([*cells, (0, 3, 1, "7")], "t int, r int, c int, x string"), edges=True)
    out = structure.laid_out(grid).persist()
    assert sorted(map(str, out.collect())) == sorted(map(str, structure.laid_out(grid.drop("_first", "_last")).collect()))
    key = lambda df: sorted(map(str, df.collect()))
    rows = structure.by_row(out)
    assert key(structure.body_of(rows)) == key(structure.body_rows(out)) and out.select("t").distinct().count() > 4
    assert key(structure.body_cells(out).selectExpr("t", "r", "label", "c", "number")) == key(structure.body_rows(out).select("t", "r", "label", F.inline("values")))
    assert key(structure.header_paths(structure.header_cells(rows))) == key(structure.header_paths(out))


def test_printed_bodies_are_passed_over_few_times(spark):
    """one sort of the cells after their shuffle by table, five windows, and no arrays that are made and taken apart again."""
    plan = printed.QUERIES["T5_body_rows"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") <= 6 and "collect_list" not in plan and "Generate inline" not in plan
