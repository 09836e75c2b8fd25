"""Documents for publication: nested exports, flags and metadata, and the readers and writers around them."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelstats import sources
from panelstats.operators import mapping, statistics
from panelstats.operators.export import flattened, nested
from panelstats.operators.panel import safe_ratio
from panelstats.plans import higher, k12
from panelstats.plans.k12 import _BEST as K12
from panelstats.plans.k12 import _PANEL as PANEL
from panelstats.sources import shared_dir, table, written
from panelstats.sources.adapters import HIGHER, SOURCES, adapted

QUERIES, ORACLES = {}, {}
GENDERS = ("total", "male", "female")
#: The dictionary of flags.
FLAGS = {
    "unit_undivided": "a unit is printed before its division", "unit_in_parent": "a unit is still part of its parent", "school_reform": "grades move between levels", "teacher_proxy": "educational staff stand for teachers",
    "completion_mixed_degree_lengths": "degrees of several lengths", "completion_pandemic_window": "the time of the cohort meets the pandemic", "completion_provinces_withheld": "provinces do not add up", "coverage_separate": "two populations are printed apart",
    "coverage_all": "one population is printed", "rank_not_split_by_gender": "ranks have totals only", "azad_doctorate_bundled": "doctorates are not told apart",
}


def query(sql: str | None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


# ---- schools

_UNITS = K12 + """,
level_cells AS (SELECT year, province, level, any_value(value) FILTER (metric = 'students' AND gender = 'total') AS total, any_value(value) FILTER (metric = 'students' AND gender = 'male') AS male, any_value(value) FILTER (metric = 'students' AND gender = 'female') AS female,
  ifnull(any_value(value) FILTER (metric = 'teachers'), any_value(value) FILTER (metric = 'educational_staff')) AS used FROM best WHERE programme = 'regular' AND level IN ('primary', 'lower_secondary', 'upper_secondary', 'all_levels') GROUP BY ALL),
level_units AS (SELECT * FROM level_cells UNION ALL SELECT year, province, 'core_three', if(count(total + used) = 3, sum(total), NULL), if(count(male) = 3, sum(male), NULL), if(count(female) = 3, sum(female), NULL), if(count(total + used) = 3, sum(used), NULL) FROM level_cells WHERE level <> 'all_levels' GROUP BY ALL),
leaves AS (SELECT year, province, level, unnest(['total', 'male', 'female', 'total', 'total']) AS gender, unnest(['students', 'students', 'students', 'teachers', 'students_per_teacher']) AS field, unnest([total, male, female, used, total / nullif(used, 0)]) AS value FROM level_units)"""
_K12_KEYS, _K12_FIELDS = ["year", "province", "level", "gender"], {"students": "double", "teachers": "double", "students_per_teacher": "double"}


def k12_rows(best: DataFrame) -> DataFrame:
    """(year, province, level, gender, students, teachers, students_per_teacher) of the core levels, of the printed row of all
    levels (J11) and of the three core levels together where all are there (A10): every core row counts for its level and for the three."""
    m, g = F.col("metric"), F.col("gender")
    levels = best.filter(F.col("level").isin(*k12.CORE, "all_levels") & (F.col("programme") == "regular"))
    value = lambda c: F.max(F.when(c, F.col("value")))
    cells = levels.groupBy("year", "province", "level").agg(*[value((m == "students") & (g == x)).alias(x) for x in GENDERS], F.coalesce(value(m == "teachers"), value(m == "educational_staff")).alias("used"))
    unit = F.explode(F.when(F.col("level") == "all_levels", F.array("level")).otherwise(F.array("level", F.lit("core_three"))))
    cells = cells.withColumn("both", F.col("total") + F.col("used")).withColumn("unit", unit)
    sums = cells.groupBy("year", "province", F.col("unit").alias("level")).agg(*[F.struct(F.sum(c).alias("s"), F.count(c).alias("n")).alias(c) for c in (*GENDERS, "used", "both")])
    three = F.col("level") == "core_three"
    whole = ~three | (F.col("both.n") == 3)
    said = {x: F.when(~three | (F.col(f"{x}.n") == 3), F.col(f"{x}.s")) for x in ("male", "female")} | {"total": F.when(whole, F.col("total.s"))}
    used = F.when(whole, F.col("used.s"))
    none = F.lit(None).cast("double")
    rows = F.array(*[F.struct(F.lit(x).alias("gender"), said[x].alias("students"), (used if x == "total" else none).alias("teachers"), (safe_ratio(said[x], used) if x == "total" else none).alias("students_per_teacher")) for x in GENDERS])
    return sums.select("year", "province", "level", F.inline(rows))


@query(_UNITS + " SELECT year, province, level, gender, field, value FROM leaves WHERE value IS NOT NULL")
def E1_k12_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The school document, nested by year, province, level and gender (E6: no empty branch), and read back."""
    docs = nested(k12_rows(k12.best(spark, sf_dir)), _K12_KEYS, list(_K12_FIELDS))
    return flattened(docs, _K12_KEYS, _K12_FIELDS).withColumn("value", F.col("value").cast("double"))


@query(_UNITS + " SELECT year, province, total AS students, used AS teachers, total / nullif(used, 0) AS students_per_teacher FROM level_cells WHERE level = 'all_levels' AND total IS NOT NULL")
def J11_all_levels_row(spark, sf_dir):
    """The printed row of all levels, its measures side by side."""
    return k12_rows(k12.best(spark, sf_dir)).filter("level = 'all_levels' AND gender = 'total' AND students IS NOT NULL").drop("level", "gender")


@query(_UNITS + f"""SELECT year, count(DISTINCT province) FILTER (province <> 'IRN') AS n_provinces, array_to_string(list_filter([if(bool_or(province = 'N3'), 'unit_undivided', NULL), if(NOT bool_or(province = 'N7'), 'unit_in_parent', NULL), if(year IN {k12.REFORM}, 'school_reform', NULL), if(bool_or(proxy), 'teacher_proxy', NULL)], lambda x: x IS NOT NULL), ',') AS flags,
ifnull(array_to_string(list_sort(list_distinct(list(level) FILTER (proxy))), ','), '') AS proxy_levels FROM (SELECT year, province, level, NOT coalesce(bool_or(metric = 'teachers'), false) AND bool_or(metric = 'educational_staff') AS proxy FROM best WHERE programme = 'regular' AND level IN ('primary', 'lower_secondary', 'upper_secondary') GROUP BY ALL) GROUP BY year""".replace("SELECT year, count(DISTINCT", " SELECT year, count(DISTINCT", 1))
def A5_year_flags(spark, sf_dir):
    """Metadata of every year: provinces, flags, and levels whose teachers are a proxy."""
    m, p = F.col("metric"), F.col("province")
    rows = k12.best(spark, sf_dir).filter(F.col("level").isin(k12.CORE) & (F.col("programme") == "regular"))
    rows = rows.groupBy("year", "province", "level").agg((~F.max(m == "teachers") & F.max(m == "educational_staff")).alias("proxy"))
    flags = [F.when(F.max(p == "N3"), "unit_undivided"), F.when(~F.max(p == "N7"), "unit_in_parent"), F.when(F.first("year").between(*k12.REFORM), "school_reform"), F.when(F.max("proxy"), "teacher_proxy")]
    return rows.groupBy("year").agg(F.count_distinct(F.when(p != "IRN", p)).alias("n_provinces"), F.array_join(F.array_compact(F.array(*flags)), ",").alias("flags"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("proxy"), F.col("level")))), ",").alias("proxy_levels"))


# ---- higher education

_HE_KEYS, _HE_FIELDS = ["year", "province", "university", "degree", "gender"], {"students": "double", "academic_staff": "double", "students_per_staff": "double"}


def he_rows(spark, sf_dir) -> DataFrame:
    students = higher.he(spark, sf_dir).filter("metric = 'students'").select(*_HE_KEYS, F.col("value").alias("students"), F.lit(None).cast("double").alias("academic_staff"))
    staff = higher.W11_preferred_employment(spark, sf_dir).select("year", "province", "university", F.lit("all").alias("degree"), F.lit("total").alias("gender"), F.lit(None).cast("double").alias("students"), F.col("value").alias("academic_staff"))
    rows = students.unionByName(staff).groupBy(*_HE_KEYS).agg(F.max("students").alias("students"), F.max("academic_staff").alias("academic_staff"))
    return rows.withColumn("students_per_staff", safe_ratio("students", "academic_staff"))


@query(higher._BEST + """,
heads AS (SELECT year, province, university, degree, gender, value AS students FROM he WHERE metric = 'students'),
chosen AS (SELECT year, province, university, 'all' AS degree, 'total' AS gender, arg_min(value, list_position(['fulltime', 'both'], employment)) AS academic_staff FROM staff WHERE staff_rank = 'all' GROUP BY ALL),
joined AS (SELECT * FROM heads FULL JOIN chosen USING (year, province, university, degree, gender))
SELECT * FROM (SELECT year, province, university, degree, gender, unnest(['students', 'academic_staff', 'students_per_staff']) AS field, unnest([students, academic_staff, students / nullif(academic_staff, 0)]) AS value FROM joined) WHERE value IS NOT NULL""")
def E2_he_leaves(spark, sf_dir):
    """The higher-education document by type, degree and gender, and read back; the ratio stands where both sides do."""
    docs = nested(he_rows(spark, sf_dir), _HE_KEYS, list(_HE_FIELDS))
    return flattened(docs, _HE_KEYS, _HE_FIELDS).withColumn("value", F.col("value").cast("double"))


_QUALITY_KEYS, _QUALITY_FIELDS = ["year", "province", "section", "item"], {"value": "double", "status": "string"}


def quality_rows(spark, sf_dir) -> DataFrame:
    """Completion, rank mix and degree mix as rows; a value that is not ok has only its status."""
    ok = lambda c: F.when(F.col("status") == "ok", F.col(c)).alias("value")
    item = lambda *c: F.concat_ws("/", *c).alias("item")
    facts = higher.J7_cohort_completion(spark, sf_dir)
    completion = facts.select("year", "province", F.lit("completion").alias("section"), item("university", "degree", "length_basis", "gender"), ok("completion_ratio"), "status")
    ranks = higher.J10_rank_mix(spark, sf_dir).select("year", "province", F.lit("rank_mix").alias("section"), item("university", "employment"), ok("senior_share"), "status")
    mix = higher.trend(spark, sf_dir).select("year", "province", F.lit("degree_mix").alias("section"), item("university"), ok("share_postgraduate"), "status")
    return completion.unionByName(ranks).unionByName(mix)


_QUALITY = ", ".join(f"{n} AS ({ORACLE})" for n, ORACLE in (("q7", higher.ORACLES["J7_cohort_completion"]), ("q10", higher.ORACLES["J10_rank_mix"]), ("q9", higher.ORACLES["J9_degree_mix_trend"])))


@query(f"""WITH {_QUALITY},
r AS (SELECT year, province, 'completion' AS section, concat_ws('/', university, degree, length_basis, gender) AS item, completion_ratio AS value, status FROM q7 UNION ALL SELECT year, province, 'rank_mix', concat_ws('/', university, employment), senior_share, status FROM q10
  UNION ALL SELECT year, province, 'degree_mix', university, share_postgraduate, status FROM q9)
SELECT year, province, section, item, if(status = 'ok', value, NULL) AS value, status FROM r""")
def E3_he_quality(spark, sf_dir):
    rows = nested(quality_rows(spark, sf_dir), _QUALITY_KEYS, list(_QUALITY_FIELDS))
    leaves = flattened(rows, _QUALITY_KEYS, _QUALITY_FIELDS).groupBy(*_QUALITY_KEYS).agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).cast(t).alias(f) for f, t in _QUALITY_FIELDS.items()])
    return leaves


@query(f"""WITH {_QUALITY},
r AS (SELECT year, 'completion' AS section, [if(university = '{higher.BOTH}', 'completion_mixed_degree_lengths', NULL), if(pandemic_in_window = 1, 'completion_pandemic_window', NULL), if(status = 'province_sum_mismatch', 'completion_provinces_withheld', NULL), if(year < {higher.SERIES_BREAK}, 'coverage_separate', 'coverage_all')] AS f FROM q7
  UNION ALL SELECT year, 'rank_mix', ['rank_not_split_by_gender', if(year < {higher.SERIES_BREAK}, 'coverage_separate', 'coverage_all')] FROM q10 UNION ALL SELECT year, 'degree_mix', [if(year < {higher.SERIES_BREAK}, 'azad_doctorate_bundled', NULL), if(year < {higher.SERIES_BREAK}, 'coverage_separate', 'coverage_all')] FROM q9)
SELECT year, section, string_agg(DISTINCT flag, ',' ORDER BY flag) AS flags FROM (SELECT year, section, unnest(f) AS flag FROM r) WHERE flag IS NOT NULL GROUP BY ALL""")
def A31_section_flags(spark, sf_dir):
    """Flags of every year and section of the quality document."""
    return section_flags(spark, sf_dir).groupBy("year", "section").agg(F.array_join(F.array_sort(F.collect_set("flag")), ",").alias("flags"))


def section_flags(spark, sf_dir) -> DataFrame:
    early = F.col("year") < higher.SERIES_BREAK
    cover = F.when(early, "coverage_separate").otherwise("coverage_all")
    each = {
        "completion": (higher.J7_cohort_completion, [F.when(F.col("university") == higher.BOTH, "completion_mixed_degree_lengths"), F.when(F.col("pandemic_in_window") == 1, "completion_pandemic_window"), F.when(F.col("status") == "province_sum_mismatch", "completion_provinces_withheld"), cover]),
        "rank_mix": (higher.J10_rank_mix, [F.lit("rank_not_split_by_gender"), cover]), "degree_mix": (higher.trend, [F.when(early, "azad_doctorate_bundled"), cover]),
    }
    rows = [f(spark, sf_dir).select("year", F.lit(s).alias("section"), F.explode(F.array_compact(F.array(*flags))).alias("flag")).distinct() for s, (f, flags) in each.items()]
    return reduce(DataFrame.unionByName, rows)


@query(None)
def E7_flag_dictionary(spark, sf_dir):
    """Every flag with its meaning and the years that carry it; a flag that no entry defines has a null meaning, and none may."""
    known = spark.createDataFrame(list(FLAGS.items()), "flag string, meaning string")
    school = A5_year_flags(spark, sf_dir).select("year", F.explode(F.split("flags", ",")).alias("flag")).filter("flag <> ''")
    used = school.unionByName(section_flags(spark, sf_dir).select("year", "flag")).groupBy("flag").agg(F.count_distinct("year").alias("n_years"))
    return known.join(used, "flag", "full").select("flag", "meaning", F.coalesce("n_years", F.lit(0)).alias("n_years"))


_A5, _A31 = ORACLES["A5_year_flags"], ORACLES["A31_section_flags"]
ORACLES["E7_flag_dictionary"] = f"""WITH a5 AS ({_A5}), a31 AS ({_A31}), used AS (SELECT flag, count(DISTINCT year) AS n FROM (SELECT year, unnest(string_split(flags, ',')) AS flag FROM a5 UNION ALL SELECT year, unnest(string_split(flags, ',')) FROM a31) WHERE flag <> '' GROUP BY flag)
SELECT flag, meaning, ifnull(n, 0) AS n_years FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, v in FLAGS.items())}) AS k(flag, meaning) FULL JOIN used USING (flag)"""


# ---- outcomes

_OUTCOME_KEYS = ["year", "province", "measure", "item"]
_PARTS = {n: k12.ORACLES[n] for n in ("J4_pass_rate", "V8_class_size", "J5_completion", "J6_cohort_survival")}
_OUTCOMES = "WITH " + ", ".join(f"{n} AS ({sql})" for n, sql in _PARTS.items()) + f", J8 AS ({higher.ORACLES['J8_graduation_ratio']})" + """,
outcomes AS (SELECT year, province, 'pass_rate' AS measure, level || '/' || gender AS item, pass_rate AS value, status FROM J4_pass_rate UNION ALL SELECT year, province, 'class_size', level, students_per_class, status FROM V8_class_size
  UNION ALL SELECT year, province, 'completion', 'upper_secondary', completion_proxy, status FROM J5_completion UNION ALL SELECT year, province, 'survival', gender, cohort_survival, status FROM J6_cohort_survival UNION ALL SELECT year, province, 'graduation', basis || '/' || gender, graduation_ratio, status FROM J8)"""


def school_facts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The clean facts and the best of them, each written once."""
    clean = written(k12.cleaned(spark, sf_dir), "clean")
    return clean, written(k12.panel.best_value(clean, k12.KEY), "best")


def outcome_rows(spark, sf_dir, facts: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Five measures of every year and province, long, with a status for each value."""
    clean, best = facts or school_facts(spark, sf_dir)
    row = lambda df, name, item, value: df.select("year", "province", F.lit(name).alias("measure"), item.alias("item"), F.when(F.col("status") == "ok", F.col(value)).alias("value"), "status")
    c, slash = F.col, lambda *x: F.concat_ws("/", *x)
    parts = [
        row(k12.pass_rate(clean), "pass_rate", slash("level", "gender"), "pass_rate"), row(k12.class_size(k12.ratios(best)), "class_size", c("level"), "students_per_class"), row(k12.completion(best), "completion", F.lit("upper_secondary"), "completion_proxy"),
        row(k12.survival(best), "survival", c("gender"), "cohort_survival"), row(higher.J8_graduation_ratio(spark, sf_dir), "graduation", slash("basis", "gender"), "graduation_ratio"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(_OUTCOMES + " SELECT year, province, measure, item, if(status = 'ok', value, NULL) AS value, status FROM outcomes")
def E4_outcomes(spark, sf_dir):
    """The outcomes document, nested and read back."""
    docs = nested(outcome_rows(spark, sf_dir), _OUTCOME_KEYS, ["value", "status"])
    leaves = flattened(docs, _OUTCOME_KEYS, {"value": "double", "status": "string"})
    return leaves.groupBy(*_OUTCOME_KEYS).agg(F.max(F.when(F.col("field") == "value", F.col("value"))).cast("double").alias("value"), F.max(F.when(F.col("field") == "status", F.col("value"))).alias("status"))


_FAMILIES = "CASE measure WHEN 'pass_rate' THEN split_part(item, '/', 1) WHEN 'class_size' THEN item WHEN 'completion' THEN item ELSE 'lower_secondary' END"


_PAIRS = _OUTCOMES + f", exposure AS ({k12.ORACLES['V4_students_per_teacher']})" + f""",
pairs AS (SELECT measure, {_FAMILIES} AS level, o.year, o.province, students_per_teacher AS x, o.value AS y FROM outcomes o JOIN exposure e ON e.year = o.year AND e.province = o.province AND e.level = {_FAMILIES}
  WHERE o.status = 'ok' AND o.province <> 'IRN' AND measure <> 'graduation' AND (measure NOT IN ('pass_rate', 'survival') OR item LIKE '%total') AND students_per_teacher IS NOT NULL AND o.value IS NOT NULL)"""


def relation_pairs(spark, sf_dir) -> DataFrame:
    """(measure, level, year, province, x, y): students per teacher against every school outcome that is ok, as one written table; the best facts are made
    once, for the outcomes and the exposure."""
    m, item = F.col("measure"), F.col("item")
    level = F.when(m == "pass_rate", F.substring_index("item", "/", 1)).when(m.isin("class_size", "completion"), item).otherwise("lower_secondary")
    facts = school_facts(spark, sf_dir)
    rows = outcome_rows(spark, sf_dir, facts).filter((m != "graduation") & (F.col("province") != "IRN") & (~m.isin("pass_rate", "survival") | item.endswith("total")) & F.col("value").isNotNull())
    exposure = k12.ratios(facts[1]).select("year", "province", "level", F.col("students_per_teacher").alias("x")).filter("x IS NOT NULL")
    return written(rows.withColumn("level", level).join(exposure, ["year", "province", "level"]).select("measure", "level", "year", "province", "x", F.col("value").alias("y")), "relations")


@query(_PAIRS + """, ranked AS (SELECT *, rank() OVER (PARTITION BY measure, level ORDER BY x) + (count(*) OVER (PARTITION BY measure, level, x) - 1) / 2.0::DOUBLE AS rx, rank() OVER (PARTITION BY measure, level ORDER BY y) + (count(*) OVER (PARTITION BY measure, level, y) - 1) / 2.0::DOUBLE AS ry FROM pairs)
SELECT measure, level, count(*) AS n, if(count(*) >= 25, round(corr(x, y), 7), NULL) AS pearson, if(count(*) >= 25, round(corr(rx, ry), 7), NULL) AS spearman FROM ranked GROUP BY ALL""")
def E5_relations(spark, sf_dir):
    """Pearson and Spearman (X1, X2) by outcome family and level."""
    return statistics.correlations(relation_pairs(spark, sf_dir), ["measure", "level"], "x", "y").withColumns({c: F.round(c, 7) for c in ("pearson", "spearman")})


@query(_PAIRS + f", long AS (SELECT measure, level, s.spec, province, year, x, y FROM pairs, (VALUES ('all_valid_years'), ('excl_reform')) s(spec) WHERE s.spec = 'all_valid_years' OR year NOT BETWEEN {k12.REFORM[0]} AND {k12.REFORM[1]})" + k12.effects_sql(["measure", "level", "spec"], "long"))
def E5_effects(spark, sf_dir):
    """Fixed effects by outcome family and level, over all years and without the reform's."""
    spec = F.explode(F.array_compact(F.array(F.lit("all_valid_years"), F.when(~F.col("year").between(*k12.REFORM), "excl_reform"))))
    found = statistics.fixed_effects(relation_pairs(spark, sf_dir).withColumn("spec", spec), "province", "year", "x", "y", ["measure", "level", "spec"])
    return found.select("measure", "level", "spec", "n", "units", "years", *[F.round(c, 7).alias(c) for c in ("coef", "se")])


@query(_PAIRS + f""", f AS (SELECT measure, year, unnest([if(count(*) < 20, 'few_provinces', NULL), if(year BETWEEN {k12.REFORM[0]} AND {k12.REFORM[1]}, 'reform_window', NULL), if(year BETWEEN {k12.PANDEMIC[0]} AND {k12.PANDEMIC[1]}, 'pandemic', NULL)]) AS flag FROM pairs GROUP BY measure, year)
SELECT measure, year, string_agg(flag, ',' ORDER BY flag) AS flags FROM f GROUP BY ALL""")
def E5_flags(spark, sf_dir):
    """What stands against each year of a family."""
    year = F.col("year")
    flags = F.array_compact(F.array(F.when(F.count("*") < 20, "few_provinces"), F.when(year.between(*k12.PANDEMIC), "pandemic"), F.when(year.between(*k12.REFORM), "reform_window")))
    rows = relation_pairs(spark, sf_dir).groupBy("measure", "year").agg(flags.alias("f"))
    return rows.select("measure", "year", F.when(F.size("f") > 0, F.array_join("f", ",")).alias("flags"))


@query(PANEL + """, f AS (SELECT province, year, students_per_teacher AS value FROM ratios WHERE level = 'primary' AND students_per_teacher IS NOT NULL), p AS (SELECT *, CASE WHEN province = 'N3' THEN ['N31', 'N32'] ELSE [province] END AS units FROM f WHERE province <> 'IRN')
SELECT unnest(units) AS unit, year, value, low, high, national FROM p JOIN (SELECT year, round(quantile_cont(value, 0.02), 9) AS low, round(quantile_cont(value, 0.98), 9) AS high FROM p GROUP BY year) USING (year) LEFT JOIN (SELECT year, value AS national FROM f WHERE province = 'IRN') USING (year)""")
def E8_map_feed(spark, sf_dir):
    """The map's table: one level, historic units on their successors, with the year's colour range and national line."""
    rows = k12.ratios(k12.best(spark, sf_dir)).filter("level = 'primary' AND students_per_teacher IS NOT NULL").select("province", "year", F.col("students_per_teacher").alias("value"))
    nation, place = F.col("province") == "IRN", F.when(F.col("province") != "IRN", F.col("value"))
    q = lambda p: F.round(F.percentile(place, p), 9)
    years = rows.groupBy("year").agg(q(0.02).alias("low"), q(0.98).alias("high"), F.max(F.when(nation, F.col("value"))).alias("national"), F.collect_list(F.when(~nation, F.struct(F.col("province").alias("unit"), "value"))).alias("all"))
    rows = years.select("year", "low", "high", "national", F.inline("all"))
    return mapping.paint(rows, "unit", spark.createDataFrame([("N3", ["N31", "N32"])], "unit string, successors array<string>"))


# ---- bibliometrics

@query(f"WITH {SOURCES}, c AS (SELECT source, year, sum(works) AS n FROM source_counts GROUP BY ALL) SELECT source, kind, sum(n)::BIGINT AS works, string_agg(year || ':' || n, ',' ORDER BY year) AS by_year FROM c JOIN journals USING (source) GROUP BY ALL")
def A21_journal_rows(spark, sf_dir):
    """Journals with their works by year as a map."""
    counts = adapted(spark, sf_dir, SOURCES, "source_counts").groupBy("source", "year").agg(F.sum("works").alias("n")).groupBy("source").agg(F.sum("n").alias("works"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("year", "n")))).alias("years"))
    by_year = F.array_join(F.transform(F.map_entries("years"), lambda e: F.concat_ws(":", e["key"], e["value"])), ",")
    return counts.join(adapted(spark, sf_dir, SOURCES, "journals").select("source", "kind"), "source").select("source", "kind", "works", by_year.alias("by_year"))


@query(f"""WITH {HIGHER}, s AS (SELECT year, province, map_from_entries(list((university, value))) AS v FROM (SELECT year, province, university, sum(value) AS value FROM staff WHERE staff_rank = 'all' GROUP BY ALL) GROUP BY ALL)
SELECT year, province, coalesce(v['all_reported'], v['azad'] + v['excl_azad']) AS staff, CASE WHEN v['all_reported'] IS NOT NULL THEN 'printed' WHEN v['azad'] + v['excl_azad'] IS NOT NULL THEN 'sum_of_parts' END AS basis, v['excl_azad'] AS non_azad FROM s""")
def A15_staff_basis(spark, sf_dir):
    """The printed total, else the sum of both parts, else none."""
    of = lambda u: F.sum(F.when(F.col("university") == u, F.col("value")))
    rows = adapted(spark, sf_dir, HIGHER, "staff").filter("staff_rank = 'all'").groupBy("year", "province").agg(of("all_reported").alias("a"), of("azad").alias("b"), of("excl_azad").alias("c"))
    both = F.col("b") + F.col("c")
    return rows.select("year", "province", F.coalesce("a", both).alias("staff"), F.when(F.col("a").isNotNull(), "printed").when(both.isNotNull(), "sum_of_parts").alias("basis"), F.col("c").alias("non_azad"))


# ---- readers and writers

def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"WITH {K12.removeprefix('WITH ')} SELECT yearbook, count(*) AS n, sum(value) AS total FROM best WHERE metric = 'students' GROUP BY yearbook")
def S2_outputs(spark, sf_dir):
    """Facts written by release and read by a declared schema and column list."""
    to = _folder(spark, "outputs")
    sources.write_outputs({"facts": k12.best(spark, sf_dir)}, to)
    rows = sources.read_facts(spark, to, "year int, province string, metric string, value double, yearbook int", ["yearbook", "metric", "value"])
    return rows.filter("metric = 'students'").groupBy("yearbook").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("SELECT p_partkey, p_name, p_size, 'says \"' || p_brand || '\", again' AS note FROM part")
def S3_csv(spark, sf_dir):
    """CSV with a header, out and in again."""
    to = _folder(spark, "csv")
    sources.write_csv(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", F.concat(F.lit('says "'), "p_brand", F.lit('", again')).alias("note")), to)
    return sources.read_csv(spark, to, "p_partkey long, p_name string, p_size int, note string")


@query("SELECT p_partkey::VARCHAR AS rank, p_name AS title, round(p_retailprice, 2) AS sjr, ['A' || (p_partkey % 700)::VARCHAR, 'B' || p_partkey::VARCHAR][1] AS first_issn, 2 AS n_issn FROM part")
def S4_rankings(spark, sf_dir):
    """A ranking file with semicolons, decimal commas and quoted lists."""
    to, p = _folder(spark, "rankings"), F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(p.alias("Rank"), F.col("p_name").alias("Title"), F.translate(F.round("p_retailprice", 2).cast("string"), ".", ",").alias("SJR"), F.concat(F.lit("A"), p % 700, F.lit(", B"), p).alias("Issn"))
    rows.write.option("header", True).option("sep", ";").option("quoteAll", True).csv(to)
    return sources.read_rankings(spark, to, ["SJR"], ["Issn"]).select(F.col("Rank").alias("rank"), F.col("Title").alias("title"), F.col("SJR").alias("sjr"), F.col("Issn")[0].alias("first_issn"), F.size("Issn").alias("n_issn"))


@query(_UNITS + " SELECT count(*) AS leaves, count(DISTINCT year) AS years FROM leaves WHERE value IS NOT NULL")
def S6_json(spark, sf_dir):
    """Documents as JSON lines, written and read again."""
    to = _folder(spark, "json")
    sources.write_json(nested(k12_rows(k12.best(spark, sf_dir)), _K12_KEYS, list(_K12_FIELDS)), to)
    docs = spark.read.schema("year int, doc string").json(to)
    return flattened(docs, _K12_KEYS, _K12_FIELDS).agg(F.count("*").alias("leaves"), F.count_distinct("year").alias("years"))


@query("SELECT n_name AS nation, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def S11_views(spark, sf_dir):
    """Tables as views and a view over them, registered twice."""
    views = {"panel_members": "SELECT n_name AS nation, count(*) AS customers FROM panel_customer JOIN panel_nation ON c_nationkey = n_nationkey GROUP BY n_name"}
    for _ in range(2):
        sources.register_all(spark, {f"panel_{t}": table(spark, sf_dir, t) for t in ("customer", "nation")}, views)
    return spark.table("panel_members")


_PAGES = """SELECT s_suppkey AS page_id, '<html><table><tr><th>Name (en)</th><th colspan="2">Size</th><th>x</th></tr><tr><td rowspan="' || CAST(1 + s_suppkey % 3 AS STRING) || '">' || s_name || '</td><td>' || CAST(s_nationkey AS STRING) || '</td><td>b &amp; c</td></tr><tr><td>' || CAST(s_suppkey AS STRING) || '</td></tr></table>'
  || '<select><option value="">choose</option><option value="' || CAST(s_nationkey AS STRING) || '">' || s_name || ' Province (' || CAST(s_suppkey AS STRING) || ')</option><option value="9">12</option></select></html>' AS html FROM supplier"""


def _pages(spark, sf_dir) -> DataFrame:
    return spark.sql(_PAGES.replace("FROM supplier", "FROM {s}"), s=table(spark, sf_dir, "supplier"))


@query("""WITH s AS (SELECT s_suppkey AS page_id, s_name, s_nationkey, s_suppkey % 3 AS span FROM supplier)
SELECT page_id, r, c, t AS text FROM (SELECT page_id, unnest([0, 0, 0, 0, 1, 1, 1]) AS r, unnest([0, 1, 2, 3, 0, 1, 2]) AS c, unnest(['Name (en)', 'Size', 'Size', 'x', s_name, s_nationkey::VARCHAR, 'b & c']) AS t FROM s)
UNION ALL SELECT page_id, 2, 0, CASE WHEN span = 0 THEN page_id::VARCHAR ELSE s_name END FROM s UNION ALL SELECT page_id, 2, 1, page_id::VARCHAR FROM s WHERE span > 0 UNION ALL SELECT page_id, 3, 0, s_name FROM s WHERE span = 2""")
def S8_html_tables(spark, sf_dir):
    """Tables of pages as a dense grid of cells."""
    return sources.html_tables(_pages(spark, sf_dir)).select("page_id", "r", "c", "text")


@query("""SELECT page_id, 0 AS table_no, r, c, t AS text FROM (SELECT page_id, unnest([0, 0, 1, 1, 2]) AS r, unnest([0, 1, 0, 1, 0]) AS c, unnest(['id', 'page', page_id::VARCHAR, page_id::VARCHAR, 'últ & ج']) AS t FROM pages)""")
def S8_raw_pages(spark, sf_dir):
    """A table in every raw page, with its styles, scripts and open paragraphs, read from bytes: some say their charset, some are no UTF-8."""
    own = F.concat(F.lit("<table><tr><th>id<th>page</tr><tr><td colspan=2>"), F.col("page_id"), F.lit("</td></tr><tr><td>"), F.lit("&uacute;lt &amp; ج"), F.lit("</table><footer>"))
    pages = table(spark, sf_dir, "pages").select("page_id", F.replace("html", F.lit("<footer>"), own).alias("html"))

    def encoded(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, sources.PAGES_AT_ONCE):
                ids, pages = (batch.slice(at, sources.PAGES_AT_ONCE).column(c).to_pylist() for c in ("page_id", "html"))
                yield pa.RecordBatch.from_pydict({"page_id": pa.array(ids, pa.int64()), "html": pa.array([said(i, h) for i, h in zip(ids, pages)], pa.binary())})

    def said(i, h):
        if i % 3 == 0:
            return h.encode()
        plain = h.replace('<meta charset="utf-8">', "")
        return (plain if i % 3 == 1 else plain.replace("<head>", '<head><meta charset="windows-1256">')).encode("cp1256", "replace")

    return sources.html_tables(pages.mapInArrow(encoded, "page_id long, html binary"))


@query("SELECT n_nationkey AS year, n_regionkey * 1.5 AS value FROM nation WHERE n_nationkey % 3 <> 0")
def S15_series(spark, sf_dir):
    """A side series out of a file: what is not verified is no measurement."""
    n = F.col("n_nationkey")
    path = f"{shared_dir(spark)}/series-{uuid.uuid4().hex}"
    sources.write_csv(table(spark, sf_dir, "nation").select(n.alias("year"), (F.col("n_regionkey") * 1.5).alias("value"), (n % 3 != 0).alias("verified")), path)
    return sources.read_series(spark, path, "year int, value double, verified boolean").select("year", "value")


@query("SELECT s_suppkey AS page_id, s_nationkey::VARCHAR AS value, s_name AS name, s_suppkey::INT AS count FROM supplier")
def S9_options(spark, sf_dir):
    """Options of lists: value, name and count, placeholders skipped."""
    return sources.html_options(_pages(spark, sf_dir), stop_word="Province")


@query("SELECT s_suppkey AS page_id, s_name AS name, s_nationkey::VARCHAR AS size FROM supplier")
def S10_table_rows(spark, sf_dir):
    """Rows of a table in a page by column name, the last column dropped."""
    cells = sources.html_tables(_pages(spark, sf_dir)).filter("r < 2 AND c <> 2")
    return sources.table_rows(cells).select("page_id", F.col("row")["name"].alias("name"), F.col("row")["size"].alias("size"))


@query("SELECT s_suppkey AS id, s_name || ' & Co' AS name, round(s_acctbal, 2) AS score, (s_suppkey % 50)::INT AS research, (s_suppkey % 7)::INT AS education FROM supplier WHERE s_acctbal > 0")
def S14_rank_cells(spark, sf_dir):
    """Name, score and ranks out of fragments of pages."""
    s = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(s.alias("id"), F.concat(F.lit('<tr><td class="name"><a href="#">'), "s_name", F.lit('</a> &amp; Co</td><td class="score">'), F.round("s_acctbal", 2).cast("string"), F.lit('</td><td id="rank_research">'), s % 50, F.lit('</td><td id="rank_education"> '), s % 7, F.lit("</td></tr>")).alias("html"))
    return sources.rank_cells(rows).select("id", "name", "score", F.col("ranks")["research"].alias("research"), F.col("ranks")["education"].alias("education"))
