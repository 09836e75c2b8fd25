"""Arithmetic checks of the printed tables of both domains, their status and summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelstats.operators import checks
from panelstats.plans.k12 import KEY, best, choice, facts
from panelstats.plans.k12 import _BEST as BEST_SQL
from panelstats.sources import written
from panelstats.sources.adapters import FACTS, HIGHER, adapted

QUERIES, ORACLES = {}, {}
EVERY = [*KEY, "area"]
_E = ", ".join(EVERY)
_GENDER = """,
sides AS (SELECT source_file, source_table, year, province, level, programme, metric, map_from_entries(list((gender, value))) AS v FROM facts GROUP BY ALL),
gender_sum AS (SELECT 'gender_sum' AS check_name, source_file, source_table, concat(metric, ' ', province) AS detail, v['male'] + v['female'] AS expected, v['total'] AS actual, abs(actual - expected) <= greatest(2.0, abs(actual) * 0.005) AS ok FROM sides WHERE len(map_keys(v)) = 3)"""
_CROSS = f""",
national AS (SELECT * FROM facts WHERE province = 'IRN'),
later AS (SELECT {_E}, median(value) AS later FROM national WHERE yearbook - year BETWEEN 1 AND 3 GROUP BY ALL),
cross_publication AS (SELECT 'cross_publication' AS check_name, source_file, source_table, concat(metric, ' ', gender) AS detail, later AS expected, value AS actual, abs(value - later) <= greatest(5.0, abs(later) * 0.05) AS ok FROM national JOIN later USING ({_E}) WHERE yearbook = year)"""
_SHIFT = """,
own AS (SELECT *, value / sum(value) OVER (PARTITION BY source_file, source_table, level, programme, area, metric) AS share FROM facts WHERE province <> 'IRN' AND yearbook = year AND gender = 'total'),
pairs AS (SELECT *, lag(share) OVER w AS prev, year - lag(year) OVER w AS gap FROM own WINDOW w AS (PARTITION BY province, level, programme, area, metric ORDER BY year)),
province_shift AS (SELECT 'province_shift' AS check_name, source_file, source_table, 'shares' AS detail, NULL::DOUBLE AS expected, count(*) FILTER (greatest(share / prev, prev / share) > 1.6)::DOUBLE AS actual, actual < 3 AS ok FROM pairs WHERE gap = 1 AND share > 0 AND prev > 0.005 GROUP BY source_file, source_table)"""
_DEGREE = """,
parts AS (SELECT source_file, source_table, year, province, university, metric, gender, any_value(value) FILTER (degree = 'all') AS actual, sum(value) FILTER (degree <> 'all') AS expected, count(value) FILTER (degree <> 'all') AS n FROM he_facts GROUP BY ALL),
degree_sum AS (SELECT 'degree_sum' AS check_name, source_file, split_part(source_table, '#', 1) AS source_table, concat(metric, ' ', gender) AS detail, expected, actual, abs(actual - expected) <= greatest(2.0, abs(actual) * 0.005) AS ok FROM parts WHERE actual IS NOT NULL AND n >= 4)"""
_ALL = f"WITH {FACTS}, {HIGHER}" + _GENDER + _CROSS + _SHIFT + _DEGREE + """,
v AS (SELECT 'he' AS domain, * FROM degree_sum UNION ALL SELECT 'k12', * FROM gender_sum UNION ALL SELECT 'k12', * FROM cross_publication UNION ALL SELECT 'k12', * FROM province_shift)"""
_PROVINCES = f""",
summed AS (SELECT source_file, source_table, year, level, programme, area, metric, gender, sum(value) FILTER (province <> 'IRN') AS expected, count(value) FILTER (province <> 'IRN') AS n, any_value(value) FILTER (province = 'IRN') AS actual FROM facts GROUP BY ALL)
SELECT 'province_sum' AS check_name, source_file, source_table, concat(metric, ' ', gender) AS detail, expected, actual, abs(actual - expected) <= greatest(5.0, abs(actual) * 0.01) AS ok FROM summed WHERE n >= 20 AND actual IS NOT NULL"""
_REVISIONS = f"(SELECT {_E}, min(value) AS low, max(value) AS high, count(value) AS n FROM facts GROUP BY ALL HAVING n > 1 AND high - low > abs(high) * 0.01 + 2)"


def query(sql: str):
    def put(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return put


def he_facts(spark, sf_dir) -> DataFrame:
    return adapted(spark, sf_dir, HIGHER, "he_facts")


def gender_sum(rows: DataFrame) -> DataFrame:
    return checks.gender_sum(rows, ["year", "province", "level", "programme", "metric"])


def province_shift(rows: DataFrame) -> DataFrame:
    return checks.province_shift(rows, ["level", "programme", "area", "metric"])


def all_checks(spark, sf_dir, rows: DataFrame | None = None) -> DataFrame:
    """The checks that count for a table's status, with their domain. The facts, which three of them use, are written once."""
    rows = rows or written(facts(spark, sf_dir), "facts")
    found = [gender_sum(rows), checks.cross_publication(rows, EVERY), province_shift(rows)]
    return reduce(DataFrame.unionByName, found).withColumn("domain", F.lit("k12")).unionByName(checks.degree_sum(he_facts(spark, sf_dir)).withColumn("domain", F.lit("he")))


@query(f"WITH {FACTS}" + _GENDER + " SELECT * FROM gender_sum")
def C1_gender_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gender_sum(facts(spark, sf_dir))


@query(f"WITH {HIGHER}" + _DEGREE + " SELECT * FROM degree_sum")
def C2_degree_sum(spark, sf_dir):
    return checks.degree_sum(he_facts(spark, sf_dir))


@query(f"WITH {FACTS}" + _PROVINCES)
def C3_province_sum(spark, sf_dir):
    return checks.province_sum(facts(spark, sf_dir), ["year", "level", "programme", "area", "metric", "gender"])


@query(f"WITH {FACTS}" + _CROSS + " SELECT * FROM cross_publication")
def C4_cross_publication(spark, sf_dir):
    return checks.cross_publication(facts(spark, sf_dir), EVERY)


@query(f"WITH {FACTS}" + _SHIFT + " SELECT * FROM province_shift")
def C5_province_shift(spark, sf_dir):
    return province_shift(facts(spark, sf_dir))


@query(f"WITH {FACTS} FROM {_REVISIONS}")
def C6_revisions(spark, sf_dir):
    return checks.revisions(facts(spark, sf_dir), EVERY)


@query(BEST_SQL + """, j AS (SELECT *, lag(value) OVER w AS before, year - lag(year) OVER w AS gap FROM best WHERE gender = 'total' AND metric IN ('students', 'teachers') WINDOW w AS (PARTITION BY province, level, programme, metric ORDER BY year))
SELECT year, province, level, metric, before AS expected, value AS actual FROM j WHERE gap = 1 AND before > 0 AND abs(value / before - 1) > 0.3""")
def C7_yearly_jumps(spark, sf_dir):
    """Changes between consecutive years."""
    rows = best(spark, sf_dir).filter((F.col("gender") == "total") & F.col("metric").isin("students", "teachers"))
    return checks.yearly_jumps(rows, ["province", "level", "programme", "metric"]).select("year", "province", "level", "metric", F.col("before").alias("expected"), F.col("value").alias("actual"))


_STATUS = """ SELECT source_file, source_table, count(*) AS n_checks, round(avg(ok::INT), 9) AS pass_rate,
if(avg(ok::INT) < 0.8 OR NOT coalesce(bool_and(ok) FILTER (check_name IN ('cross_publication', 'province_shift')), true), 'failed', 'passed') AS check_status FROM v GROUP BY ALL"""


@query(_ALL + _STATUS)
def C8_table_status(spark, sf_dir):
    return checks.table_status(all_checks(spark, sf_dir)).withColumn("pass_rate", F.round("pass_rate", 9))


@query(_ALL + " SELECT domain, check_name, count(*) AS n, round(avg(ok::INT), 9) AS pass_rate FROM v GROUP BY ALL")
def C9_check_summary(spark, sf_dir):
    return all_checks(spark, sf_dir).groupBy("domain", "check_name").agg(F.count("*").alias("n"), F.round(F.avg(F.col("ok").cast("double")), 9).alias("pass_rate"))


@query(_ALL + f""" SELECT check_name, 'error' AS severity, domain, source_file, source_table, detail, expected, actual FROM v WHERE NOT ok
UNION ALL SELECT 'revision', 'info', 'k12', NULL, NULL, concat_ws(' ', year, province, level, metric, gender), low, high FROM {_REVISIONS}""")
def C9_issues(spark, sf_dir):
    """The issue table: failing checks of both domains, and revisions as information."""
    columns = ["check_name", "severity", "domain", "source_file", "source_table", "detail", "expected", "actual"]
    none = F.lit(None).cast("string")
    rows = written(facts(spark, sf_dir), "facts")
    revised = checks.revisions(rows, EVERY).select(
        F.lit("revision").alias("check_name"), F.lit("info").alias("severity"), F.lit("k12").alias("domain"), none.alias("source_file"), none.alias("source_table"),
        F.concat_ws(" ", "year", "province", "level", "metric", "gender").alias("detail"), F.col("low").alias("expected"), F.col("high").alias("actual"))
    return all_checks(spark, sf_dir, rows).filter("NOT ok").withColumn("severity", F.lit("error")).select(columns).unionByName(revised)


@query(f"""WITH {FACTS}, k AS (SELECT DISTINCT source_file, source_table FROM facts)
SELECT k.source_file, k.source_table, coalesce(min(c.check_status), 'unchecked') AS check_status FROM k LEFT JOIN catalogue c USING (source_file, source_table) GROUP BY ALL""")
def J14_catalogue_status(spark, sf_dir):
    """Tables with their status; of several statuses of one table the first in alphabetical order, so that a failure counts."""
    tables = facts(spark, sf_dir).select("source_file", "source_table").distinct()
    status = adapted(spark, sf_dir, FACTS, "catalogue").groupBy("source_file", "source_table").agg(F.min("check_status").alias("check_status"))
    return tables.join(status, ["source_file", "source_table"], "left").withColumn("check_status", F.coalesce("check_status", F.lit("unchecked")))
