"""The domain's tables out of the given ones, as SQL that Spark and the checking engine both run.

``FACTS`` makes long facts in releases from orders and customers, with a catalogue of printed tables; ``HIGHER``
makes the higher-education facts (degrees, university types, staff ranks), with theirs. Each reads its tables once: cells are
aggregated once, national rows and totals come from the cells by grouping sets, and measures become rows by UNPIVOT. ``WORKS``, ``SOURCES`` and ``SURVEY`` make
work records, source counts and survey rows. Each is a list of common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelstats.sources import table

FACTS = """
cells AS (SELECT CAST(year(o_orderdate) AS INT) AS year, c_nationkey AS nation,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'primary' WHEN 'BUILDING' THEN 'lower_secondary' WHEN 'FURNITURE' THEN 'upper_secondary' WHEN 'HOUSEHOLD' THEN 'preschool' ELSE 'pre_university' END AS level,
    count(*) AS students, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS girls, count(DISTINCT o_custkey) AS teachers,
    bit_count(bit_or(CAST(pow(2, month(o_orderdate)) AS INT))) AS classes, bit_count(bit_or(CAST(pow(2, o_custkey % 20) AS INT))) AS schools,
    count(CASE WHEN o_orderpriority <> '5-LOW' THEN 1 END) AS passed, count(CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus = 'F' THEN 1 END) AS girls_passed,
    count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS graduates
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
units AS (SELECT year, coalesce(nation, -1) AS nation, coalesce(level, 'all_levels') AS level, CAST(sum(students) AS DOUBLE) AS students__total, CAST(sum(girls) AS DOUBLE) AS students__female, CAST(sum(students - girls) AS DOUBLE) AS students__male,
    CAST(sum(teachers) AS DOUBLE) AS teachers__total, CAST(sum(teachers + 1) AS DOUBLE) AS educational_staff__total, CAST(sum(classes) AS DOUBLE) AS classes__total, CAST(sum(schools) AS DOUBLE) AS schools__total,
    CAST(sum(passed) AS DOUBLE) AS passed__total, CAST(sum(girls_passed) AS DOUBLE) AS passed__female, CAST(sum(passed - girls_passed) AS DOUBLE) AS passed__male, CAST(sum(graduates) AS DOUBLE) AS graduates__total
  FROM cells GROUP BY GROUPING SETS ((year, nation, level), (year, level), (year, nation), (year))),
long_facts AS (SELECT year, nation, level, split_part(what, '__', 1) AS metric, split_part(what, '__', 2) AS gender, value FROM units UNPIVOT (value FOR what IN
    (students__total, students__female, students__male, teachers__total, educational_staff__total, classes__total, schools__total, passed__total, passed__female, passed__male, graduates__total))
  WHERE NOT (what = 'teachers__total' AND (nation + year) % 4 = 0)),
facts AS (SELECT year, CASE WHEN nation < 0 THEN 'IRN' ELSE 'N' || CAST(nation AS STRING) END AS province, level, CASE WHEN level = 'preschool' AND nation % 6 = 5 THEN 'adult' ELSE 'regular' END AS programme, metric, gender,
    CASE WHEN r = 3 THEN value / 2 WHEN r = 2 AND nation % 5 = 0 THEN value + 1 WHEN r = 2 AND nation % 7 = 3 THEN value + 5 ELSE value END AS value, CAST(year + r % 3 AS INT) AS yearbook,
    CAST(year + r % 3 AS STRING) || '/book' AS source_file, level || '#' || CAST(r AS STRING) AS source_table, CASE WHEN r = 1 THEN 'template' ELSE 'document' END AS header_source,
    CASE WHEN (nation + year + r) % 11 = 0 THEN 'unread' END AS row_category, CASE WHEN (nation + year + 2 * r) % 17 = 3 THEN 'unread' END AS col_category,
    CASE WHEN r = 3 THEN 'urban' ELSE 'total' END AS area, 'all' AS branch, CASE WHEN r = 3 THEN 'public' ELSE 'all' END AS sector
  FROM long_facts CROSS JOIN (VALUES (0), (1), (2), (3)) AS t(r) WHERE NOT (r % 3 = 0 AND (nation + 1 + year) % 7 = 0)),
catalogue AS (SELECT DISTINCT CAST(year + r % 3 AS STRING) || '/book' AS source_file, level || '#' || CAST(r AS STRING) AS source_table, CASE WHEN (year + r) % 5 = 0 AND r = 2 THEN 'failed' ELSE 'passed' END AS check_status
  FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders) AS books CROSS JOIN (VALUES (0), (1), (2), (3)) AS t(r)
    CROSS JOIN (VALUES ('primary'), ('lower_secondary'), ('upper_secondary'), ('preschool'), ('pre_university'), ('all_levels')) AS l(level) WHERE NOT (level = 'primary' AND r = 1 AND (year + r) % 3 = 0))
"""

HIGHER = """
shipped AS (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey),
enrolled AS (SELECT CAST(year(o_orderdate) AS INT) AS entered, CAST(year(shipped) AS INT) AS finished, c_nationkey AS nation, o_orderstatus AS status,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'associate' WHEN '2-HIGH' THEN 'bachelor' WHEN '3-MEDIUM' THEN 'master' WHEN '4-NOT SPECIFIED' THEN 'phd' ELSE 'professional_doctorate' END AS degree,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'azad' WHEN 'MACHINERY' THEN 'excl_azad' ELSE 'all_reported' END AS university, o_custkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN shipped ON o_orderkey = l_orderkey),
per_customer AS (SELECT year, nation, university, degree, o_custkey, count(CASE WHEN what = 'entered' THEN 1 END) AS students, count(CASE WHEN what = 'entered' AND status = 'F' THEN 1 END) AS girls, count(CASE WHEN what = 'finished' THEN 1 END) AS graduates
  FROM enrolled UNPIVOT (year FOR what IN (entered, finished)) GROUP BY year, nation, university, degree, o_custkey),
per_degree AS (SELECT year, nation, university, degree, sum(students) AS students, sum(girls) AS girls, count(CASE WHEN students > 0 THEN 1 END) AS entrants, sum(graduates) AS graduates FROM per_customer GROUP BY year, nation, university, degree),
summed AS (SELECT year, nation, university, degree, nullif(sum(students), 0) AS students, nullif(sum(girls), 0) AS girls, nullif(sum(entrants), 0) AS entrants, nullif(sum(graduates), 0) AS graduates
  FROM per_degree GROUP BY GROUPING SETS ((year, nation, university, degree), (year, nation, university), (year, university, degree), (year, university))),
totals AS (SELECT year, coalesce(nation, -1) AS nation, university, coalesce(degree, 'all') AS degree, k, CASE WHEN nation IS NULL AND year % 3 = 0 THEN 200 ELSE 0 END AS extra, CASE k WHEN 0 THEN students WHEN 1 THEN girls WHEN 2 THEN entrants ELSE graduates END AS number
  FROM summed CROSS JOIN (VALUES (0), (1), (2), (3)) AS m(k)),
he_facts AS (SELECT year, CASE WHEN nation < 0 THEN 'IRN' ELSE 'N' || CAST(nation AS STRING) END AS province, university, degree, CASE k WHEN 2 THEN 'new_entrants' WHEN 3 THEN 'graduates' ELSE 'students' END AS metric, CASE k WHEN 1 THEN 'female' ELSE 'total' END AS gender,
    CAST(number + extra + CASE WHEN r = 1 AND nation % 5 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS value, CASE WHEN nation % 3 = 0 THEN 'excl_uast' WHEN nation % 3 = 1 THEN '' END AS coverage,
    CAST(year + r % 2 AS INT) AS yearbook, CAST(year + r % 2 AS STRING) || '/he' AS source_file, university || '#' || CAST(r AS STRING) AS source_table, CASE WHEN r = 1 THEN 'template' ELSE 'document' END AS header_source,
    CASE WHEN (nation + year + r) % 13 = 0 THEN 'unread' END AS row_category, CASE WHEN (nation + year + 2 * r) % 19 = 3 THEN 'unread' END AS col_category, CASE WHEN r = 2 THEN 'urban' ELSE 'total' END AS area
  FROM totals CROSS JOIN (VALUES (0), (1), (2)) AS t(r) WHERE number IS NOT NULL AND NOT (r = 0 AND (nation + 1 + year) % 7 = 0)),
he_catalogue AS (SELECT DISTINCT CAST(year + r % 2 AS STRING) || '/he' AS source_file, university || '#' || CAST(r AS STRING) AS source_table, CASE WHEN (year + r) % 4 = 0 AND r = 1 THEN 'failed' ELSE 'passed' END AS check_status
  FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) + d AS year FROM orders CROSS JOIN (VALUES (0), (1)) AS v(d)) AS books CROSS JOIN (VALUES (0), (1), (2)) AS t(r) CROSS JOIN (VALUES ('azad'), ('excl_azad'), ('all_reported')) AS l(university)),
staff_cells AS (SELECT CAST(year(l_shipdate) AS INT) AS year, s_nationkey AS nation, CASE s_suppkey % 3 WHEN 0 THEN 'azad' WHEN 1 THEN 'excl_azad' ELSE 'all_reported' END AS university,
    CASE l_linestatus WHEN 'O' THEN 'fulltime' ELSE 'both' END AS employment,
    CASE l_linenumber WHEN 1 THEN 'professor' WHEN 2 THEN 'associate_professor' WHEN 3 THEN 'assistant_professor' WHEN 4 THEN 'instructor' WHEN 5 THEN 'instructor_assistant' ELSE 'non_faculty' END AS staff_rank, count(*) AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3, 4, 5),
staff AS (SELECT year, 'N' || CAST(nation AS STRING) AS province, university, employment, coalesce(staff_rank, 'all') AS staff_rank, CAST(sum(value) + CASE WHEN staff_rank IS NULL AND nation % 4 = 0 THEN 9 ELSE 0 END AS DOUBLE) AS value,
    CAST(year AS STRING) || '/staff :: ' || university AS provenance
  FROM staff_cells GROUP BY GROUPING SETS ((year, nation, university, employment, staff_rank), (year, nation, university, employment)))
"""

WORKS = """
works AS (SELECT l_suppkey AS inst, s_nationkey AS province, l_orderkey AS work, CAST(year(l_shipdate) AS INT) AS year, CAST(l_quantity AS INT) AS cites, 1 + l_linenumber % 3 AS n_countries,
    CASE WHEN p_type LIKE '%BRASS%' THEN 'ai' WHEN p_type LIKE '%TIN%' THEN 'edu' ELSE 'other' END AS slice
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
"""

SOURCES = """
rankings AS (SELECT p_partkey AS ranking, CASE p_size % 5 WHEN 0 THEN '-' ELSE 'Q' || CAST(p_size % 5 AS STRING) END AS quartile, p_brand || ' (Q' || CAST(1 + p_size % 4 AS STRING) || '); General (-)' AS categories,
    'A' || CAST(p_partkey % 700 AS STRING) || ',B' || CAST(p_partkey AS STRING) AS issns FROM part WHERE p_partkey % 3 <> 0),
journals AS (SELECT p_partkey AS source, CASE WHEN p_size % 7 = 0 THEN 'conference' WHEN p_size % 11 = 0 THEN 'repository' ELSE 'journal' END AS kind,
    'A' || CAST((p_partkey + 1) % 700 AS STRING) || ',B' || CAST(p_partkey AS STRING) AS issns FROM part WHERE p_partkey % 17 <> 0),
source_counts AS (SELECT l_returnflag AS bucket, CASE WHEN s_nationkey < 5 THEN 'national' ELSE 'world' END AS scope, l_partkey AS source, CAST(year(l_shipdate) AS INT) AS year, count(*) AS works
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3, 4)
"""

SURVEY = """
class_sizes AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
survey AS (SELECT o_orderkey AS student, o.o_custkey AS class, c_nationkey AS school, CAST(1 + o.o_custkey % 3 AS DOUBLE) AS w, o.o_custkey % 40 AS zone, o_orderkey % 2 AS rep, CAST(n AS DOUBLE) AS size,
    CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS girl, floor(o_totalprice / 100) AS pv1, floor(o_totalprice / 100) + o_orderkey % 7 AS pv2, floor(o_totalprice / 100) - o_orderkey % 5 AS pv3,
    floor(o_totalprice / 100) + o_orderkey % 3 AS pv4, floor(o_totalprice / 100) - o_orderkey % 2 AS pv5
  FROM orders o JOIN customer ON o.o_custkey = c_custkey JOIN class_sizes s ON s.o_custkey = o.o_custkey)
"""

_TABLES = ("orders", "customer", "lineitem", "supplier", "part", "nation", "region", "events", "documents", "pages", "conversations", "embeddings")


def adapted(spark: SparkSession, sf_dir: str, expressions: str, name: str) -> DataFrame:
    """The table ``name`` of some of the expressions above."""
    import re

    used = {t for t in _TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", expressions)}
    text = expressions
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(f"WITH {text} SELECT * FROM {name}", **{t: table(spark, sf_dir, t) for t in used})
