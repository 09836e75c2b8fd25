"""Dictionary mapping, name bridges, grids and catalogue operations, with their queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelstats.operators import lines, mapping, panel
from panelstats.sources import table
from panelstats.sources.adapters import FACTS, HIGHER, WORKS, adapted

QUERIES, ORACLES = {}, {}
#: Fixed values of the demonstration dictionary: order, dimension, value, key, how.
RULES = [(1, "metal", "copper", "COPPER", "contains"), (2, "metal", "any", "E", "contains"), (3, "finish", "polished", "POLISHED", "contains"), (4, "finish", "raw", "ECONOMY", "startswith"), (5, "kind", "exact", "PROMO BRUSHED STEEL", "exact"), (6, "finish", "plated", "PLATED", "contains")]
_RULES = "rules AS (SELECT * FROM (VALUES " + ", ".join(f"({o}, '{d}', '{v}', '{k.replace(' ', '')}', '{h}')" for o, d, v, k, h in RULES) + ") AS t(rule_order, dim, value, k, how))"


def query(sql: str | None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


@query(f"WITH {_RULES}, t AS (SELECT DISTINCT p_type AS text, replace(p_type, ' ', '') AS s FROM part) SELECT text, dim, arg_min(value, rule_order) AS value FROM t JOIN rules ON (how = 'exact' AND s = k) OR (how = 'contains' AND contains(s, k)) OR (how = 'startswith' AND starts_with(s, k)) GROUP BY text, dim")
def M1_rule_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "rule_order int, dim string, value string, key string, how string")
    return mapping.match_rules(table(spark, sf_dir, "part").select(F.col("p_type").alias("text")), rules)


@query("SELECT p_partkey, CASE WHEN p_type LIKE '%COPPER%' THEN 'other' WHEN p_type LIKE '%TIN%' AND p_name NOT LIKE '%red%' THEN 'training' WHEN p_type LIKE '%BRASS%' THEN 'he' WHEN p_type LIKE '%STEEL%' OR p_type LIKE '%NICKEL%' THEN 'k12' ELSE 'other' END AS domain FROM part")
def M2_classify_domain(spark, sf_dir):
    """Keywords in order of precedence, with a guard."""
    t, n = F.col("p_type"), F.col("p_name")
    domain = F.when(t.contains("COPPER"), "other").when(t.contains("TIN") & ~n.contains("red"), "training").when(t.contains("BRASS"), "he").when(t.rlike("STEEL|NICKEL"), "k12").otherwise("other")
    return table(spark, sf_dir, "part").select("p_partkey", domain.alias("domain"))


@query("SELECT p_partkey, list_aggregate(list_sort(list_filter([CASE WHEN p_type LIKE '%BRASS%' THEN 'brass' END, CASE WHEN p_size > 25 THEN 'large' END, CASE WHEN p_type LIKE 'SMALL%' THEN 'small' END], lambda x: x IS NOT NULL)), 'string_agg', ',') AS subjects FROM part")
def M11_subjects(spark, sf_dir):
    """Several labels for one title."""
    t = F.col("p_type")
    tags = F.array_sort(F.array_compact(F.array(F.when(t.contains("BRASS"), "brass"), F.when(F.col("p_size") > 25, "large"), F.when(t.startswith("SMALL"), "small"))))
    return table(spark, sf_dir, "part").select("p_partkey", F.when(F.size(tags) > 0, F.array_join(tags, ",")).alias("subjects"))


@query("SELECT s.s_suppkey, coalesce(n.n_name, 'IRN') AS province FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey AND n.n_regionkey <> 2")
def M5_match_province(spark, sf_dir):
    names = table(spark, sf_dir, "nation").filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return table(spark, sf_dir, "supplier").join(names, "s_nationkey", "left").select("s_suppkey", F.coalesce("n_name", F.lit("IRN")).alias("province"))


@query("SELECT s_nationkey, n_name, r_name, k FROM (SELECT s_nationkey, min(s_suppkey) AS k FROM supplier GROUP BY 1) JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey")
def J15_name_bridge(spark, sf_dir):
    """Codes to names over a table between: every row of the codes and names serves once, and a region serves all of its nations."""
    codes = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("a"), F.col("s_suppkey").alias("k"))
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("a"), F.col("n_regionkey").alias("b"), "n_name")
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("b"), "r_name")
    return mapping.bridge(codes, names, regions, "a", "b", shared=True).select(F.col("a").alias("s_nationkey"), "n_name", "r_name", "k")


_SPELLINGS = [*mapping.PROVINCES, *mapping.ALIASES]


@query(f"""WITH n(i, code) AS (VALUES {', '.join(f"({i}, '{code}')" for i, (code, _) in enumerate(_SPELLINGS))}), s AS (SELECT s_suppkey, code FROM supplier JOIN n ON i = s_suppkey % {len(_SPELLINGS)})
SELECT s_suppkey, code, unnest(CASE code WHEN 'KHO' THEN ['KHR', 'KHS', 'KHJ'] ELSE [code] END) AS unit FROM s""")
def M5_spellings(spark, sf_dir):
    """Provinces by every spelling, and divided ones on their successors."""
    names = F.element_at(F.array(*[F.lit(name) for _, name in _SPELLINGS]), (F.col("s_suppkey") % len(_SPELLINGS) + 1).cast("int"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(names, F.lit(" (1)")).alias("text"))
    known = rows.join(mapping.match_province(rows), "text").select("s_suppkey", F.col("province").alias("code"), F.col("province").alias("unit"))
    return mapping.paint(known, "unit", spark.createDataFrame(mapping.HISTORIC, "unit string, successors array<string>"))


@query("SELECT n_nationkey AS code, y.y::INT AS year, printf('https://stats.example.org/%d/%02d.zip', y.y, n_nationkey) AS url FROM nation CROSS JOIN (SELECT unnest(generate_series(min(year(o_orderdate)), max(year(o_orderdate)))) AS y FROM orders) y")
def J16_entity_years(spark, sf_dir):
    """Every unit in every year from the first to the last of the orders, and its address (F16)."""
    years = table(spark, sf_dir, "orders").agg(F.sequence(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).alias("years"))  # one row
    rows = table(spark, sf_dir, "nation").join(years).select(F.col("n_nationkey").alias("code"), F.explode("years").alias("year"))
    return rows.select("code", "year", F.format_string("https://stats.example.org/%d/%02d.zip", "year", "code").alias("url"))


@query("WITH d AS (SELECT n_nationkey AS unit, CASE WHEN n_nationkey = 3 THEN [31, 32] WHEN n_nationkey = 7 THEN [71, 72, 73] ELSE [n_nationkey] END AS s FROM nation), t AS (SELECT c_nationkey AS unit, count(*) AS n FROM customer GROUP BY 1) SELECT unnest(d.s)::INT AS unit, t.n FROM t JOIN d ON d.unit = t.unit")
def J22_paint_successors(spark, sf_dir):
    successors = spark.createDataFrame([(3, [31, 32]), (7, [71, 72, 73])], "unit int, successors array<int>")
    return mapping.paint(table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("unit")).agg(F.count("*").alias("n")), "unit", successors)


@query(f"WITH {WORKS} SELECT province, count(DISTINCT inst) AS n, count(DISTINCT CASE WHEN inst % 3 = 0 THEN inst END) AS fetched, round(sum(CASE WHEN inst % 3 = 0 THEN 1.0 ELSE 0.0 END) / count(*), 9) AS share FROM works GROUP BY province")
def A17_fetch_coverage(spark, sf_dir):
    got = F.col("inst") % 3 == 0
    return adapted(spark, sf_dir, WORKS, "works").groupBy("province").agg(F.count_distinct("inst").alias("n"), F.count_distinct(F.when(got, F.col("inst"))).alias("fetched"), F.round(F.avg(got.cast("double")), 9).alias("share"))


@query(f"WITH {WORKS}, u AS (SELECT work, max(year) AS year, max(cites) AS cites, max(n_countries) AS n FROM works GROUP BY work) SELECT year, count(*) AS works, sum(cites)::BIGINT AS cites, count(*) FILTER (n > 1) AS international FROM u GROUP BY year")
def A30_national_series(spark, sf_dir):
    once = adapted(spark, sf_dir, WORKS, "works").groupBy("work").agg(F.max("year").alias("year"), F.max("cites").alias("cites"), F.max("n_countries").alias("n"))
    return once.groupBy("year").agg(F.count("*").alias("works"), F.sum("cites").alias("cites"), F.count_if(F.col("n") > 1).alias("international"))


@query(f"WITH {FACTS}, k AS (SELECT *, row_number() OVER (PARTITION BY year, province, level, programme, area, metric, gender ORDER BY CASE WHEN yearbook = year THEN 0 ELSE 1 END, source_file, source_table) AS rn FROM facts) SELECT year, province, level, programme, area, metric, gender, value, source_file FROM k WHERE rn = 1")
def A24_keep_first(spark, sf_dir):
    """Duplicates go, the first by a full order stays."""
    order = F.struct((F.col("yearbook") != F.col("year")).cast("int").alias("o"), "source_file", "source_table")
    keys = ["year", "province", "level", "programme", "area", "metric", "gender"]
    return adapted(spark, sf_dir, FACTS, "facts").groupBy(*keys).agg(F.min_by(F.struct("value", "source_file"), order).alias("r")).select(*keys, "r.value", "r.source_file")


@query(f"WITH {FACTS}, h AS (SELECT CASE WHEN province IN ('N1', 'N2', 'N3') THEN 'U1' ELSE province END AS unit, CASE WHEN province IN ('N1', 'N2', 'N3') THEN 3 ELSE 1 END AS parts, year, level, value FROM facts WHERE metric = 'students' AND gender = 'total' AND area = 'total' AND yearbook = year) SELECT unit, year, level, sum(value) AS value FROM h GROUP BY unit, parts, year, level HAVING count(*) = parts")
def A28_constant_borders(spark, sf_dir):
    """Members of a harmonised unit are summed when all are there."""
    member = F.col("province").isin("N1", "N2", "N3")
    rows = adapted(spark, sf_dir, FACTS, "facts").filter("metric = 'students' AND gender = 'total' AND area = 'total' AND yearbook = year")
    rows = rows.groupBy(F.when(member, "U1").otherwise(F.col("province")).alias("unit"), F.when(member, 3).otherwise(1).alias("parts"), "year", "level").agg(F.sum("value").alias("value"), F.count("*").alias("n"))
    return rows.filter("n = parts").select("unit", "year", "level", "value")


_GRID = "g AS (SELECT l_orderkey AS t, l_linenumber AS r, c, CASE c WHEN 0 THEN l_returnflag WHEN 1 THEN CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END ELSE CASE WHEN l_linenumber % 3 = 0 THEN '' WHEN l_linestatus = 'O' THEN 'x' ELSE CAST(l_suppkey AS STRING) END END AS x FROM lineitem CROSS JOIN (VALUES (0), (1), (2)) AS v(c))"


def _grid(spark, sf_dir) -> DataFrame:
    return spark.sql(f"WITH {_GRID} SELECT * FROM g".replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))


@query(f"WITH {_GRID}, k AS (SELECT t, r FROM g WHERE c > 0 GROUP BY t, r HAVING bool_or(x <> '')) SELECT g.t, count(DISTINCT g.r) AS n_rows, count(*) AS cells FROM g JOIN k ON k.t = g.t AND k.r = g.r GROUP BY g.t HAVING count(DISTINCT g.r) >= 2")
def T1_clean_grid(spark, sf_dir):
    """Blank rows go, then grids of fewer than two rows."""
    ink = F.max(F.when(F.col("c") > 0, F.col("x") != ""))  # a row's three cells are one row before the shuffle
    rows = _grid(spark, sf_dir).groupBy("t", "r").agg(ink.alias("ink"), F.count("*").alias("k")).filter("ink")
    return rows.groupBy("t").agg(F.count("*").alias("n_rows"), F.sum("k").alias("cells")).filter("n_rows >= 2")


@query(f"WITH {_GRID}, k AS (SELECT t, count(*) FILTER (c = 0 AND x <> '' AND NOT regexp_full_match(x, '[0-9]+')) AS a, count(*) FILTER (c = 2 AND x <> '' AND NOT regexp_full_match(x, '[0-9]+')) AS b FROM g GROUP BY t) SELECT t, CASE WHEN b > a THEN 'last' ELSE 'first' END AS side FROM k")
def T2_label_side(spark, sf_dir):
    word = (F.col("x") != "") & ~F.col("x").rlike("^[0-9]+$")
    rows = _grid(spark, sf_dir).groupBy("t").agg(F.count_if(word & (F.col("c") == 0)).alias("a"), F.count_if(word & (F.col("c") == 2)).alias("b"))
    return rows.select("t", F.when(F.col("b") > F.col("a"), "last").otherwise("first").alias("side"))


@query("WITH p AS (SELECT l_orderkey AS t, l_linenumber AS r, l_returnflag AS x FROM lineitem), k AS (SELECT *, lag(x) OVER (PARTITION BY t ORDER BY r, x) AS b FROM p) SELECT t, string_agg(x, ' > ' ORDER BY r, x) AS path FROM k WHERE b IS NULL OR b <> x GROUP BY t")
def T4_header_paths(spark, sf_dir):
    """Parts of a path in order, consecutive repeats once."""
    before = F.lag("l_returnflag").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_returnflag"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("t"), F.col("l_linenumber").alias("r"), F.col("l_returnflag").alias("x"), before.alias("b")).filter("b IS NULL OR b <> x")
    return rows.groupBy("t").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "x"))), lambda s: s["x"]), " > ").alias("path"))


@query("WITH w AS (SELECT l_suppkey AS t, l_orderkey % 4 AS width FROM lineitem), c AS (SELECT t, width, count(*) AS n FROM w GROUP BY 1, 2), m AS (SELECT t, arg_min(width, -n * 100 + width) AS width, sum(n) AS total, max(n) AS most FROM c GROUP BY t) SELECT t, width::BIGINT AS width, (total - most)::BIGINT AS dropped FROM m")
def T18_modal_width(spark, sf_dir):
    """The most common number of columns of a table (the smaller on ties), and rows of other widths."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("t"), F.array_repeat(F.lit(1), (F.col("l_orderkey") % 4).cast("int")).alias("values"))
    return lines.modal_rows(rows, ["t"]).groupBy("t").agg(F.first(F.size("values")).cast("long").alias("width"), F.first("dropped").alias("dropped"))


@query("WITH c AS (SELECT c_nationkey AS doc, c_custkey % 5 AS chapter, count(*) AS n FROM customer GROUP BY 1, 2), k AS (SELECT doc, arg_min(chapter, -n * 100 + chapter) AS chapter FROM c GROUP BY doc) SELECT k.doc, k.chapter, c.n FROM k JOIN c ON c.doc = k.doc AND c.chapter = k.chapter")
def T9_chapter_vote(spark, sf_dir):
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("doc"), (F.col("c_custkey") % 5).alias("chapter")).agg(F.count("*").alias("n"))
    return c.groupBy("doc").agg(F.max_by(F.struct("chapter", "n"), F.struct("n", -F.col("chapter"))).alias("b")).select("doc", "b.chapter", "b.n")


@query("SELECT p_partkey, CASE WHEN k = 0 THEN p_brand ELSE p_brand || '.dup' || k END AS id FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey) - 1 AS k FROM part) t")
def T12_dedupe_ids(spark, sf_dir):
    k = F.row_number().over(Window.partitionBy("p_brand", "p_size").orderBy("p_partkey")) - 1
    return table(spark, sf_dir, "part").withColumn("k", k).select("p_partkey", F.when(F.col("k") == 0, F.col("p_brand")).otherwise(F.concat("p_brand", F.lit(".dup"), "k")).alias("id"))


@query("SELECT event_type, user_id % 7 AS k, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def S7_nested_round_trip(spark, sf_dir):
    """Nested JSON out and back: map of maps, flattened again."""
    sums = table(spark, sf_dir, "events").groupBy("event_type", (F.col("user_id") % 7).alias("k")).agg(F.round(F.sum("value"), 6).alias("total"))
    doc = sums.groupBy("event_type").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("k").cast("string"), "total")))).alias("json"))
    back = doc.select("event_type", F.explode(F.from_json("json", "map<string, double>")).alias("k", "total"))
    return back.select("event_type", F.col("k").cast("long").alias("k"), "total")
