"""Bibliometrics, survey statistics, labels, table structure, rings and pages, with their queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelstats.functions import labels
from panelstats.operators import mapping, panel, places, statistics, unions
from panelstats.sources import table, written
from panelstats.sources.adapters import HIGHER, SOURCES, SURVEY, WORKS, adapted

QUERIES, ORACLES = {}, {}


def query(sql: str | None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def _works(spark, sf_dir) -> DataFrame:
    return adapted(spark, sf_dir, WORKS, "works")


def _metrics(works: DataFrame, *keys: str) -> DataFrame:
    return works.groupBy(*keys).agg(F.count("*").alias("works"), F.sum("cites").alias("cites"), F.count_if(F.col("n_countries") > 1).alias("international"), F.count_if(F.col("slice") == "ai").alias("ai"))


_METRICS = "count(*) AS works, sum(cites)::BIGINT AS cites, count(*) FILTER (n_countries > 1) AS international, count(*) FILTER (slice = 'ai') AS ai"
_ONCE = ", once AS (SELECT province, work, max(year) AS year, max(cites) AS cites, max(n_countries) AS n_countries, max(slice) AS slice FROM works GROUP BY province, work)"


def _once(works: DataFrame, *unit: str) -> DataFrame:
    return works.groupBy(*unit, "work").agg(*[F.max(c).alias(c) for c in ("year", "cites", "n_countries", "slice")])


@query(f"WITH {WORKS} SELECT inst, year, {_METRICS} FROM works GROUP BY inst, year")
def A11_works_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(_works(spark, sf_dir), "inst", "year")


@query(f"WITH {WORKS}{_ONCE} SELECT province, year, {_METRICS} FROM once GROUP BY province, year")
def A12_union_of_works(spark, sf_dir):
    """Works count once for each unit, however many of its institutions share them."""
    return _metrics(_once(_works(spark, sf_dir), "province"), "province", "year")


@query(f"WITH {WORKS}, y AS (SELECT inst, year, count(*) AS n FROM works GROUP BY inst, year), i AS (SELECT DISTINCT inst FROM works), t AS (SELECT DISTINCT year FROM works) SELECT i.inst, t.year, coalesce(y.n, 0) AS works FROM i CROSS JOIN t LEFT JOIN y ON y.inst = i.inst AND y.year = t.year")
def A13_zero_filled_series(spark, sf_dir):
    """Every institution in every year from the first to the last of all works, with 0 where it has none. One row per
    institution carries its counts, and the years are taken over those rows."""
    counts = _works(spark, sf_dir).groupBy("inst", "year").agg(F.count("*").alias("n"))
    insts = counts.groupBy("inst").agg(F.map_from_entries(F.collect_list(F.struct("year", "n"))).alias("by_year"), F.min("year").alias("lo"), F.max("year").alias("hi"))
    range_ = counts.agg(F.min("year").alias("first"), F.max("year").alias("last"))  # one row
    rows = insts.join(range_).select("inst", "by_year", F.explode(F.sequence("first", "last")).alias("year"))
    return rows.select("inst", "year", F.coalesce(F.col("by_year")[F.col("year")], F.lit(0)).alias("works"))


@query(f"WITH {WORKS}{_ONCE}, s AS (SELECT s_nationkey AS province, count(*) AS n, max(s_acctbal) AS b FROM supplier GROUP BY s_nationkey) SELECT o.province, count(*) AS works, CASE WHEN s.b > 5000 THEN round_even(count(*) / s.n::DOUBLE, 4) END AS per_staff_consistent, CASE WHEN s.b <= 5000 THEN round_even(count(*) / s.n::DOUBLE, 4) END AS per_staff_mixed FROM once o JOIN s ON s.province = o.province GROUP BY o.province, s.n, s.b")
def A14_works_per_staff(spark, sf_dir):
    """Two bases that are never compared stand in two columns."""
    staff = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("province")).agg(F.count("*").alias("n"), F.max("s_acctbal").alias("b"))
    rows = _once(_works(spark, sf_dir), "province").groupBy("province").agg(F.count("*").alias("works")).join(staff, "province")
    ratio = labels.publish_ratio(panel.safe_ratio("works", "n"))
    return rows.select("province", "works", F.when(F.col("b") > 5000, ratio).alias("per_staff_consistent"), F.when(F.col("b") <= 5000, ratio).alias("per_staff_mixed"))


@query(f"WITH {WORKS}{_ONCE}, m AS (SELECT DISTINCT CASE WHEN province IN (3, 4) AND year >= 1997 THEN 99 ELSE province END AS unit, work, year, cites, n_countries, slice FROM once), g AS (SELECT unit, work, max(year) AS year, max(cites) AS cites, max(n_countries) AS n_countries, max(slice) AS slice FROM m GROUP BY unit, work) SELECT unit, year, {_METRICS} FROM g GROUP BY unit, year")
def A16_merged_units(spark, sf_dir):
    """Units that a mapping with valid years merges; works count once in the merged unit."""
    spans = spark.createDataFrame([(3, 1997, 99), (4, 1997, 99)], "province int, since int, merged int")
    rows = _once(_works(spark, sf_dir), "province").join(spans, "province", "left")
    rows = rows.withColumn("unit", F.when(F.col("year") >= F.col("since"), F.col("merged")).otherwise(F.col("province")))
    return _metrics(_once(rows, "unit"), "unit", "year")


@query(f"WITH {WORKS}, t AS (SELECT inst, count(*) AS works FROM works GROUP BY inst), k AS (SELECT *, row_number() OVER (ORDER BY works DESC, inst) AS rn FROM t) SELECT k.inst, k.works, string_agg(y.year || ':' || y.n, ',' ORDER BY y.year) AS by_year FROM k JOIN (SELECT inst, year, count(*) AS n FROM works GROUP BY inst, year) y ON y.inst = k.inst WHERE rn <= 40 GROUP BY k.inst, k.works")
def A18_top_institutions(spark, sf_dir):
    works = _works(spark, sf_dir)
    top = works.groupBy("inst").agg(F.count("*").alias("works")).orderBy(F.col("works").desc(), "inst").limit(40)  # the report's 40
    years = works.groupBy("inst", "year").agg(F.count("*").alias("n")).groupBy("inst").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("year", "n"))), lambda s: F.concat_ws(":", s["year"], s["n"])), ",").alias("by_year"))
    return top.join(years, "inst")


@query(f"WITH {WORKS} SELECT inst, sum(cites)::BIGINT AS cites, round(avg(CASE WHEN n_countries > 1 THEN 1.0 ELSE 0.0 END), 9) AS intl_share, count(*) FILTER (slice = 'ai') AS ai, count(*) FILTER (slice = 'edu') AS edu FROM works GROUP BY inst")
def A29_institution_totals(spark, sf_dir):
    return _works(spark, sf_dir).groupBy("inst").agg(F.sum("cites").alias("cites"), F.round(F.avg((F.col("n_countries") > 1).cast("double")), 9).alias("intl_share"), F.count_if(F.col("slice") == "ai").alias("ai"), F.count_if(F.col("slice") == "edu").alias("edu"))


_CLASSED = f"""WITH {SOURCES},
bq AS (SELECT ranking, unnest(string_split(issns, ',')) AS issn, coalesce(nullif(regexp_extract(categories, '\\((Q[1-4])\\)', 1), ''), CASE WHEN quartile <> '-' THEN quartile END) AS q FROM rankings),
js AS (SELECT source, kind, unnest(string_split(issns, ',')) AS issn FROM journals),
m AS (SELECT js.source, arg_min(bq.q, coalesce(bq.q, 'Q9') || lpad(bq.ranking::VARCHAR, 12, '0')) AS q, count(bq.ranking) AS hits FROM js LEFT JOIN bq ON bq.issn = js.issn GROUP BY js.source),
classed AS (SELECT j.source, CASE WHEN j.kind <> 'journal' THEN j.kind WHEN m.hits = 0 THEN 'unranked' WHEN m.q IS NULL THEN 'no_quartile' ELSE m.q END AS class FROM journals j JOIN m ON m.source = j.source)"""


def _classed(spark, sf_dir) -> DataFrame:
    """The best ranking by any of several numbers, then the class. A number that many rankings and journals share would pair
    all of them: the rankings of a number are one row, its best, before journals meet it."""
    ranked = adapted(spark, sf_dir, SOURCES, "rankings").select("ranking", F.explode(F.split("issns", ",")).alias("issn"), labels.best_quartile(F.col("categories"), F.col("quartile")).alias("q"))
    ranked = ranked.groupBy("issn").agg(F.min(F.struct(F.coalesce("q", F.lit("Q9")).alias("o"), "ranking", "q")).alias("best"))
    journals = adapted(spark, sf_dir, SOURCES, "journals").select("source", "kind", F.explode(F.split("issns", ",")).alias("issn"))
    best = journals.join(ranked, "issn", "left").groupBy("source", "kind").agg(F.min("best").alias("best"))
    q = F.col("best.q")
    return best.select("source", F.when(F.col("kind") != "journal", F.col("kind")).when(F.col("best").isNull(), "unranked").when(q.isNull(), "no_quartile").otherwise(q).alias("class"))


@query(_CLASSED + " SELECT * FROM classed")
def J21_source_classes(spark, sf_dir):
    return _classed(spark, sf_dir)


@query(_CLASSED + """, c AS (SELECT s.bucket, s.scope, s.year, coalesce(k.class, 'unknown') AS class, sum(s.works) AS works FROM source_counts s LEFT JOIN classed k ON k.source = s.source GROUP BY ALL),
g AS (SELECT b.bucket, b.scope, y.year, k.class FROM (SELECT DISTINCT bucket, scope FROM c) b CROSS JOIN (SELECT DISTINCT year FROM c) y CROSS JOIN (SELECT DISTINCT class FROM c) k)
SELECT *, sum(works) OVER w::BIGINT AS total, round(100 * works / nullif(sum(works) OVER w, 0), 9) AS share FROM (SELECT g.*, coalesce(c.works, 0)::BIGINT AS works FROM g LEFT JOIN c ON c.bucket = g.bucket AND c.scope = g.scope AND c.year = g.year AND c.class = g.class) WINDOW w AS (PARTITION BY bucket, scope, year)""")
def A19_class_counts(spark, sf_dir):
    """Works by class in a full grid, with the totals of all classes and shares in per cent."""
    counts = adapted(spark, sf_dir, SOURCES, "source_counts").join(_classed(spark, sf_dir), "source", "left").withColumn("class", F.coalesce("class", F.lit("unknown"))).groupBy("bucket", "scope", "year", "class").agg(F.sum("works").alias("works"))
    counts = written(counts, "class-counts")
    pairs, years, classes = counts.select("bucket", "scope").distinct(), counts.agg(F.sort_array(F.collect_set("year")).alias("ys")), counts.agg(F.sort_array(F.collect_set("class")).alias("cs"))
    grid = pairs.join(years).join(classes).select("bucket", "scope", F.explode("ys").alias("year"), "cs").select("bucket", "scope", "year", F.explode("cs").alias("class"))
    grid = grid.join(counts, ["bucket", "scope", "year", "class"], "left").withColumn("works", F.coalesce("works", F.lit(0)))
    total = F.sum("works").over(Window.partitionBy("bucket", "scope", "year"))
    return grid.withColumn("total", total).withColumn("share", F.round(100 * panel.safe_ratio("works", "total"), 9))


@query(_CLASSED + ", t AS (SELECT s.bucket, s.scope, s.source, sum(s.works) AS works FROM source_counts s JOIN classed k ON k.source = s.source WHERE k.class NOT IN ('repository') GROUP BY ALL) SELECT bucket, scope, source, works::BIGINT AS works, rn::INT AS rn FROM (SELECT *, row_number() OVER (PARTITION BY bucket, scope ORDER BY works DESC, source) AS rn FROM t) x WHERE rn <= 15")
def A20_top_sources(spark, sf_dir):
    rows = adapted(spark, sf_dir, SOURCES, "source_counts").join(_classed(spark, sf_dir).filter("class <> 'repository'"), "source").groupBy("bucket", "scope", "source").agg(F.sum("works").alias("works"))
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy("bucket", "scope").orderBy(F.col("works").desc(), "source"))).filter("rn <= 15")


_COORDS = "WITH i AS (SELECT s_suppkey AS inst, s_nationkey AS nation, (s_suppkey * 37 % 360) / 10.0::DOUBLE AS lon, (s_suppkey * 53 % 200) / 10.0::DOUBLE AS lat FROM supplier), c AS (SELECT n_nationkey AS capital, (n_nationkey * 71 % 360) / 10.0::DOUBLE AS lon, (n_nationkey * 29 % 200) / 10.0::DOUBLE AS lat FROM nation)"


_NEAREST = _COORDS + """, d AS (SELECT inst, capital, i.nation, sqrt(pow((i.lon - c.lon) * cos(radians((i.lat + c.lat) / 2)), 2) + pow(i.lat - c.lat, 2)) * 111.32 AS km, pow((i.lon - c.lon) * 0.75::DOUBLE, 2) + pow(i.lat - c.lat, 2) AS d FROM i CROSS JOIN c),
near AS (SELECT inst, capital, nation, km FROM d QUALIFY row_number() OVER (PARTITION BY inst ORDER BY d, capital) = 1)"""
#: Fixed values of the demonstration: institutions placed by hand, and the dictionary of cities (here nations) with their province.
MANUAL, CITIES = [(1, 5), (2, 6)], [(3, 103), (8, 108), (11, 111)]


def nearest(spark, sf_dir) -> DataFrame:
    """(inst, capital, nation, km): the nearest of a dimension of capitals (one row per province), the smaller one on ties."""
    s, n = F.col("s_suppkey"), F.col("n_nationkey")
    i = table(spark, sf_dir, "supplier").select(s.alias("inst"), F.col("s_nationkey").alias("nation"), ((s * 37 % 360) / 10).alias("lon"), ((s * 53 % 200) / 10).alias("lat"))
    c = table(spark, sf_dir, "nation").select(n.alias("site"), ((n * 71 % 360) / 10).alias("x"), ((n * 29 % 200) / 10).alias("y"))
    best = places.nearest(i.select(F.col("inst").alias("id"), F.col("lon").alias("x"), F.col("lat").alias("y")), c, 0.75).select(F.col("id").alias("inst"), F.col("site").alias("capital"))
    rows = i.join(best, "inst").join(c.select(F.col("site").alias("capital"), F.col("x").alias("clon"), F.col("y").alias("clat")), "capital")
    return rows.select("inst", "capital", "nation", labels.distance_km(F.col("lon"), F.col("lat"), F.col("clon"), F.col("clat")).alias("km"))


@query(_NEAREST + " SELECT inst, capital, round(km, 6) AS km, capital = nation AS agrees FROM near")
def J18_nearest_capital(spark, sf_dir):
    """The nearest capital with its distance (F24), and whether it is the one of the printed nation."""
    return nearest(spark, sf_dir).select("inst", "capital", F.round("km", 6).alias("km"), (F.col("capital") == F.col("nation")).alias("agrees"))


@query(_NEAREST + f", m(inst, place) AS (VALUES {', '.join(map(str, MANUAL))}), y(nation, place) AS (VALUES {', '.join(map(str, CITIES))}) SELECT inst, coalesce(m.place, y.place, capital)::INT AS province, CASE WHEN m.place IS NOT NULL THEN 'manual' WHEN y.place IS NOT NULL THEN 'city' ELSE 'nearest' END AS method FROM near LEFT JOIN m USING (inst) LEFT JOIN y USING (nation)")
def J19_mapping_cascade(spark, sf_dir):
    """By hand, else by the city dictionary, else the nearest, and which it was."""
    manual = spark.createDataFrame(MANUAL, "inst long, _m int")
    cities = spark.createDataFrame(CITIES, "nation int, _c int")
    rows = nearest(spark, sf_dir).join(manual, "inst", "left").join(cities, "nation", "left")
    return rows.select("inst", F.coalesce("_m", "_c", "capital").cast("int").alias("province"), F.when(F.col("_m").isNotNull(), "manual").when(F.col("_c").isNotNull(), "city").otherwise("nearest").alias("method"))


@query(None)
def J20_fuzzy_names(spark, sf_dir):
    """Misprinted names against a list of names: the best by difflib's ratio from 0.82 on."""
    n = F.col("n_name")
    right = table(spark, sf_dir, "nation").select(n.alias("name"))
    left = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    left = left.select(F.when(F.col("c_custkey") % 3 == 0, F.lower(n)).when(F.col("c_custkey") % 3 == 1, F.concat(n, F.lit("S"))).otherwise(F.translate(n, "AEI", "")).alias("name"))
    return mapping.fuzzy_match(left, right)


@query("SELECT o_orderkey AS student, c.c_custkey AS teacher, nullif(n_nationkey, 9) AS school, CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal END AS years, r_name AS region FROM orders LEFT JOIN customer c ON o_custkey = c.c_custkey AND c.c_custkey % 7 > 0 LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey < 4")
def J23_microdata_links(spark, sf_dir):
    """Students with what is known of their teacher, school and region; codes for missing answers are null."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").filter("c_custkey % 7 > 0"), F.col("o_custkey") == F.col("c_custkey"), "left")
    rows = rows.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(table(spark, sf_dir, "region").filter("r_regionkey < 4"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return rows.select(F.col("o_orderkey").alias("student"), F.col("c_custkey").alias("teacher"), labels.null_if_code(F.col("n_nationkey"), [9]).alias("school"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("years"), F.col("r_name").alias("region"))


@query(f"WITH {WORKS}, units AS (SELECT DISTINCT unnest(['province ' || province, 'region ' || n_regionkey, 'nation']) AS unit, work, year, cites, n_countries, slice FROM works JOIN nation ON n_nationkey = province), once AS (SELECT unit, work, max(year) AS year, max(cites) AS cites, max(n_countries) AS n_countries, max(slice) AS slice FROM units GROUP BY ALL) SELECT unit, year, {_METRICS} FROM once GROUP BY ALL")
def A12_unions(spark, sf_dir):
    """Works of provinces, groups and the nation, each counted once per unit, in one pass over the units of a work."""
    rows = _works(spark, sf_dir).join(table(spark, sf_dir, "nation"), F.col("province") == F.col("n_nationkey"))
    unit = F.explode(F.array(F.concat(F.lit("province "), "province"), F.concat(F.lit("region "), "n_regionkey"), F.lit("nation")))
    return _metrics(_once(rows.withColumn("unit", unit), "unit"), "unit", "year")


@query(f"WITH {WORKS}, units AS (SELECT unnest(['province ' || province, 'region ' || n_regionkey, 'nation']) AS unit, work, n_countries FROM works JOIN nation ON n_nationkey = province) SELECT unit, count(DISTINCT work) AS works, count(DISTINCT work) FILTER (n_countries > 1) AS international FROM units GROUP BY unit")
def A12_union_sizes(spark, sf_dir):
    """Works of provinces, groups and the nation out of the bitmaps of each province, which stand in one row for both counts."""
    works, sets = unions.numbered(_works(spark, sf_dir).select("province", "work", (F.col("n_countries") > 1).alias("abroad")), "work"), {"works": F.lit(True), "international": F.col("abroad")}
    provinces = written(unions.bitmaps(works, ["province"], "number", sets), "bitmaps")
    regions = provinces.join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("province"), "n_regionkey"), "province")
    levels = [F.concat(F.lit("province "), "province"), F.concat(F.lit("region "), "n_regionkey"), F.lit("nation")]
    return reduce(DataFrame.unionByName, [unions.sizes(unions.merged(regions, {"unit": unit}, sets), ["unit"], sets=sets) for unit in levels])


@query(f"""WITH {WORKS}, {HIGHER}, u AS (SELECT work, max(year) AS year FROM works GROUP BY work), w AS (SELECT year, count(*) AS works FROM u GROUP BY year),
s AS (SELECT year, sum(value) FILTER (university = 'all_reported') AS a, sum(value) FILTER (university <> 'all_reported') AS b, count(DISTINCT province) AS units FROM staff WHERE staff_rank = 'all' GROUP BY year)
SELECT year, works, units AS coverage, a AS staff, round(works / nullif(a, 0), 9) AS per_staff_printed, round(works / nullif(b, 0), 9) AS per_staff_parts FROM w LEFT JOIN s USING (year)""")
def A30_national_ratios(spark, sf_dir):
    """The national series with its coverage, staff and the ratio on either basis."""
    works = _works(spark, sf_dir).groupBy("work").agg(F.max("year").alias("year")).groupBy("year").agg(F.count("*").alias("works"))
    every = F.col("university") == "all_reported"
    staff = adapted(spark, sf_dir, HIGHER, "staff").filter("staff_rank = 'all'").groupBy("year").agg(F.sum(F.when(every, F.col("value"))).alias("staff"), F.sum(F.when(~every, F.col("value"))).alias("b"), F.count_distinct("province").alias("coverage"))
    return works.join(staff, "year", "left").select("year", "works", "coverage", "staff", F.round(panel.safe_ratio("works", "staff"), 9).alias("per_staff_printed"), F.round(panel.safe_ratio("works", "b"), 9).alias("per_staff_parts"))


# ---- survey

_PVS = [f"pv{i}" for i in range(1, 6)]


@query(f"""WITH {SURVEY}, p AS (SELECT zone, rep, w, unnest([pv1, pv2, pv3, pv4, pv5]) AS v, unnest([1, 2, 3, 4, 5]) AS pv FROM survey),
c AS (SELECT pv, zone, sum(w) AS w, sum(w * v) AS wv, sum(CASE WHEN rep = 1 THEN w ELSE 0 END) AS w1, sum(CASE WHEN rep = 1 THEN w * v ELSE 0 END) AS wv1 FROM p GROUP BY pv, zone),
m AS (SELECT *, sum(wv) OVER q / sum(w) OVER q AS mean, (sum(wv) OVER q - wv + 2 * wv1) / (sum(w) OVER q - w + 2 * w1) AS r FROM c WINDOW q AS (PARTITION BY pv)),
e AS (SELECT pv, any_value(mean) AS mean, sum(pow(r - mean, 2)) AS s FROM m GROUP BY pv)
SELECT round(avg(mean), 6) AS estimate, round(sqrt(avg(s) + 1.2 * var_samp(mean)), 6) AS se FROM e""")
def X6_jackknife_mean(spark, sf_dir):
    out = statistics.jackknife_mean(adapted(spark, sf_dir, SURVEY, "survey"), "w", _PVS, "zone", "rep")
    return out.select(F.round("estimate", 6).alias("estimate"), F.round("se", 6).alias("se"))


@query(f"""WITH {SURVEY}, p AS (SELECT zone, rep, w, size AS x, unnest([pv1, pv2, pv3, pv4, pv5]) AS y, unnest([1, 2, 3, 4, 5]) AS pv FROM survey),
c AS (SELECT pv, zone, sum(w) AS a, sum(w * x) AS b, sum(w * x * x) AS c, sum(w * y) AS d, sum(w * x * y) AS e, ifnull(sum(w) FILTER (rep = 1), 0) AS a1, ifnull(sum(w * x) FILTER (rep = 1), 0) AS b1, ifnull(sum(w * x * x) FILTER (rep = 1), 0) AS c1, ifnull(sum(w * y) FILTER (rep = 1), 0) AS d1, ifnull(sum(w * x * y) FILTER (rep = 1), 0) AS e1 FROM p GROUP BY ALL),
t AS (SELECT pv, sum(a) AS a, sum(b) AS b, sum(c) AS c, sum(d) AS d, sum(e) AS e FROM c GROUP BY pv),
r AS (SELECT pv, (t.a * t.e - t.b * t.d) / (t.a * t.c - t.b * t.b) AS whole, t.a - c.a + 2 * a1 AS ra, t.b - c.b + 2 * b1 AS rb, t.c - c.c + 2 * c1 AS rc, t.d - c.d + 2 * d1 AS rd, t.e - c.e + 2 * e1 AS re FROM c JOIN t USING (pv)),
s AS (SELECT pv, any_value(whole) AS slope, sum(pow((ra * re - rb * rd) / (ra * rc - rb * rb) - whole, 2)) AS v FROM r GROUP BY pv)
SELECT round(avg(slope), 5) AS slope, round(sqrt(avg(v) + 1.2 * var_samp(slope)), 5) AS se FROM s""")
def X7_weighted_slope(spark, sf_dir):
    out = statistics.weighted_slope(adapted(spark, sf_dir, SURVEY, "survey"), "w", "size", _PVS, "zone", "rep")
    return out.select(F.round("slope", 5).alias("slope"), F.round("se", 5).alias("se"))


@query(None)
def X7_controls(spark, sf_dir):
    """The slope on class size with controls; a regression on dense matrices is its test."""
    out = statistics.weighted_regression(adapted(spark, sf_dir, SURVEY, "survey").withColumn("school_size", F.col("school") % 5), "w", ["size", "girl", "school_size"], _PVS, "zone", "rep")
    return out.select("term", F.round("slope", 5).alias("slope"), F.round("se", 5).alias("se"))


@query(None)
def X7_dummies(spark, sf_dir):
    """Bands of class size and regions as dummies, with girls as a control; tested on dense matrices under every replicate."""
    rows = adapted(spark, sf_dir, SURVEY, "survey").withColumn("band", labels.band(F.col("size"), [10, 15, 20])).withColumn("region", F.col("school") % 4)
    out = statistics.weighted_regression(rows, "w", ["girl"], _PVS, "zone", "rep", ["band", "region"])
    return out.select("term", F.round("slope", 5).alias("slope"), F.round("se", 5).alias("se"))


@query(f"WITH {SURVEY}, b AS (SELECT *, CASE WHEN size <= 10 THEN '<=10' WHEN size <= 15 THEN '11-15' WHEN size <= 20 THEN '16-20' WHEN size > 20 THEN '>20' END AS band FROM survey) SELECT band, count(*) AS n, CASE WHEN count(*) >= 30 THEN round(sum(w * pv1) / sum(w), 6) END AS mean, CASE WHEN count(*) >= 30 THEN round(sum(w * girl) / sum(w), 9) END AS girls FROM b GROUP BY band")
def X5_bands(spark, sf_dir):
    """Weighted mean and share per band (F29), with a gate on rows."""
    rows = adapted(spark, sf_dir, SURVEY, "survey").withColumn("band", labels.band(F.col("size"), [10, 15, 20]))
    mean = lambda c, d: F.when(F.count("*") >= 30, F.round(F.sum(F.col("w") * F.col(c)) / F.sum("w"), d))
    return rows.groupBy("band").agg(F.count("*").alias("n"), mean("pv1", 6).alias("mean"), mean("girl", 9).alias("girls"))


@query(f"WITH {SURVEY} SELECT count(*) AS n, count(DISTINCT class) AS classes, count(DISTINCT school) AS schools, round(sum(w * size) / sum(w), 9) AS mean_size, min(size) AS low, max(size) AS high, count(DISTINCT zone) AS zones FROM survey")
def X8_descriptives(spark, sf_dir):
    s = adapted(spark, sf_dir, SURVEY, "survey")
    return s.agg(F.count("*").alias("n"), F.count_distinct("class").alias("classes"), F.count_distinct("school").alias("schools"), F.round(F.sum(F.col("w") * F.col("size")) / F.sum("w"), 9).alias("mean_size"), F.min("size").alias("low"), F.max("size").alias("high"), F.count_distinct("zone").alias("zones"))


# ---- labels, on lines of text and formatted keys

_LABELS = "WITH l AS (SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN CAST(1300 + o_orderkey % 99 AS STRING) || '-' || CAST(1301 + o_orderkey % 99 AS STRING) WHEN 1 THEN CAST(o_orderkey % 90 AS STRING) || '/' || CAST(o_custkey % 90 AS STRING) WHEN 2 THEN CAST(o_custkey AS STRING) || '(1)' WHEN 3 THEN '-' ELSE 'T ' || CAST(o_orderkey % 20 AS STRING) || '-' || CAST(o_custkey % 9 AS STRING) || '..' END AS s FROM orders)"


@query(_LABELS + r""", n AS (SELECT k, s, trim(regexp_replace(regexp_replace(s, '\(\s*[0-9]+\s*\)', '', 'g'), '[,'' ]', '', 'g'), ' .|') AS t FROM l)
SELECT k, s, CASE WHEN t IN ('', '-') THEN NULL WHEN regexp_full_match(t, '[0-9]+/[0-9]+') THEN (string_split(t, '/')[2] || '.' || string_split(t, '/')[1])::DOUBLE WHEN regexp_full_match(t, '[+-]?[0-9]+(\.[0-9]+)?') THEN t::DOUBLE END AS number,
CASE WHEN regexp_full_match(s, '1[34][0-9]{2}-1[34][0-9]{2}') THEN least(s[1:4]::INT, s[6:9]::INT) END AS start_year, nullif(regexp_extract(s, '[0-9]+-[0-9]+'), '') AS pair FROM n""")
def F3_numbers_and_years(spark, sf_dir):
    """Printed numbers, academic years and table numbers."""
    rows = spark.sql(_LABELS.replace("FROM orders", "FROM {orders}") + " SELECT * FROM l", orders=table(spark, sf_dir, "orders"))
    s = F.col("s")
    year = F.when(s.rlike("^1[34][0-9]{2}-1[34][0-9]{2}$"), labels.parse_academic_year(s))
    pair = labels.table_number(s)
    return rows.select("k", "s", labels.to_number(s).alias("number"), year.alias("start_year"), F.when(pair.contains("-"), pair).alias("pair"))


@query(r"""SELECT doc_id, len(l) AS n_lines, len(list_filter(l, lambda x: regexp_matches(x, '[0-9]'))) AS n_numbered, coalesce(list_max(list_transform(l, lambda x: length(x))), 0) AS longest FROM (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM documents) AS t""")
def F2_line_labels(spark, sf_dir):
    """Labels of all lines: blanks collapsed, edges trimmed."""
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.btrim(F.regexp_replace(x, r"[\t\n\f\r ]+", " "))), lambda x: x != "")
    rows = table(spark, sf_dir, "documents").select("doc_id", lines.alias("l"))
    return rows.select("doc_id", F.size("l").cast("long").alias("n_lines"), F.size(F.filter("l", lambda x: x.rlike("[0-9]"))).cast("long").alias("n_numbered"), F.coalesce(F.array_max(F.transform("l", lambda x: F.length(x).cast("long"))), F.lit(0).cast("long")).alias("longest"))


_CITIES = [("Tehrān", "tehran"), ("Ābādān", "abadan"), ("Tabrīz’", "tabriz"), ("Qom", "qom"), ("Kermān ", "kerman")]
_NAMES = [("Islamic Azad University of Medical Sciences", "azad"), ("Shiraz University of Medical Sciences", "medical"), ("Sharif University of Technology", "technology"), ("Payame Noor", "payame_noor"), ("Yazd University", "university"), ("Institute", "other")]


@query(f"""WITH k AS (SELECT p_partkey AS k, (p_partkey % 5)::INT AS c, (p_partkey % 6)::INT AS g, p_size FROM part)
SELECT k, {[b for _, b in _CITIES]}[c + 1] AS city, {[b for _, b in _NAMES]}[g + 1] AS grp, '12X' || k AS issn, (1380 + p_size + 621)::INT AS gregorian, CASE WHEN 1380 + p_size <= 1390 THEN 'old' ELSE 'new' END AS system, (1380 + p_size)::INT AS prefix, CASE WHEN k % 4 = 0 THEN 'zip' ELSE 'docx' END AS ext, k % 4 = 0 AS archive,
CASE WHEN k % 9 > 0 THEN round(k / 4.0::DOUBLE, 2) END AS shown, (k % 3 <> 0) AS known FROM k""".replace("['", "['"))
def F_scalars(spark, sf_dir):
    """Latin city names (F17), institution groups (F18), journal numbers (F19), years (F6, F7, F14), file names (F15), published
    numbers (F22) and sentinel codes (F23)."""
    k, n = F.col("p_partkey"), 1380 + F.col("p_size")
    pick = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))
    name = F.concat(n.cast("string"), F.lit("-book."), F.when(k % 4 == 0, "ZIP").otherwise("docx"))
    return table(spark, sf_dir, "part").select(
        k.alias("k"), labels.norm_latin(pick([a for a, _ in _CITIES], k % 5)).alias("city"), labels.group_of(pick([a for a, _ in _NAMES], k % 6)).alias("grp"), labels.norm_issn(F.concat(F.lit("12-x"), k)).alias("issn"), labels.to_gregorian(n).alias("gregorian"), labels.system_for(n).alias("system"),
        labels.year_prefix(name).alias("prefix"), labels.file_ext(name).alias("ext"), labels.is_archive(name).alias("archive"), labels.publish_num(F.when(k % 9 > 0, k / 4).otherwise(F.lit(float("nan")))).alias("shown"), labels.null_if_code((k % 3).cast("int"), [0]).isNotNull().alias("known"))


# ---- structure: conversations as blocks, line items as cells

@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS title_turn, count(CASE WHEN role = 'user' THEN 1 END) OVER (PARTITION BY conv_id ORDER BY turn, role ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS part FROM conversations")
def T6_attach_titles(spark, sf_dir):
    """Each block gets the latest title of its document, and its part."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role").rowsBetween(Window.unboundedPreceding, 0)
    title = F.when(F.col("role") == "user", F.col("turn"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.last(title, True).over(w).alias("title_turn"), F.count(title).over(w).alias("part"))


_CELLS = "cells AS (SELECT l_orderkey AS t, l_linenumber AS r, c, CASE c WHEN 0 THEN l_returnflag || l_linestatus WHEN 1 THEN CASE WHEN l_linenumber = 1 THEN 'qty' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END ELSE CASE WHEN l_linenumber <= l_orderkey % 3 THEN 'tax' ELSE CAST(l_partkey AS STRING) END END AS x FROM lineitem CROSS JOIN (VALUES (0), (1), (2)) AS v(c))"


@query(f"""WITH {_CELLS}, n AS (SELECT t, r, c, x, CASE WHEN regexp_full_match(x, '[0-9]+') THEN 1.0 ELSE 0.0 END AS num FROM cells), ratio AS (SELECT t, r, avg(num) AS a FROM n WHERE c > 0 GROUP BY t, r), d AS (SELECT t, min(r) AS depth FROM ratio WHERE a >= 0.5 GROUP BY t)
SELECT t, depth, (SELECT count(*) FROM ratio x WHERE x.t = d.t AND x.r >= d.depth) AS body_rows FROM d""")
def T3_header_depth(spark, sf_dir):
    """Leading rows whose share of numbers is below a half are header; tables without numbers go."""
    cells = spark.sql(f"WITH {_CELLS} SELECT * FROM cells".replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))
    ratio = cells.filter("c > 0").groupBy("t", "r").agg(F.avg(F.col("x").rlike("^[0-9]+$").cast("double")).alias("a"))
    depth = F.min(F.when(F.col("a") >= 0.5, F.col("r"))).over(Window.partitionBy("t"))
    rows = ratio.withColumn("depth", depth).filter("r >= depth")
    return rows.groupBy("t", "depth").agg(F.count("*").alias("body_rows"))


# ---- rings: embeddings' first two components by label

_RING = "WITH v AS (SELECT label, vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings), n AS (SELECT *, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2 FROM v WINDOW w AS (PARTITION BY label ORDER BY vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"


@query(_RING + ", s AS (SELECT label, count(*) AS n, sum(x * y2 - x2 * y) / 2 AS area, sum((x + x2) * (x * y2 - x2 * y)) AS cx, sum((y + y2) * (x * y2 - x2 * y)) AS cy, avg(x) AS mx, avg(y) AS my FROM n GROUP BY label) SELECT label, n, round(area, 7) AS area, round(CASE WHEN abs(area) > 1e-12 THEN cx / (6 * area) ELSE mx END, 5) AS centre_x, round(CASE WHEN abs(area) > 1e-12 THEN cy / (6 * area) ELSE my END, 5) AS centre_y FROM s")
def G1_ring_area_centroid(spark, sf_dir):
    """Signed area and centroid of rings."""
    w = Window.partitionBy("label").orderBy("vec_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    v = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))
    v = v.select("label", "x", "y", *[F.coalesce(F.lead(c).over(w), F.first(c).over(whole)).alias(f"{c}2") for c in "xy"])
    cross = F.col("x") * F.col("y2") - F.col("x2") * F.col("y")
    s = v.groupBy("label").agg(F.count("*").alias("n"), (F.sum(cross) / 2).alias("area"), F.sum((F.col("x") + F.col("x2")) * cross).alias("cx"), F.sum((F.col("y") + F.col("y2")) * cross).alias("cy"), F.avg("x").alias("mx"), F.avg("y").alias("my"))
    at = lambda c, m: F.round(F.when(F.abs("area") > 1e-12, F.col(c) / (6 * F.col("area"))).otherwise(F.col(m)), 5)
    return s.select("label", "n", F.round("area", 7).alias("area"), at("cx", "mx").alias("centre_x"), at("cy", "my").alias("centre_y"))


_FIT = _RING + ", p AS (SELECT label, vec_id, x * cos(radians(32.0::DOUBLE)) AS px, -y AS py FROM v), e AS (SELECT min(px) AS ax, max(px) AS bx, min(py) AS ay, max(py) AS by_, least(1000.0::DOUBLE / (max(px) - min(px)), 800.0::DOUBLE / (max(py) - min(py))) AS k FROM p)"


@query(_FIT + " SELECT label, vec_id, round((px - (ax + bx) / 2) * k + 500, 6) AS sx, round((py - (ay + by_) / 2) * k + 400, 6) AS sy FROM p, e")
def G3_fitted(spark, sf_dir):
    """Vertices projected and fitted to a view box: one scale for both axes, centred."""
    v = table(spark, sf_dir, "embeddings").select("label", "vec_id", labels.project(F.get("embedding", F.lit(0)).cast("double"), F.get("embedding", F.lit(1)).cast("double")).alias("p")).select("label", "vec_id", "p.*")
    box = v.agg(F.min("x").alias("ax"), F.max("x").alias("bx"), F.min("y").alias("ay"), F.max("y").alias("by"))  # one row
    k = F.least(1000.0 / (F.col("bx") - F.col("ax")), 800.0 / (F.col("by") - F.col("ay")))
    at = lambda c, a, b, half: F.round((F.col(c) - (F.col(a) + F.col(b)) / 2) * k + half, 6)
    return v.join(box).select("label", "vec_id", at("x", "ax", "bx", 500).alias("sx"), at("y", "ay", "by", 400).alias("sy"))


@query(_RING + ", s AS (SELECT label, abs(sum(x * y2 - x2 * y)) / 2 AS area, count(*) AS n, string_agg(floor(x * 100)::INT || ',' || floor(y * 100)::INT, ' ' ORDER BY vec_id) AS path FROM n GROUP BY label) SELECT label % 3 AS feature, label AS ring, n, round(area, 7) AS area, path FROM s QUALIFY row_number() OVER (PARTITION BY label % 3 ORDER BY area DESC, label) = 1")
def G5_label_ring(spark, sf_dir):
    """The largest ring of every feature, which carries its label, and its path as text."""
    w = Window.partitionBy("label").orderBy("vec_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    v = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))
    v = v.select("label", "vec_id", "x", "y", *[F.coalesce(F.lead(c).over(w), F.first(c).over(whole)).alias(f"{c}2") for c in "xy"])
    point = F.concat_ws(",", F.floor(F.col("x") * 100).cast("int"), F.floor(F.col("y") * 100).cast("int"))
    rings = v.groupBy("label").agg((F.abs(F.sum(F.col("x") * F.col("y2") - F.col("x2") * F.col("y"))) / 2).alias("area"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("vec_id", point.alias("p")))).alias("points"))
    best = F.min_by(F.struct(F.col("label").alias("ring"), "n", "area", "points"), F.struct(-F.col("area"), F.col("label"))).alias("b")
    rows = rings.groupBy((F.col("label") % 3).alias("feature")).agg(best).select("feature", "b.*")
    return rows.select("feature", "ring", "n", F.round("area", 7).alias("area"), F.array_join(F.transform("points", lambda p: p["p"]), " ").alias("path"))


@query(r"""SELECT page_id, len(regexp_extract_all(html, '(?s)<li>.*?</li>'))::BIGINT AS items, len(regexp_extract_all(html, '(?s)<li><a href="([^"]*)"', 1))::BIGINT AS links FROM pages""")
def S9_list_items(spark, sf_dir):
    """List items and their links out of pages."""
    html = F.coalesce("html", F.lit(""))
    count = lambda p: F.size(F.regexp_extract_all(html, F.lit(p), F.lit(0))).cast("long")
    return table(spark, sf_dir, "pages").select("page_id", count(r"(?s)<li>.*?</li>").alias("items"), count(r'(?s)<li><a href="([^"]*)"').alias("links"))


@query("SELECT event_type, date_trunc('day', ts)::DATE AS day, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def A3_grouped_totals(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT c_nationkey AS code, n_name AS name, count(*) AS members FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL UNION ALL SELECT NULL, 'all', count(*) FROM customer")
def A23_appended_total(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    each = rows.groupBy(F.col("c_nationkey").alias("code"), F.col("n_name").alias("name")).agg(F.count("*").alias("members"))
    return each.unionByName(table(spark, sf_dir, "customer").agg(F.lit(None).cast("int").alias("code"), F.lit("all").alias("name"), F.count("*").alias("members")))


@query("WITH a AS (SELECT DISTINCT s_nationkey AS n FROM supplier), y AS (SELECT n_nationkey AS n, n_name FROM nation) SELECT r_name AS region, string_agg(n_name, ',' ORDER BY n_name) FILTER (a.n IS NULL) AS missing, count(*) FILTER (a.n IS NULL) || '/' || count(*) AS label FROM y LEFT JOIN a ON a.n = y.n JOIN nation ON n_nationkey = y.n JOIN region ON r_regionkey = n_regionkey GROUP BY r_name".replace("SELECT n_nationkey AS n, n_name FROM nation", "SELECT n_nationkey AS n FROM nation"))
def A22_missing_units(spark, sf_dir):
    """Units without rows, listed and counted per group; groups without any stay."""
    have = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), F.lit(True).alias("has")).distinct()
    rows = table(spark, sf_dir, "nation").join(have, "n_nationkey", "left").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    gone = F.array_sort(F.collect_list(F.when(F.col("has").isNull(), F.col("n_name"))))
    return rows.groupBy(F.col("r_name").alias("region")).agg(F.when(F.size(gone) > 0, F.array_join(gone, ",")).alias("missing"), F.concat_ws("/", F.size(gone), F.count("*")).alias("label"))
