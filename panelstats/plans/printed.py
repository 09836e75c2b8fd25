"""Printed tables: structuring, dictionary mapping, footnotes and catalogue, with their queries.

``PRINTED`` prints one table for each customer out of numeric codes (a row for each order, with Persian labels and
digits). The queries read the print; their SQL reads the codes, so that both ways to a result are independent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelstats.functions import labels
from panelstats.operators import lines, mapping, rings, structure
from panelstats.sources import table, written
from panelstats.sources.adapters import adapted

QUERIES, ORACLES = {}, {}
_PLACES = ", ".join(f"({i}, '{code}', '{name}')" for i, (code, name) in enumerate(mapping.PROVINCES[:31]))
YEARBOOK = 1403
PRINTED = f"""
codes AS (SELECT o_custkey AS t, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) + 1 AS r, CAST(o_orderkey % 4 AS INT) AS kind, CAST(o_orderkey % 31 AS INT) AS place, CAST(year(o_orderdate) - 600 AS INT) AS y,
    CAST(floor(o_totalprice) AS INT) AS v, CAST(o_orderkey % 7 AS INT) AS gap, o_orderkey AS k FROM orders),
places AS (SELECT * FROM (VALUES {_PLACES}) AS p(place, code, name)),
tables AS (SELECT c_custkey AS t, c_custkey % 3 AS subject, c_nationkey AS doc, CASE c_custkey % 3 WHEN 0 THEN '7-' || CAST(c_custkey % 30 AS STRING) || '- دانش آموزان دوره ابتدايي' WHEN 1 THEN '17-' || CAST(c_custkey % 30 AS STRING) || '- دانشجويان کشور (1)' ELSE '9-' || CAST(c_custkey % 30 AS STRING) || '- بودجه آموزش' END AS title,
    CASE c_custkey % 3 WHEN 0 THEN 'ماخذ: مرکز آمار' ELSE '1) به استثناي دانشگاه آزاد اسلامي¶مبنا: سرشماري¶شامل اساتيد نيمه وقت' END AS notes FROM customer),
body AS (SELECT codes.*, code, CASE WHEN r % 5 = 0 THEN 'نقاط روستايي' WHEN kind = 0 THEN CAST(y AS STRING) || '-' || CAST(y + 1 AS STRING) WHEN kind = 3 THEN 'رديف ناشناس' ELSE name END AS label,
    CASE WHEN r % 5 = 0 THEN '…' ELSE translate(CAST(v AS STRING), '0123456789', '۰۱۲۳۴۵۶۷۸۹') END AS a, CASE WHEN r % 5 = 0 OR gap = 0 THEN '-' ELSE CAST(v % 90 AS STRING) || '/' || CAST(v % 50 AS STRING) END AS b, CASE WHEN r % 5 = 0 THEN '×' ELSE CAST(v + 1 AS STRING) END AS e
  FROM codes JOIN places USING (place)),
cells AS (SELECT t, r, c, CASE c WHEN 0 THEN label WHEN 1 THEN a WHEN 2 THEN b ELSE e END AS x FROM body CROSS JOIN (VALUES (0), (1), (2), (3)) AS w(c)
  UNION ALL SELECT t, h AS r, c, CASE WHEN h = 0 AND c = 0 THEN 'شرح' WHEN h = 0 AND c < 3 THEN 'تعداد' WHEN h = 0 THEN CASE subject WHEN 0 THEN 'معلمان' ELSE 'غيره' END WHEN c = 1 THEN 'مرد' WHEN c = 2 THEN 'زن' ELSE '' END AS x
    FROM (SELECT * FROM tables WHERE t IN (SELECT t FROM codes)) AS known CROSS JOIN (VALUES (0), (1)) AS hh(h) CROSS JOIN (VALUES (0), (1), (2), (3)) AS w(c))
"""


def query(sql: str | None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"WITH {PRINTED}{sql}"
        return f

    return put


def _of(spark, sf_dir, name: str) -> DataFrame:
    return adapted(spark, sf_dir, PRINTED, name)


def _tables(spark, sf_dir) -> DataFrame:
    return _of(spark, sf_dir, "tables").select("t", "title", F.lit(YEARBOOK).alias("yearbook"), F.split("notes", "¶").alias("notes"))


def laid_out(spark, sf_dir) -> DataFrame:
    return structure.laid_out(structure.clean_grid(_of(spark, sf_dir, "cells"), edges=True))


@query(" SELECT t, 0 AS label_c, 2 AS depth, count(*) + 2 AS n_rows FROM codes GROUP BY t")
def T2_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean grids, label side and header depth (T1, T2, T3, F4) of printed tables."""
    return laid_out(spark, sf_dir).groupBy("t", "label_c", "depth").agg(F.count_distinct("r").alias("n_rows"))


@query(" SELECT DISTINCT t, c, CASE c WHEN 1 THEN 'تعداد > مرد' WHEN 2 THEN 'تعداد > زن' ELSE CASE t % 3 WHEN 0 THEN 'معلمان' ELSE 'غيره' END END AS path FROM codes CROSS JOIN (VALUES (1), (2), (3)) AS w(c)")
def T4_printed_paths(spark, sf_dir):
    return structure.header_paths(laid_out(spark, sf_dir))


_NUMBERS = "CASE WHEN r % 5 = 0 THEN NULL ELSE CASE c WHEN 1 THEN v::DOUBLE WHEN 2 THEN CASE WHEN gap <> 0 THEN ((v % 50)::VARCHAR || '.' || (v % 90)::VARCHAR)::DOUBLE END ELSE v + 1.0 END END"


@query(f" SELECT t, r, label, c, {_NUMBERS} AS number FROM body CROSS JOIN (VALUES (1), (2), (3)) AS w(c)")
def T5_body_rows(spark, sf_dir):
    """Body rows with their numbers."""
    return structure.body_cells(laid_out(spark, sf_dir))


@query(" SELECT DISTINCT title, CASE subject WHEN 0 THEN 'k12' WHEN 1 THEN 'he' ELSE 'other' END AS domain, CASE subject WHEN 2 THEN NULL ELSE 'students' END AS subjects, CASE subject WHEN 0 THEN '7' WHEN 1 THEN '17' ELSE '9' END || '-' || (t % 30)::VARCHAR AS table_no FROM tables")
def M2_title_domain(spark, sf_dir):
    """Domain, subjects and number of titles."""
    tags = mapping.subjects(F.col("title"))
    titles = _of(spark, sf_dir, "tables").select("title").distinct().filter(labels.is_title(F.col("title")))
    return titles.select("title", mapping.classify_domain(F.col("title")).alias("domain"), F.when(F.size(tags) > 0, F.array_join(tags, ",")).alias("subjects"), labels.table_number(F.col("title")).alias("table_no"))


@query(" SELECT DISTINCT title, CASE subject WHEN 0 THEN 'دانشآموزاندورهابتدایی' WHEN 1 THEN 'دانشجویانکشور' ELSE 'بودجهآموزش' END AS key FROM tables")
def F10_title_keys(spark, sf_dir):
    """Titles without numbers, marks and blanks."""
    return _of(spark, sf_dir, "tables").select("title", labels.title_key(F.col("title")).alias("key")).distinct()


@query(" SELECT DISTINCT t, c, CASE c WHEN 1 THEN 'male' WHEN 2 THEN 'female' END AS gender, CASE WHEN c = 3 AND t % 3 = 0 THEN 'teachers' END AS metric, CASE WHEN c = 3 AND t % 3 <> 0 THEN 'غیره' END AS unmatched FROM codes CROSS JOIN (VALUES (1), (2), (3)) AS w(c) WHERE t % 3 < 2")
def M3_map_headers(spark, sf_dir):
    """Header parts from the bottom up, and what no rule knows."""
    domain = mapping.with_domain(_tables(spark, sf_dir).select("t", "title")).filter("domain <> 'other'").select("t", "domain")
    paths = written(structure.header_paths(laid_out(spark, sf_dir)).join(domain, "t"), "paths")
    return mapping.map_headers(paths, mapping.terms(spark), ["t", "c"], ["gender", "metric"]).select("t", "c", "gender", "metric", "unmatched")


@query(" SELECT DISTINCT label, CASE WHEN r % 5 <> 0 AND kind = 0 THEN y END AS year, CASE WHEN r % 5 = 0 OR kind = 3 THEN NULL WHEN kind = 0 THEN 'IRN' ELSE code END AS province, CASE WHEN r % 5 = 0 THEN 'rural' END AS area FROM body")
def M4_map_rows(spark, sf_dir):
    """Row labels: years before provinces (M5, by their names) before rules."""
    rows = _of(spark, sf_dir, "body").select("label").distinct().withColumn("domain", F.lit("k12"))
    return mapping.map_rows(written(rows, "labels"), mapping.terms(spark), ["area"]).select("label", F.col("row_year").alias("year"), F.col("row_province").alias("province"), F.col("row_area").alias("area"))


_FACTS = f""",
years AS (SELECT t, max(y) FILTER (kind = 0 AND r % 5 <> 0) AS year FROM codes GROUP BY t),
expected AS (SELECT b.t, r, c, CASE b.t % 3 WHEN 0 THEN 'k12' ELSE 'he' END AS domain, CASE WHEN kind = 0 THEN y ELSE ifnull(years.year, {YEARBOOK}) END AS year, CASE WHEN kind IN (1, 2) THEN code ELSE 'IRN' END AS province,
  CASE c WHEN 1 THEN 'male' WHEN 2 THEN 'female' ELSE 'total' END AS gender, CASE WHEN r > 5 THEN 'rural' ELSE 'total' END AS area, CASE WHEN c = 3 AND b.t % 3 = 0 THEN 'teachers' ELSE 'students' END AS metric,
  CASE b.t % 3 WHEN 0 THEN 'primary' ELSE 'all_levels' END AS level, CASE b.t % 3 WHEN 1 THEN 'excl_azad' END AS university, CASE b.t % 3 WHEN 1 THEN 'excl_azad,incl_parttime' ELSE '' END AS coverage, {_NUMBERS} AS value,
  CASE WHEN kind = 3 AND r < 5 THEN 'ردیف ناشناس' END AS row_category, CASE WHEN c = 3 AND b.t % 3 = 1 THEN 'غیره' END AS col_category
  FROM body b JOIN years USING (t) CROSS JOIN (VALUES (1), (2), (3)) AS w(c) WHERE b.t % 3 < 2 AND r % 5 <> 0)"""


def printed_rows(spark, sf_dir) -> DataFrame:
    return written(structure.by_row(laid_out(spark, sf_dir)), "rows")


def facts(rows: DataFrame, spark, sf_dir) -> DataFrame:
    return mapping.tables_to_facts(rows, written(_tables(spark, sf_dir), "titles"), mapping.terms(spark))


@query(_FACTS + " SELECT * FROM expected WHERE value IS NOT NULL")
def M10_tables_to_facts(spark, sf_dir):
    """From printed tables to long facts: context (M6), precedence (M7), coverage (M8, F11-F13), what was not understood (M9)."""
    columns = ["t", "r", "c", "domain", "year", "province", "gender", "area", "metric", "level", "university", F.array_join("coverage", ",").alias("coverage"), "value", "row_category", "col_category"]
    return facts(printed_rows(spark, sf_dir), spark, sf_dir).select(*columns)


@query(_FACTS + """ SELECT t, subject, n_rows, n_provinces, has_years, CASE WHEN n_provinces >= 10 THEN 'province' WHEN has_years OR n_provinces = 0 THEN 'national' ELSE 'some-provinces' END AS geo, ifnull(n, 0) AS n_facts
FROM (SELECT t, t % 3 AS subject, count(*) AS n_rows, count(DISTINCT code) FILTER (r % 5 <> 0 AND kind IN (1, 2)) AS n_provinces, coalesce(bool_or(r % 5 <> 0 AND kind = 0), false) AS has_years FROM body GROUP BY t) LEFT JOIN (SELECT t, count(*) AS n FROM expected WHERE value IS NOT NULL GROUP BY t) USING (t)""")
def T13_table_catalogue(spark, sf_dir):
    """One row per table: rows, provinces, years, geographic class and number of facts."""
    rows = printed_rows(spark, sf_dir)
    known = mapping.map_rows(written(structure.body_of(rows).select("t", "label", F.lit("k12").alias("domain")), "body"), mapping.terms(spark), ["area"])
    provinces = F.count_distinct(F.when(F.col("row_year").isNull() & (F.col("row_province") != "IRN"), F.col("row_province")))
    out = known.groupBy("t").agg(F.count("*").alias("n_rows"), provinces.alias("n_provinces"), F.coalesce(F.max(F.col("row_year").isNotNull()), F.lit(False)).alias("has_years"))
    n = written(facts(rows, spark, sf_dir).groupBy("t").agg(F.count("*").alias("n")), "facts")
    return out.join(n.hint("merge"), "t", "left").select("t", (F.col("t") % 3).alias("subject"), "n_rows", "n_provinces", "has_years", structure.geo_class(F.col("n_provinces"), F.col("has_years")).alias("geo"), F.coalesce("n", F.lit(0)).alias("n_facts"))


@query(" SELECT doc, count(*) AS n_tables, count(*) FILTER (subject = 0) AS k12, count(*) FILTER (subject = 1) AS he, CASE WHEN bool_or(subject < 2) THEN 'students' ELSE '' END AS subjects FROM tables GROUP BY doc")
def M12_inventory(spark, sf_dir):
    """Tables of each document by domain, and their subjects."""
    rows = _of(spark, sf_dir, "tables").withColumn("domain", mapping.classify_domain(F.col("title"))).withColumn("tags", F.when(F.col("domain").isin("k12", "he"), mapping.subjects(F.col("title"))))
    return rows.groupBy("doc").agg(F.count("*").alias("n_tables"), F.count_if(F.col("domain") == "k12").alias("k12"), F.count_if(F.col("domain") == "he").alias("he"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("tags")))), ",").alias("subjects"))


@query(""", k AS (SELECT doc, t % 5 AS file, count(DISTINCT title) FILTER (subject < 2) AS n FROM tables GROUP BY ALL) SELECT doc, arg_min(file, file - 10 * n) AS file, max(n) AS n FROM k GROUP BY doc""")
def T11_best_file(spark, sf_dir):
    rows = _of(spark, sf_dir, "tables").select("doc", (F.col("t") % 5).alias("file"), "title", mapping.classify_domain(F.col("title")).isin("k12", "he").alias("in_domain"))
    return structure.best_doc(rows, "doc", "file")


_BLOCKS = """
blocks AS (SELECT o_custkey AS doc, o_orderkey AS block_no, CAST(o_orderkey % 3 AS INT) AS code, CASE WHEN o_orderkey % 5 < 2 THEN 'para' ELSE 'table' END AS kind, o_orderkey % 5 = 0 AS heads, o_orderkey % 5 = 1 AS says,
    CASE o_orderkey % 5 WHEN 0 THEN '7-' || CAST(o_orderkey % 3 AS STRING) || '- عنوان جدول' || CASE WHEN o_orderkey % 2 = 0 THEN ' (دنباله)' ELSE '' END WHEN 1 THEN 'توضيح ' || CAST(o_orderkey AS STRING) ELSE '' END AS text FROM orders)"""
_TITLED = _BLOCKS + """,
latest AS (SELECT *, last_value(CASE WHEN heads THEN code END IGNORE NULLS) OVER w AS title_code, last_value(CASE WHEN heads THEN text END IGNORE NULLS) OVER w AS title FROM blocks WINDOW w AS (PARTITION BY doc ORDER BY block_no)),
grouped AS (SELECT *, sum(CASE WHEN ifnull(title_code, -1) <> ifnull(before, -1) THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY block_no)::BIGINT AS g FROM (SELECT *, lag(title_code) OVER (PARTITION BY doc ORDER BY block_no) AS before FROM latest))"""


def _blocks(spark, sf_dir) -> DataFrame:
    return adapted(spark, sf_dir, _BLOCKS, "blocks").select("doc", "block_no", "kind", "text")


def _blocks_query(sql: str):
    def put(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, f"WITH {_TITLED}{sql}"
        return f

    return put


@_blocks_query(" SELECT doc, block_no, title, g AS \"group\", row_number() OVER (PARTITION BY doc, g ORDER BY block_no) - 1 AS part FROM grouped WHERE kind = 'table'")
def T6_titled_blocks(spark, sf_dir):
    """Titles with continuation marks, and parts that start again under a new title."""
    return structure.attach_titles(_blocks(spark, sf_dir)).filter("kind = 'table'").select("doc", "block_no", "title", "group", "part")


@_blocks_query(", n AS (SELECT doc, g, string_agg(text, '|' ORDER BY block_no) AS notes FROM grouped WHERE says GROUP BY ALL) SELECT doc, block_no, notes FROM grouped LEFT JOIN n USING (doc, g) WHERE kind = 'table'")
def T7_notes(spark, sf_dir):
    """The notes under a title belong to each of its parts."""
    notes = F.array_join("notes", "|")
    return structure.attach_notes(structure.attach_titles(_blocks(spark, sf_dir))).select("doc", "block_no", F.when(notes != "", notes).alias("notes"))


@query(None)
def T10_segments(spark, sf_dir):
    """Segments where the numbering of a book's tables restarts."""
    s = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select((F.col("s_nationkey") % 3).alias("doc"), s.alias("seq"), (s * 7 % 11).cast("int").alias("no"), (s % 3 == 0).cast("int").alias("part"), F.concat(F.lit("title "), s % 40).alias("title"), (s % 5 < 3).alias("in_domain"))
    return structure.segments(rows).select("doc", "seq", "no", "part", "title", "segment")


ORACLES["T10_segments"] = """
WITH q AS (SELECT s_nationkey % 3 AS doc, s_suppkey AS seq, (s_suppkey * 7 % 11)::INT AS no, (s_suppkey % 3 = 0)::INT AS part, 'title ' || (s_suppkey % 40)::VARCHAR AS title, s_suppkey % 5 < 3 AS in_domain FROM supplier),
l AS (SELECT *, ifnull(lag(no) OVER w, 1000000) AS prev, row_number() OVER w AS i FROM q WINDOW w AS (PARTITION BY doc ORDER BY seq)),
f AS (SELECT *, i > 1 AND part = 0 AND no < prev AND (no <= 2 OR no + 5 < prev) AS restart FROM l),
s AS (SELECT *, (count(*) FILTER (restart) OVER (PARTITION BY doc ORDER BY seq))::BIGINT AS segment FROM f),
good AS (SELECT doc, segment FROM s GROUP BY ALL HAVING count(DISTINCT title) FILTER (in_domain) >= greatest(3, 0.4 * count(DISTINCT title)))
SELECT doc, seq, no, part, title, segment FROM s JOIN good USING (doc, segment)"""


@query(r""" SELECT doc, n_lines, n_values FROM (SELECT doc_id AS doc, len(l)::BIGINT AS n_lines, list_sum([len(list_filter(string_split(x, ' '), lambda y: regexp_full_match(y, '[0-9][0-9,./]*|[-…×]+'))) for x in l])::BIGINT AS n_values
FROM (SELECT doc_id, [trim(regexp_replace(regexp_replace(x, '\([0-9]+\)', ' ', 'g'), '\s+', ' ', 'g')) for x in string_split(text, chr(10))] AS l FROM documents WHERE text IS NOT NULL))""")
def T15_text_lines(spark, sf_dir):
    """Lines of text as label and numbers: how many numbers each document's lines print."""
    rows = table(spark, sf_dir, "documents").filter("text IS NOT NULL").select(F.col("doc_id").alias("doc"), F.explode(F.split("text", "\n")).alias("line"))
    rows = rows.select("doc", F.size(structure.text_line(F.regexp_replace("line", r"\s+", " "))["values"]).alias("k"))
    return rows.groupBy("doc").agg(F.count("*").alias("n_lines"), F.sum("k").alias("n_values"))


@query(""" SELECT doc_id, contains(head, 'the') AND NOT regexp_matches(head, '[0-9]{4}') AS is_page FROM (SELECT doc_id, array_to_string(string_split(text, chr(10))[1:3], chr(10)) AS head FROM documents WHERE text IS NOT NULL)""")
def T16_domain_pages(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", structure.is_domain_page(F.col("text"), "the", "[0-9]{4}").alias("is_page"))


@query(""" SELECT doc, year, file FROM (SELECT s_nationkey AS doc, (s_suppkey % 6 + 1390)::INT AS year, s_name || CASE s_suppkey % 4 WHEN 0 THEN '.docx' WHEN 1 THEN '.html' WHEN 2 THEN '.pdf' ELSE '.zip' END AS file, s_suppkey % 4 AS k FROM supplier)
WHERE k < 3 AND year BETWEEN 1391 AND 1394 QUALIFY row_number() OVER (PARTITION BY doc, year ORDER BY k, file) = 1""")
def S13_select_units(spark, sf_dir):
    """One source per unit and year by the precedence of its kind; archives are no sources."""
    s = F.col("s_suppkey")
    name = F.concat("s_name", F.element_at(F.array(F.lit(".docx"), F.lit(".html"), F.lit(".pdf"), F.lit(".zip")), (s % 4 + 1).cast("int")))
    files = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("doc"), (s % 6 + 1390).cast("int").alias("year"), name.alias("file"))
    rank = F.array_position(F.array(F.lit("docx"), F.lit("html"), F.lit("pdf")), labels.file_ext(F.col("file")))
    files = files.filter(~labels.is_archive(F.col("file")) & labels.in_years(F.col("year"), "1391-1393,1394"))
    return files.groupBy("doc", "year").agg(F.min_by("file", F.struct(rank, F.col("file"))).alias("file"))


def _free(f):
    """A query that SQL can't express; tests compare its operator with brute force."""
    QUERIES[f.__name__] = f
    return f


@_free
def T17_lines_to_tables(spark, sf_dir):
    """Conversations as lines of a book: what users say are titles, what assistants say are lines."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), "turn", "role", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "line"))
    head = (F.col("role") == "user") & (F.col("i") == 0)
    said = F.when(head, F.concat(F.lit("7-"), F.col("turn") % 90, F.lit("- "), F.col("line"))).otherwise(F.concat(F.col("line"), F.lit(" "), F.length("line"), F.lit(" "), F.col("turn")))
    return lines.modal_rows(lines.lines_to_tables(rows.select("doc", F.struct("turn", "i").alias("n"), said.alias("text"))), ["doc", "title", "part"])


@_free
def T19_template_headers(spark, sf_dir):
    """Parts as tables, brands as templates: as many columns, a like title, and year cells that agree."""
    p = table(spark, sf_dir, "part")
    cell = F.array(*[F.struct(F.lit(1390 + i).alias("year"), F.lit(i).alias("pos"), (F.col("p_size") * (i + 1)).cast("double").alias("value")) for i in range(3)])
    tables = p.select(F.col("p_partkey").alias("t"), labels.title_key(F.col("p_name")).alias("key"), (F.col("p_size") % 2).alias("part"), (F.col("p_size") % 4).alias("ncols"), cell.alias("cells"))
    templates = p.groupBy("p_name", "p_size").agg(F.min("p_partkey").alias("template"))
    templates = templates.filter("p_size % 5 = 0").select("template", labels.title_key(F.col("p_name")).alias("key"), (F.col("p_size") % 2).alias("part"), (F.col("p_size") % 4).alias("ncols"), cell.alias("cells"))
    return lines.match_template(tables, templates)


@query(" SELECT t AS unit, CASE WHEN subject = 2 THEN 0 ELSE len(string_split(notes, '¶')) END AS n_rows, CASE WHEN subject = 2 THEN 'ValueError: no such table' END AS error FROM tables")
def T14_unit_log(spark, sf_dir):
    """What was made of each unit, and what went wrong with the others."""

    def parse(row: dict) -> list:
        if row["subject"] == 2:
            raise ValueError("no such table")
        return row["notes"].split("¶")

    return lines.unit_log(_of(spark, sf_dir, "tables").select(F.col("t").alias("unit"), "subject", "notes"), parse)


@_free
def G6_budgeted_rings(spark, sf_dir):
    """Rings of vectors at the smallest of eight tolerances that keeps their paths below a budget."""
    v = table(spark, sf_dir, "embeddings").select((F.col("label") % 3).alias("feature"), F.col("label").alias("poly"), F.lit(0).alias("ring"), F.col("vec_id").alias("i"), (F.get("embedding", F.lit(0)) * 100).cast("double").alias("x"), (F.get("embedding", F.lit(1)) * 100).cast("double").alias("y"))
    simple = written(rings.simplify(v, [0.25 * 1.5**k for k in range(8)]), "rings")
    return rings.within_budget(simple, 400_000)
