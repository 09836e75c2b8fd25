"""Readers and writers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables of a data directory, by name; any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which driver and executors share. Where it is unset: a new temporary
    folder on one machine, an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, for frames that a plan uses more than once. It goes with the session."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(where)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_outputs(outputs: dict[str, DataFrame], folder: str, by: str = "yearbook") -> None:
    """Each frame as Parquet below ``folder``, those with the release's column in a folder for each release."""
    for name, df in outputs.items():
        (df.write.partitionBy(by) if by in df.columns else df.write).parquet(f"{folder}/{name}")


def read_facts(spark: SparkSession, folder: str, schema: str, columns: list[str] | None = None, name: str = "facts") -> DataFrame:
    """A pipeline output by its declared schema (no inference, no surprise), with the columns asked for, in order."""
    rows = spark.read.schema(schema).parquet(f"{folder}/{name}")
    return rows.select(*(columns or rows.columns))


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV file with a header: text columns, or those of a schema."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_rankings(spark: SparkSession, path: str, numbers: list[str], lists: list[str]) -> DataFrame:
    """A ranking file: semicolons between columns, decimal commas in ``numbers``, quoted comma lists in ``lists``; marks of
    byte order before the first name fall away."""
    rows = spark.read.option("header", True).option("sep", ";").option("escape", '"').csv(path)
    rows = rows.toDF(*[c.lstrip("﻿").strip() for c in rows.columns])
    rows = rows.withColumns({c: F.replace(F.col(c), F.lit(","), F.lit(".")).try_cast("double") for c in numbers})
    return rows.withColumns({c: F.filter(F.transform(F.split(c, ","), lambda x: F.btrim(x)), lambda x: x != "") for c in lists})


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One object a line; null fields are left out."""
    df.write.json(path)


def read_series(spark: SparkSession, path: str, schema: str, verified_only: bool = True) -> DataFrame:
    """A side series with a ``verified`` column; what is not verified is never a measurement."""
    rows = read_csv(spark, path, schema)
    return rows.filter("verified") if verified_only else rows


def register_all(spark: SparkSession, tables: dict[str, DataFrame], views: dict[str, str] | None = None) -> None:
    """Temporary views of the frames, then the derived views in order; repeating it replaces them."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    register_views(spark, views or {})


def register_views(spark: SparkSession, views: dict[str, str]) -> None:
    for name, text in views.items():
        spark.sql(text).createOrReplaceTempView(name)


#: Pages whose cells stand in a worker's memory at once.
PAGES_AT_ONCE = 64


def html_tables(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """(key, table_no, r, c, text) of all cells of the tables in pages, spans filled in, each cell with the innermost table
    that it stands in. Pages may be bytes, which are read by the charset that they name, else as UTF-8, else as ``html.FALLBACK``. One
    pass, a page at a time."""
    from panelstats.sources.html import cells, decoded

    kind = dict(pages.dtypes)[key]

    def run(batches):
        import pyarrow as pa

        types = None
        for batch in batches:
            types = types or pa.schema([pa.field(key, batch.schema.field(key).type), *[pa.field(c, pa.int32()) for c in ("table_no", "r", "c")], pa.field("text", pa.string())])
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                few = batch.slice(at, PAGES_AT_ONCE)
                rows = [(k, *cell) for k, page in zip(few.column(key).to_pylist(), few.column(html).to_pylist()) for cell in cells(decoded(page))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(values, f.type) for values, f in zip(zip(*rows), types)], schema=types)

    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, table_no int, r int, c int, text string")


def html_options(pages: DataFrame, html: str = "html", key: str = "page_id", stop_word: str = "") -> DataFrame:
    """(key, value, name, count) of the options of lists in pages: "name (count)" is cut, a stop word at the end of the name
    goes, and placeholders (no value, or only digits as text) are skipped."""
    option = F.explode(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'(?s)<option[^>]*value="([^"]*)"[^>]*>(.*?)</option>'), F.lit(0))).alias("o")
    rows = pages.select(key, option).select(key, F.regexp_extract("o", r'value="([^"]*)"', 1).alias("value"), F.btrim(F.regexp_extract("o", r"(?s)>(.*?)</option>", 1)).alias("t"))
    name = F.btrim(F.regexp_replace("t", r"\s*\([0-9]+\)\s*$", ""))
    if stop_word:
        name = F.btrim(F.regexp_replace(name, rf"\s*{stop_word}$", ""))
    rows = rows.select(key, "value", name.alias("name"), F.nullif(F.regexp_extract("t", r"\(([0-9]+)\)\s*$", 1), F.lit("")).cast("int").alias("count"), "t")
    return rows.filter((F.col("value") != "") & ~F.col("t").rlike(r"^[0-9]*$")).drop("t")


def table_rows(cells: DataFrame, key: str = "page_id", extra: DataFrame | None = None) -> DataFrame:
    """(key, table_no, r, row: map from column name to text) of the rows below the header of ``html_tables`` cells: names are
    cut at a bracket and lower-cased, the last column goes; ``extra`` rows of the same form are appended."""
    from pyspark.sql import Window

    w = Window.partitionBy(key, "table_no")
    rows = cells.withColumn("_last", F.max("c").over(w)).filter("c < _last")
    names = F.max(F.when(F.col("r") == 0, F.btrim(F.lower(F.substring_index("text", "(", 1))))).over(Window.partitionBy(key, "table_no", "c"))
    rows = rows.withColumn("name", names).filter("r > 0").groupBy(key, "table_no", "r").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "text")))).alias("row"))
    return rows.unionByName(extra) if extra is not None else rows


def rank_cells(cells: DataFrame, html: str = "html") -> DataFrame:
    """Adds name, score and ranks (a map from the marked cell's id to its number) out of fragments: tags go, entities are
    read, and cells are told by their id."""
    plain = lambda c: F.btrim(F.replace(F.replace(F.replace(F.regexp_replace(c, "<[^>]+>", ""), F.lit("&amp;"), F.lit("&")), F.lit("&#39;"), F.lit("'")), F.lit("&nbsp;"), F.lit(" ")))
    ids = F.regexp_extract_all(html, F.lit(r'id="rank_([a-z]+)"[^>]*>\s*([0-9]+)'), F.lit(1))
    ranks = F.regexp_extract_all(html, F.lit(r'id="rank_([a-z]+)"[^>]*>\s*([0-9]+)'), F.lit(2))
    return cells.withColumns({
        "name": plain(F.regexp_extract(html, r'(?s)class="name"[^>]*>(.*?)</td>', 1)), "score": F.regexp_extract(html, r'class="score"[^>]*>\s*([0-9.]+)', 1).try_cast("double"),
        "ranks": F.map_from_entries(F.arrays_zip(ids.alias("id"), F.transform(ranks, lambda x: x.cast("int")).alias("rank")))})
