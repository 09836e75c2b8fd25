"""Grids of printed cells (table, r, c, x) into header paths and body rows, and ordered blocks into titled tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelstats.functions import labels
from panelstats.operators import ordered

#: Fixed value: the words that mark a continuation of a table.
CONTINUED = "دنباله"


def clean_grid(cells: DataFrame, t: str = "t", edges: bool = False) -> DataFrame:
    """Blank rows go, then grids with fewer than two rows or columns. One shuffle, by table. With ``edges`` the first and last columns of
    the grid stay, as _first and _last."""
    row, grid = Window.partitionBy(t, "r"), Window.partitionBy(t)
    some = cells.repartition(t).withColumn("_ink", F.max(F.btrim(F.coalesce("x", F.lit(""))) != "").over(row)).filter("_ink").drop("_ink")
    some = some.select("*", (F.max("r").over(grid) > F.min("r").over(grid)).alias("_tall"), F.min("c").over(grid).alias("_first"), F.max("c").over(grid).alias("_last"))
    return some.filter("_tall AND _last > _first").drop("_tall", *([] if edges else ["_first", "_last"]))


def laid_out(cells: DataFrame, t: str = "t", slash_swapped: bool = True) -> DataFrame:
    """Adds to every cell its number, the table's label column (the first or last column, whichever has more text; the
    first on ties) and its header depth (the first row in which half of the printed data cells are numbers). Tables
    without such a row go. Cells of ``clean_grid`` are not shuffled again; those with its edges are passed over twice, for each of both columns as
    the label's: by row for the shares of numbers, by table for the rest."""
    grid, row = Window.partitionBy(t), Window.partitionBy(t, "r")
    if "_first" not in cells.columns:
        cells = cells.withColumns({"_first": F.min("c").over(grid), "_last": F.max("c").over(grid)})
    out = cells.withColumn("x", F.btrim(F.coalesce("x", F.lit("")))).withColumn("_d", labels.digits(F.col("x")))
    out = out.withColumn("number", labels.number_of(F.col("_d"), slash_swapped)).drop("_d")
    out = out.withColumn("_kind", F.when(F.col("x") != "", labels.is_numeric_cell(F.col("x"), F.col("number")).cast("tinyint")))
    share = lambda at: F.avg(F.when(F.col("c") != F.col(at), F.col("_kind"))).over(row)
    out = out.withColumns({"_by_first": share("_first") >= 0.5, "_by_last": share("_last") >= 0.5})
    wordy = (F.col("x") != "") & F.col("number").isNull()
    text = lambda at: F.count_if(wordy & (F.col("c") == F.col(at))).over(grid)
    depth = lambda by: F.min(F.when(F.col(by), F.col("r"))).over(grid)
    out = out.withColumns({"_left": text("_first") >= text("_last"), "_dl": depth("_by_first"), "_dr": depth("_by_last")})
    pick = lambda left, right: F.when(F.col("_left"), F.col(left)).otherwise(F.col(right))
    out = out.withColumns({"label_c": pick("_first", "_last"), "depth": pick("_dl", "_dr")})
    return out.filter("depth IS NOT NULL").drop("_first", "_last", "_kind", "_by_first", "_by_last", "_left", "_dl", "_dr")


def header_paths(cells: DataFrame, t: str = "t") -> DataFrame:
    """(t, c, path) of the data columns of ``laid_out`` cells: the header parts from top to bottom, consecutive parts that
    ``norm`` makes equal once."""
    rows = cells.filter((F.col("c") != F.col("label_c")) & (F.col("r") < F.col("depth")) & (F.col("x") != ""))
    before = F.lag(labels.norm(F.col("x"))).over(Window.partitionBy(t, "c").orderBy("r"))
    rows = rows.withColumn("_b", before).filter(F.col("_b").isNull() | (F.col("_b") != labels.norm(F.col("x"))))
    return rows.groupBy(t, "c").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "x"))), lambda s: s["x"]), " > ").alias("path"))


def body_rows(cells: DataFrame, t: str = "t") -> DataFrame:
    """(t, r, label, values) of the rows below the header: ``values`` are (c, number) in order; rows with neither label
    nor number go."""
    rows = cells.filter(F.col("r") >= F.col("depth")).groupBy(t, "r").agg(
        F.max(F.when(F.col("c") == F.col("label_c"), F.col("x"))).alias("label"), F.array_sort(F.collect_list(F.when(F.col("c") != F.col("label_c"), F.struct("c", "number")))).alias("values"))
    return rows.filter((F.coalesce("label", F.lit("")) != "") | F.exists("values", lambda v: v["number"].isNotNull()))


def body_cells(cells: DataFrame, t: str = "t") -> DataFrame:
    """The data cells (t, r, label, c, number) of ``body_rows``, without making arrays of them and without another shuffle or sort."""
    row, data = Window.partitionBy(t, "r"), F.col("c") != F.col("label_c")
    rows = cells.filter(F.col("r") >= F.col("depth")).withColumns({"label": F.max(F.when(~data, F.col("x"))).over(row), "_some": F.max(data & F.col("number").isNotNull()).over(row)})
    return rows.filter(data & ((F.coalesce("label", F.lit("")) != "") | F.col("_some"))).select(t, "r", "label", "c", "number")


def by_row(cells: DataFrame, t: str = "t") -> DataFrame:
    """(t, r, label_c, depth, cells: (c, x, number)) of ``laid_out`` cells, which are not shuffled again: a frame to write, of which
    ``header_paths`` (after ``header_cells``) and ``body_of`` take what they need row by row."""
    return cells.groupBy(t, "r").agg(F.max("label_c").alias("label_c"), F.max("depth").alias("depth"), F.collect_list(F.struct("c", "x", "number")).alias("cells"))


def header_cells(rows: DataFrame, t: str = "t") -> DataFrame:
    """The ``laid_out`` cells above the body, out of ``by_row``."""
    return rows.filter(F.col("r") < F.col("depth")).select(t, "r", "label_c", "depth", F.inline("cells"))


def body_of(rows: DataFrame, t: str = "t") -> DataFrame:
    """``body_rows`` out of ``by_row``: no shuffle."""
    is_label = lambda s: s["c"] == F.col("label_c")
    label = F.array_max(F.transform(F.filter("cells", is_label), lambda s: s["x"]))
    values = F.array_sort(F.transform(F.filter("cells", lambda s: ~is_label(s)), lambda s: F.struct(s["c"].alias("c"), s["number"].alias("number"))))
    body = rows.filter(F.col("r") >= F.col("depth")).select(t, "r", label.alias("label"), values.alias("values"))
    return body.filter((F.coalesce("label", F.lit("")) != "") | F.exists("values", lambda v: v["number"].isNotNull()))


def _base(title: Column) -> Column:
    return labels.norm(F.regexp_replace(title, rf"\(\s*{CONTINUED}\s*\)", ""))


def attach_titles(blocks: DataFrame, doc: str = "doc", order: str = "block_no") -> DataFrame:
    """Adds to ordered blocks (doc, block_no, kind 'para' or 'table', text) the latest title, the number of its group
    (titles that differ only by the mark of continuation are one) and for tables their part within the group. A document of any
    length is dealt by ranges of blocks."""
    is_title = (F.col("kind") == "para") & labels.is_title(F.col("text"))
    rows = ordered.carried(ordered.ranged(blocks, [doc], order), [doc], last={"title": F.when(is_title, F.btrim("text"))})
    rows = ordered.carried(rows.withColumn("_base", _base(F.coalesce("title", F.lit("")))), [doc], previous={"_above": F.col("_base")})
    rows = ordered.carried(rows, [doc], total={"group": (F.col("_base") != F.coalesce("_above", F.lit(""))).cast("int")})
    rows = ordered.carried(rows, [doc, "group"], total={"part": (F.col("kind") == "table").cast("int")})
    return rows.withColumn("part", F.when(F.col("kind") == "table", F.col("part") - 1)).drop("_base", "_above", "_at", "_part", "_wide")


def attach_notes(titled: DataFrame, doc: str = "doc", order: str = "block_no") -> DataFrame:
    """Tables of ``attach_titles`` with the notes of their group: every paragraph that is no title nor a mark of
    continuation, up to the next title, applies to all parts under it."""
    para = (F.col("kind") == "para") & ~labels.is_title(F.col("text")) & ~(F.col("text").contains(CONTINUED) & (F.length("text") < 40))
    notes = titled.groupBy(doc, "group").agg(F.transform(F.array_sort(F.collect_list(F.when(para, F.struct(order, F.btrim("text").alias("text"))))), lambda s: s["text"]).alias("notes"))
    return titled.filter("kind = 'table'").join(notes, [doc, "group"])


def table_year(row_years: Column, title: Column, release: Column, year: str = "1[34][0-9]{2}") -> Column:
    """The largest year of the rows; else of the years in the title the smaller of two that follow each other, or the
    largest; else the release's."""
    return F.coalesce(F.array_max(row_years), title_year(title, year), release)


def title_year(title: Column, year: str = "1[34][0-9]{2}") -> Column:
    """What a title says in ``table_year``."""
    found = F.transform(F.regexp_extract_all(labels.digits(title), F.lit(year), F.lit(0)), lambda y: y.cast("int"))
    pair = (F.size(found) > 1) & (F.array_max(found) - F.array_min(found) == 1)
    return F.when(pair, F.array_min(found)).otherwise(F.array_max(found))


def segments(tables: DataFrame, doc: str = "doc", order: str = "seq", least: int = 3, share: float = 0.4) -> DataFrame:
    """Tables (doc, seq, no, part, title, in_domain) of the segments that are mostly of the domain, with ``segment``: a new
    one starts where the numbering restarts (part 0, a smaller number that is at most 2 or drops by more than 5)."""
    w = Window.partitionBy(doc).orderBy(order)
    last = F.coalesce(F.last("no", True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(10**6))
    starts = F.col("no").isNotNull() & (F.col("no") < last) & (F.col("part") == 0) & ((F.col("no") <= 2) | (last - F.col("no") > 5))
    rows = tables.withColumn("_s", F.coalesce(starts, F.lit(False)).cast("int")).withColumn("_first", F.first("_s").over(w))
    rows = rows.withColumn("segment", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_first"))
    good = rows.groupBy(doc, "segment").agg(F.count_distinct("title").alias("_n"), F.count_distinct(F.when(F.col("in_domain"), F.col("title"))).alias("_k")).filter((F.col("_k") >= least) & (F.col("_k") >= share * F.col("_n")))
    return rows.drop("_s", "_first").join(good.select(doc, "segment"), [doc, "segment"], "left_semi")


def best_doc(tables: DataFrame, unit: str, doc: str = "doc") -> DataFrame:
    """(unit, doc) of the file with the most titles of the domain in each unit; the smaller name on ties."""
    counts = tables.groupBy(unit, doc).agg(F.count_distinct(F.when(F.col("in_domain"), F.col("title"))).alias("n"))
    return counts.groupBy(unit).agg(F.min_by(F.struct(doc, "n"), F.struct(-F.col("n"), F.col(doc))).alias("_b")).select(unit, "_b.*")


def geo_class(n_provinces: Column, has_years: Column) -> Column:
    return F.when(n_provinces >= 10, "province").when(has_years | (n_provinces == 0), "national").otherwise("some-provinces")


def text_line(line: Column) -> Column:
    """(label, values) of a line that prints its numbers from right to left: the numbers in reading order, and the rest
    as the label with its footnote marks behind it. Numbers in brackets are marks."""
    return line_of(labels.digits(line))


#: A word of a line that is a number or marks for missing ones; a sign that ends lines, but is no blank, may stand behind it.
_VALUE = r"(?<!\S)(?:[0-9][0-9,./]*|[-…×]+)[\x85\u2028\u2029]?(?!\S)"


def line_of(plain: Column) -> Column:
    """``text_line`` of a line whose digits are plain. It is passed over as a whole, not word by word, and only for what it holds."""
    marked = plain.contains("(")
    marks = F.when(marked, F.array_join(F.regexp_extract_all(plain, F.lit(r"\([0-9]+\)"), F.lit(0)), ""))
    bare = F.when(marked, F.regexp_replace(plain, r"\([0-9]+\)", " ")).otherwise(plain)
    words = F.btrim(F.regexp_replace(bare, _VALUE, ""))
    words = F.when(words.rlike(r"\s\s|[\t\n\x0b\f\r]"), F.btrim(F.regexp_replace(words, r"\s+", " "))).otherwise(words)
    values = F.transform(F.reverse(F.regexp_extract_all(bare, F.lit(_VALUE), F.lit(0))), lambda x: F.replace(x, F.lit(","), F.lit("")))
    return F.struct(F.btrim(F.concat_ws(" ", words, marks)).alias("label"), values.alias("values"))


def is_domain_page(text: Column, word: str, stop: str) -> Column:
    """The first three lines have the domain's word and no stop word."""
    head = F.array_join(F.slice(F.split(text, "\n"), 1, 3), "\n")
    return head.contains(word) & ~head.rlike(stop)
