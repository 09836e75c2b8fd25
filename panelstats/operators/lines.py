"""Lines of text into tables, headers from templates, and a log of units."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelstats.functions import labels
from panelstats.operators import matching, ordered, structure
from panelstats.sources import written


def lines_to_tables(lines: DataFrame, doc: str = "doc", order: str = "n") -> DataFrame:
    """(doc, title, part, r, label, values, notes) out of ordered lines (doc, n, text). A title line starts a table; note lines
    belong to all parts of their title; a line of text alone is the label of a line of numbers that follows it; single
    numbers without a label are page numbers; a row that repeats label and numbers is skipped; a label that comes again
    with other numbers starts the next part (``parts``). No document is one task's: rows are dealt by ranges of lines, and
    what they take from the rows above is carried from range to range."""
    text = F.btrim(F.coalesce("text", F.lit("")))
    plain, said = F.col("_plain"), F.col("_said")
    own = F.when(F.col("text").rlike("[\u06f0-\u06f9\u0660-\u0669]"), labels.digits(F.col("text"))).otherwise(F.col("text"))
    title = labels.is_plain_title(plain)
    kind = F.when(title, "title").when(labels.is_numbered_note(plain), "note").when(F.size(said["values"]) > 0, "row").otherwise("text")
    rows = ordered.ranged(lines.select(doc, order, text.alias("text")).filter("text <> ''"), [doc], order, more=[{"_plain": own}, {"_said": structure.line_of(plain)}, {"_kind": kind}])
    rows = ordered.carried(rows, [doc], last={"title": F.when(F.col("_kind") == "title", F.col("text"))}, previous={"_above": F.struct("_kind", "text")}).filter("title IS NOT NULL")
    label, above = F.col("_said.label"), F.col("_above")
    rows = rows.withColumn("label", F.when((label == "") & (above["_kind"] == "text"), above["text"]).otherwise(label))
    rows = written(rows.filter("_kind IN ('row', 'note')").withColumn("values", F.transform("_said.values", lambda v: labels.to_number(v, False))).drop("_plain", "_said", "_above"), "lines")
    notes = rows.filter("_kind = 'note'").groupBy(doc, "title").agg(F.transform(F.array_sort(F.collect_list(F.struct(order, "text"))), lambda s: s["text"]).alias("notes"))
    numbers = rows.filter("_kind = 'row'").filter((F.col("label") != "") | (F.size("values") > 1)).select(doc, order, "title", "label", "values", "_at", "_part", "_wide")
    parted = ordered.carried(parts(numbers, [doc, "title"]), [doc, "title", "part"], total={"r": F.lit(1)}).withColumn("r", (F.col("r") - 1).cast("int"))
    return parted.join(notes, [doc, "title"], "left").select(doc, "title", "part", "r", "label", "values", F.coalesce("notes", F.array().cast("array<string>")).alias("notes"))


def parts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds to the rows of ``ordered.ranged`` with label and values the number of their ``part`` within the keys, and drops the rows that
    repeat one of their part: a label that its part has with other values starts the next part. A row conflicts with the last one above
    that has its label and other values; from a row that starts a part, the next part starts at the first row whose conflict is not above
    it, so each such row points to one below, and the pointers are followed from the first rows by doubling. A row without label
    neither conflicts nor repeats."""
    by_label = [*keys, "label"]
    rows = ordered.carried(rows, by_label, previous={"_same": F.struct("_at", "values")})
    changed = (F.col("label") != "") & F.col("_same").isNotNull() & ~F.col("values").eqNullSafe(F.col("_same.values"))
    rows = ordered.carried(rows, by_label, last={"_other": F.when(changed, F.col("_same._at"))})
    rows = written(rows, "rows")
    conflicts = rows.filter("_other IS NOT NULL").select(*keys, "_at", "_part", "_wide", "_other")
    # The first row that conflicts with a row or one below it: events stand at the place that is conflicted with. From a group's first row on it is its first conflict.
    firsts = conflicts.groupBy(*keys).agg(F.min("_at").alias("at"))
    places, events = conflicts.withColumn("_to", F.lit(None).cast("long")), conflicts.withColumns({"_to": F.col("_at"), "_at": F.col("_other"), "_part": ordered.part_of("_other")})
    hops = ordered.carried(places.unionByName(events).drop("_other"), keys, least_after={"next": F.col("_to")}).filter("_to IS NULL AND next IS NOT NULL").select(F.col("_at").alias("at"), "next")
    starts = ordered.chain(firsts, hops)
    rows = rows.join(starts.select(F.col("at").alias("_at"), F.lit(True).alias("_starts")), "_at", "left")
    rows = ordered.carried(rows, keys, last={"_from": F.when(F.col("_starts"), F.col("_at"))}, total={"part": F.coalesce("_starts", F.lit(False)).cast("int")}).withColumn("part", F.col("part").cast("int"))
    repeats = (F.col("label") != "") & F.col("_same").isNotNull() & F.coalesce(F.col("_same._at") >= F.col("_from"), F.lit(True))
    return rows.filter(~repeats).drop("_same", "_other", "_starts", "_from")


def modal_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose number of values is the most common of their table (the smaller on ties), with ``dropped``, how many others there were."""
    w = Window.partitionBy(*keys)
    widths = rows.withColumn("_k", F.size("values")).withColumn("_n", F.count("*").over(Window.partitionBy(*keys, "_k")))
    widths = widths.withColumn("_best", F.max(F.struct("_n", -F.col("_k"))).over(w)).withColumn("_all", F.count("*").over(w))
    return widths.filter(F.struct("_n", -F.col("_k")) == F.col("_best")).withColumn("dropped", F.col("_all") - F.col("_n")).drop("_k", "_n", "_best", "_all")


def match_template(tables: DataFrame, templates: DataFrame, least: float = 0.6, cutoff: float = 0.72) -> DataFrame:
    """(t, template, score) of tables (t, key, part, ncols, cells: (year, pos, value)) and templates (template, key, part, ncols,
    cells): of those with as many columns and a title at least ``least`` alike the best by likeness, 0.05 for the same part,
    and twice the share of the year cells of both that agree; from ``cutoff`` on, the smaller template on ties.

    Titles are compared once for each pair of distinct ones that can be alike enough. What a table scores without its cells is known for all
    tables of one title, part and width, from one template (the smallest) of each title, part and width; pairs of single tables and templates are
    formed by a year cell that agrees alone."""
    tables, templates = written(tables, "tables"), written(templates, "templates")
    alike = written(matching.alike(tables.select(F.col("key").alias("name")), templates.select(F.col("key").alias("name")), least), "alike")
    alike = alike.select(F.col("a").alias("key"), F.col("b").alias("_key"), F.col("ratio").alias("_sim"))
    right = templates.select("template", F.col("key").alias("_key"), F.col("part").alias("_part"), "ncols", F.col("cells").alias("_cells"))
    said = F.col("_sim") + F.when(F.col("part") == F.col("_part"), 0.05).otherwise(0.0)
    best = lambda: F.min_by(F.struct("template", "score"), F.struct(-F.col("score"), F.col("template"))).alias("b")

    kinds = tables.select("key", "part", "ncols").distinct().join(alike, "key").join(right.groupBy("_key", "_part", "ncols").agg(F.min("template").alias("template")), ["_key", "ncols"])
    kinds = kinds.withColumn("score", said).groupBy("key", "part", "ncols").agg(best())
    by_kind = tables.select("t", "key", F.col("part").alias("_p"), "ncols").join(kinds, ["key", "ncols"]).filter(F.col("_p").eqNullSafe(F.col("part"))).select("t", "b.*")

    at = lambda v: F.floor(2 * v).cast("long")  # noqa: E731  values less than a half apart are in one half or two that touch
    mine = tables.select("t", "key", "part", "ncols", F.inline("cells")).filter("value IS NOT NULL").join(alike, "key")
    theirs = right.select("template", "_key", "_part", "ncols", F.inline("_cells")).withColumnRenamed("value", "_v").filter("_v IS NOT NULL")
    on = ["_key", "ncols", "year", "pos"]
    halves = theirs.withColumn("_half", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: at(F.col("_v")) + d)))
    agreeing = mine.withColumn("_half", at(F.col("value"))).join(halves, [*on, "_half"]).filter(F.abs(F.col("value") - F.col("_v")) < 0.5).select("t", "template").distinct()
    # Of those pairs all cells that both have.
    cells = agreeing.join(mine, "t").join(theirs, ["template", *on]).withColumn("_same", (F.abs(F.col("value") - F.col("_v")) < 0.5).cast("double"))
    by_cells = cells.groupBy("t", "template").agg(F.max(said).alias("_said"), F.avg("_same").alias("_agree")).select("t", "template", (F.col("_said") + 2 * F.col("_agree")).alias("score"))
    return by_kind.unionByName(by_cells).groupBy("t").agg(best()).select("t", "b.*").filter(F.col("score") >= cutoff)


def unit_log(units: DataFrame, parse: Callable[[dict], list], key: str = "unit") -> DataFrame:
    """(unit, n_rows, error): what ``parse`` makes of each unit's row; an error is written down and the run goes on."""

    def run(frames):
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                try:
                    out.append((row[key], len(parse(row)), None))
                except Exception as error:  # any fault of a unit is that unit's entry
                    out.append((row[key], 0, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(out, columns=[key, "n_rows", "error"]).astype({"error": "object"})

    return units.mapInPandas(run, f"{key} {dict(units.dtypes)[key]}, n_rows long, error string")
