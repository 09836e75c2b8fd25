"""The generic operators from which the panels are put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def safe_ratio(n: Column | str, d: Column | str) -> Column:
    """n / d, null where either is null or d is 0."""
    n, d = (F.col(x) if isinstance(x, str) else x for x in (n, d))
    return F.try_divide(n, d)


#: What the clean facts of either domain cover.
TOTALS = {"area": "total", "branch": "all", "sector": "all"}


def clean(facts: DataFrame, catalogue: DataFrame, first_release: int) -> DataFrame:
    """Facts whose row and column are understood, of tables that did not fail, from a release on, for the total of
    every side dimension they have. A table without a status is left out."""
    good = catalogue.filter("check_status <> 'failed'").select("source_file", "source_table").distinct()
    rows = facts.filter(F.col("row_category").isNull() & F.col("col_category").isNull() & (F.col("yearbook") >= first_release))
    for c in facts.columns:
        if c in TOTALS:
            rows = rows.filter(F.col(c) == TOTALS[c])
    return rows.join(good, ["source_file", "source_table"], "left_semi")


def best_value(facts: DataFrame, keys: list[str], value: str = "value", event: str = "year", release: str = "yearbook") -> DataFrame:
    """One row per key out of many releases: that of the event's own year; else the value that most releases print;
    else the closest release, headers of the document's own, the table's and the file's name. Agreement is counted
    before releases older than the event go. One shuffle, by key, serves both windows."""
    spread = facts.repartition(*keys)
    agree = spread.withColumn("n_agree", F.count("*").over(Window.partitionBy(*keys, value)))
    order = [(F.col(release) != F.col(event)).cast("int"), F.col("n_agree").desc(), F.abs(F.col(release) - F.col(event)), (F.col("header_source") != "document").cast("int"), F.col("source_table"), F.col("source_file")]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return agree.filter(F.col(release) >= F.col(event)).withColumn("rn", first).filter("rn = 1").drop("rn")


def wide(facts: DataFrame, keys: list[str], columns: dict[str, Column], *more: Column, value: str = "value") -> DataFrame:
    """A pivot with fixed columns: for each the largest value of the rows that meet its condition."""
    return facts.groupBy(*keys).agg(*[F.max(F.when(c, F.col(value))).alias(n) for n, c in columns.items()], *more)


def quality_gate(rows: DataFrame, ratio: str, group: list[str], low: float, high: float, counted: Column, exempt: Column, least: int = 2, first: list[tuple[Column, str]] = ()) -> DataFrame:
    """Withholds implausible ratios, and a whole group with ``least`` implausible members among the counted, but
    for exempt rows. Keeps the ratio as ``<ratio>_raw`` and says why in ``status``; the reasons in ``first`` come before."""
    raw = F.col(f"{ratio}_raw")
    implausible = F.coalesce((raw > high) | (raw < low), F.lit(False))
    rows = rows.withColumn("_bad", implausible).withColumn("_n", F.sum((F.col("_bad") & counted).cast("int")).over(Window.partitionBy(*group)))
    status = F.when(F.lit(False), "")
    for condition, name in [*first, (F.col("_bad"), "implausible_rate"), (~exempt & (F.col("_n") >= least), "year_unreliable")]:
        status = status.when(condition, name)
    rows = rows.withColumn("status", status.otherwise("ok"))
    return rows.withColumn(ratio, F.when(F.col("status") == "ok", raw)).drop("_bad", "_n")


def share_gate(rows: DataFrame, group: list[str], value: str = "value", low: float = 0.97, high: float = 1.03) -> DataFrame:
    """Marks provinces whose sum matches the printed national row of their group (checks_ok 1)."""
    w = Window.partitionBy(*group)
    national = F.col("province") == "IRN"
    rows = rows.withColumn("national_value", F.max(F.when(national, F.col(value))).over(w)).withColumn("province_sum", F.sum(F.when(~national, F.col(value))).over(w))
    fits = F.coalesce(safe_ratio("province_sum", "national_value").between(low, high), F.lit(False))
    return rows.withColumn("checks_ok", F.when(national, 1).otherwise(fits.cast("int")))


def growth(panel: DataFrame, keys: list[str], measures: list[str], event: str = "year") -> DataFrame:
    """<measure>_growth against the row before, and gap_years."""
    w = Window.partitionBy(*keys).orderBy(event)
    out = panel.select("*", *[(safe_ratio(F.col(m), F.lag(m).over(w)) - 1).alias(f"{m}_growth") for m in measures])
    return out.withColumn("gap_years", F.col(event) - F.lag(event).over(w))


def carry_forward(rows: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """The last value that is not null, up to and with each row."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def year_ranges(rows: DataFrame, keys: list[str], year: str = "year") -> DataFrame:
    """Distinct years as text, such as 1380-1385,1390."""
    w = Window.partitionBy(*keys).orderBy(year)
    islands = rows.select(*keys, year).distinct().withColumn("_island", F.col(year) - F.row_number().over(w))
    runs = islands.groupBy(*keys, "_island").agg(F.min(year).alias("a"), F.max(year).alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", "a", "b"))
    return runs.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", text.alias("t")))), lambda s: s["t"]), ",").alias("years"))
