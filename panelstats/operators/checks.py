"""Arithmetic checks of printed tables. Each gives rows (check_name, source_file, source_table, detail, expected, actual, ok)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .panel import wide

_TABLE = ["source_file", "source_table"]


def within(actual: Column, expected: Column, of: Column, floor: float, share: float) -> Column:
    """|actual - expected| <= max(floor, share * |of|)."""
    return F.abs(actual - expected) <= F.greatest(F.lit(floor), F.abs(of) * share)


def _issues(rows: DataFrame, name: str, detail: Column, expected: str, actual: str, ok: Column) -> DataFrame:
    return rows.select(F.lit(name).alias("check_name"), *_TABLE, detail.alias("detail"), F.col(expected).cast("double").alias("expected"), F.col(actual).cast("double").alias("actual"), ok.alias("ok"))


def gender_sum(facts: DataFrame, keys: list[str]) -> DataFrame:
    g = F.col("gender")
    rows = wide(facts, [*_TABLE, *keys], {"total": g == "total", "male": g == "male", "female": g == "female"}).dropna(subset=["total", "male", "female"])
    rows = rows.withColumn("sum", F.col("male") + F.col("female"))
    return _issues(rows, "gender_sum", F.concat_ws(" ", "metric", "province"), "sum", "total", within(F.col("total"), F.col("sum"), F.col("total"), 2.0, 0.005))


def part_sum(rows: DataFrame, keys: list[str], whole: Column, parts: Column, least: int, floor: float, share: float, name: str, table: Column | None = None) -> DataFrame:
    """A table's printed total against the sum of at least ``least`` parts, in one aggregation; keys match null with
    null. ``table`` is what the issue names as the table."""
    sums = rows.groupBy(*_TABLE, *keys).agg(F.sum(F.when(parts, F.col("value"))).alias("sum"), F.count(F.when(parts, F.col("value"))).alias("n"), F.max(F.when(whole, F.col("value"))).alias("value"))
    both = sums.filter((F.col("n") >= least) & F.col("value").isNotNull())
    if table is not None:
        both = both.withColumn("source_table", table)
    return _issues(both, name, F.concat_ws(" ", "metric", "gender"), "sum", "value", within(F.col("value"), F.col("sum"), F.col("value"), floor, share))


def province_sum(facts: DataFrame, keys: list[str]) -> DataFrame:
    """The national row against the sum of at least 20 provinces."""
    national = F.col("province") == "IRN"
    return part_sum(facts, keys, national, ~national, 20, 5.0, 0.01, "province_sum")


def degree_sum(facts: DataFrame, propagate_parts: bool = False) -> DataFrame:
    """The total of all degrees against the sum of at least four. Tables are named without their part, so that the check
    concerns the table as a whole; with ``propagate_parts`` it counts for the part."""
    whole, table = F.col("degree") == "all", None if propagate_parts else F.substring_index("source_table", "#", 1)
    return part_sum(facts, ["year", "province", "university", "metric", "gender"], whole, ~whole, 4, 2.0, 0.005, "degree_sum", table)


def cross_publication(facts: DataFrame, keys: list[str], window: int = 3) -> DataFrame:
    """The first release's national value against the median of the next releases."""
    nation = facts.filter("province = 'IRN'")
    later = nation.filter((F.col("yearbook") > F.col("year")) & (F.col("yearbook") <= F.col("year") + window)).groupBy(*keys).agg(F.median("value").alias("later"))
    both = nation.filter("yearbook = year").join(later, keys)
    return _issues(both, "cross_publication", F.concat_ws(" ", "metric", "gender"), "later", "value", within(F.col("value"), F.col("later"), F.col("later"), 5.0, 0.05))


def province_shift(facts: DataFrame, keys: list[str], factor: float = 1.6, least_share: float = 0.005, most: int = 3) -> DataFrame:
    """Tables in which ``most`` or more provinces change their share of the total by ``factor`` within a year."""
    own = facts.filter("province <> 'IRN' AND yearbook = year AND gender = 'total'")
    own = own.withColumn("share", F.col("value") / F.sum("value").over(Window.partitionBy(*_TABLE, *keys)))
    before = own.groupBy((F.col("year") + 1).alias("year"), "province", *keys).agg(F.median("share").alias("prev"))
    both = own.join(before, ["year", "province", *keys]).filter((F.col("share") > 0) & (F.col("prev") > least_share))
    moved = (F.col("share") / F.col("prev") > factor) | (F.col("prev") / F.col("share") > factor)
    tables = both.groupBy(*_TABLE).agg(F.sum(moved.cast("int")).alias("n_bad")).withColumn("none", F.lit(None).cast("double"))
    return _issues(tables, "province_shift", F.lit("shares"), "none", "n_bad", F.col("n_bad") < most)


def revisions(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that releases print differently."""
    g = facts.groupBy(*keys).agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("value").alias("n"))
    return g.filter((F.col("n") > 1) & (F.col("high") - F.col("low") > F.abs("high") * 0.01 + 2))


def yearly_jumps(best: DataFrame, keys: list[str], share: float = 0.3) -> DataFrame:
    """Changes by more than ``share`` between consecutive years."""
    w = Window.partitionBy(*keys).orderBy("year")
    rows = best.withColumn("before", F.lag("value").over(w)).withColumn("gap", F.col("year") - F.lag("year").over(w))
    return rows.filter((F.col("gap") == 1) & (F.col("before") > 0) & (F.abs(F.col("value") / F.col("before") - 1) > share))


def table_status(checks: DataFrame) -> DataFrame:
    """(source_file, source_table, n_checks, pass_rate, check_status): failed below 0.8, or when a check against
    other tables fails."""
    across = F.col("check_name").isin("cross_publication", "province_shift")
    rows = checks.groupBy(*_TABLE).agg(F.count("*").alias("n_checks"), F.avg(F.col("ok").cast("double")).alias("pass_rate"), F.min(F.when(across, F.col("ok").cast("double"))).alias("across"))
    return rows.select(*_TABLE, "n_checks", "pass_rate", F.when((F.col("pass_rate") < 0.8) | (F.coalesce("across", F.lit(1.0)) < 0.5), "failed").otherwise("passed").alias("check_status"))
