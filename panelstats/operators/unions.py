"""Exact unions of sets of ids as mergeable bitmaps.

A set is a row of bits, a whole number, for each block of 64 ids that it touches; several sets of a unit stand side by side. The sets of the smallest
units are built once, by runs of ids, so that a task holds the blocks of its runs alone; those of any groups of units are their bits or-ed, block by block.
Bits are or-ed in hash tables: no rows are sorted for them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelstats.operators import ordered

#: Bits of the numbers in a block, and in a run of numbers that goes to one task.
_BLOCK, _RUN = 6, 12
#: Parameter: distinct ids that a task numbers the rows of, so that its memory does not grow with the table.
IDS = 250_000


def numbered(rows: DataFrame, id: str) -> DataFrame:
    """Adds ``number``, the dense rank of the id over all rows (from 0, nulls none): ids that are no numbers or lie far apart would waste bits. Distinct ids are
    dealt by ranges; the ranges' sizes, one row each, give every id its place; rows meet them in as many tasks as the ids need."""
    ids = ordered.ranged(rows.select(F.col(id).alias("_id")).filter("_id IS NOT NULL").distinct(), [], "_id")
    spark, before, offsets = rows.sparkSession, 0, []
    for r in ids.groupBy("_part").count().orderBy("_part").collect():
        offsets.append((r["_part"], before))
        before += r["count"]
    starts = spark.createDataFrame(offsets, "_part int, _start long")
    places = ids.join(F.broadcast(starts), "_part").select("_id", (F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias("number"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-before // IDS))
    return rows.drop("number").repartition(tasks, id).join(places.repartition(tasks, "_id"), F.col(id) == F.col("_id"), "left").drop("_id")


def bitmaps(rows: DataFrame, unit: list[str], number: str, sets: dict[str, Column] | None = None) -> DataFrame:
    """(unit, block, bits) of the whole numbers of each unit, nulls aside; or a column of bits for each of ``sets``, of the rows where it holds."""
    n = F.col(number).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), n.bitwiseAND((1 << _BLOCK) - 1).cast("int"))
    own = {name: F.when(holds, bit).otherwise(0) for name, holds in sets.items()} if sets else {"bits": bit}
    rows = rows.filter(n.isNotNull()).select(*unit, F.shiftright(n, _RUN).alias("_run"), F.shiftright(n, _BLOCK).alias("block"), *[e.alias(name) for name, e in own.items()])
    return rows.repartition("_run").groupBy(*unit, "_run", "block").agg(*[F.bit_or(name).alias(name) for name in own]).drop("_run")


def merged(maps: DataFrame, unit: dict[str, Column], sets: Iterable[str] = ("bits",)) -> DataFrame:
    """The same sets by coarser units, given as columns of the finer ones' rows."""
    return maps.select(*[e.alias(c) for c, e in unit.items()], "block", *sets).groupBy(*unit, "block").agg(*[F.bit_or(name).alias(name) for name in sets])


def sizes(maps: DataFrame, unit: list[str], name: str = "n", sets: Iterable[str] | None = None) -> DataFrame:
    """(unit, name) of ``bits``, or the sizes of ``sets`` by their names."""
    return maps.groupBy(*unit).agg(*[F.sum(F.bit_count(bits).cast("long")).alias(to) for to, bits in ([(s, s) for s in sets] if sets else [(name, "bits")])])
