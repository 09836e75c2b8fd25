"""Carrying values along ordered rows when one group may be larger than a task.

``ranged`` writes rows dealt by ranges of (keys, order), so that a long group lies in several parts of like size. ``carried`` works
on two levels: within a part by a window, and from part to part by a window over one summary row for each part that a group
touches. What a part takes from the others stands as a row of its own before or behind its rows, so that rows are shuffled once; groups that lie
in one part take nothing and are not summed up. Results are those of plain windows over the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelstats.sources import written

#: Low bits of a row's place that count within its part.
_BITS = 33


def part_of(at: str | Column) -> Column:
    """The part of a place."""
    return F.shiftright(at, _BITS).cast("int")


def ranged(rows: DataFrame, keys: list[str], order: str, parts: int | None = None, more: Sequence[dict[str, Column]] = ()) -> DataFrame:
    """``rows`` as a written table with ``_at``, a place that rises with (keys, order) and is unique, ``_part``, and ``_wide``: whether the first
    key's rows lie in several parts. ``more`` are columns, each step's out of those before, that are computed once, as rows are written."""
    by = [*keys, order]
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.drop("_at", "_part", "_wide").repartitionByRange(parts, *by).sortWithinPartitions(*by)
    numbered = reduce(DataFrame.withColumns, more, dealt.withColumn("_at", F.monotonically_increasing_id()))
    out = written(numbered, "ranged").withColumn("_part", part_of("_at"))
    return out.withColumn("_wide", _cut(out, keys[0]) if keys else F.lit(True))


def _cut(rows: DataFrame, key: str) -> Column:
    """Whether a row's key is in several parts. Such a key is the first or last one of each of its parts, so that there are fewer than parts."""
    k = F.struct(F.col(key).alias("k"))
    ends = rows.groupBy("_part").agg(F.min(k).alias("low"), F.max(k).alias("high")).select("_part", F.explode(F.array("low", "high")).alias("e")).distinct()
    cut = [r["k"] for r in ends.groupBy("e.k").count().filter("count > 1").collect()]
    return F.coalesce(F.col(key).isin([v for v in cut if v is not None]), F.lit(None in cut))


def carried(rows: DataFrame, keys: list[str], last: dict[str, Column] = {}, previous: dict[str, Column] = {}, total: dict[str, Column] = {}, least_after: dict[str, Column] = {}) -> DataFrame:
    """Adds to rows with ``_at``, ``_part`` and ``_wide``, for each group of keys (nulls are a group; the first is that of ``ranged``): the last value that
    is not null up to the row, the value of the row before, the running total, and the least value from the row on (rows with one place together)."""
    names = [*last, *previous, *total, *least_after]
    kept = [c for c in rows.columns if c not in names]
    own = last | {n: F.struct(e.alias("v")) for n, e in previous.items()} | {n: F.lit(0).cast("long") + e for n, e in total.items()} | least_after
    rows = rows.select(*kept, F.struct(*[e.alias(n) for n, e in own.items()]).alias("_new"))
    new = {n: F.col(f"_new.{n}") for n in names}

    blocks = rows.filter("_wide").groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p")).agg(
        *[F.max_by(new[n], F.when(new[n].isNotNull(), F.col("_at"))).alias(n) for n in last], *[F.max_by(new[n], "_at").alias(n) for n in previous],
        *[F.sum(new[n]).alias(n) for n in total], *[F.min(new[n]).alias(n) for n in least_after])
    outer = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_p")
    before, after = outer.rowsBetween(Window.unboundedPreceding, -1), outer.rowsBetween(1, Window.unboundedFollowing)
    types = rows.schema["_new"].dataType
    above = {n: F.last(n, True).over(before) for n in (*last, *previous)} | {n: F.sum(n).over(before) for n in total}
    every = rows.withColumn("_taken", F.lit(False))
    for taken, behind in ((above, 0), ({n: F.min(n).over(after) for n in least_after}, 1)):
        if taken:
            place = F.shiftleft(F.col("_p").cast("long") + behind, _BITS) - 1  # before the part's first row, or behind its last
            values = F.struct(*[(F.col(n) if n in taken else F.lit(None)).cast(types[n].dataType).alias(n) for n in names])
            met = blocks.select("_p", *[f"_k{i}" for i in range(len(keys))], *[e.alias(n) for n, e in taken.items()]).filter(" OR ".join(f"`{n}` IS NOT NULL" for n in taken))
            met = met.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], F.col("_p").alias("_part"), place.alias("_at"), F.lit(True).alias("_wide"), F.lit(True).alias("_taken"), values.alias("_new"))
            every = every.unionByName(met, True)
    inner = Window.partitionBy("_part", "_wide", *keys).orderBy("_at")
    upto, onwards = inner.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("_part", "_wide", *keys).orderBy(F.col("_at").desc())
    found = {n: F.last(new[n], True).over(upto) for n in last} | {n: F.lag(new[n]).over(inner) for n in previous} | {n: F.sum(new[n]).over(upto) for n in total} | {n: F.min(new[n]).over(onwards) for n in least_after}
    out = every.select(*kept, "_taken", *[e.alias(n) for n, e in found.items()]).filter("NOT _taken")
    return out.select(*kept, *[(F.col(n)["v"] if n in previous else F.coalesce(n, F.lit(0)) if n in total else F.col(n)).alias(n) for n in names])


def chain(firsts: DataFrame, hops: DataFrame) -> DataFrame:
    """(at) of all places reached from ``firsts`` (at) over ``hops`` (at, next), one way on from a place at most, by doubling: after k
    rounds a hop stands for 2^k, so that a chain of n places takes log2(n) joins. Each round is a written table."""
    reached, hops = written(firsts.select("at"), "reached"), written(hops, "hops")
    while not hops.isEmpty():
        on = reached.join(hops, "at").select(F.col("next").alias("at"))
        reached = written(reached.unionByName(on).distinct(), "reached")
        far = hops.select(F.col("at").alias("next"), F.col("next").alias("_far"))
        hops = written(hops.join(far, "next").select("at", F.col("_far").alias("next")), "hops")
    return reached
