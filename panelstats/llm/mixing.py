"""Mixing sources to target weights.

Sizes are summed per source, targets follow from the weights, and every document is emitted floor(rate)
times plus once more when its own hash, read as a number in [0, 1), is below the fraction of the rate.
Reruns and retried tasks draw the same.

Defined results: a null or empty text has size 0; null sources form one source, the last; rows that share a
doc_id draw alike, rows without doc_id draw by their text, those with equal texts alike; ties between sources go by
code point; texts of any length count whole; an empty table gives an empty result; extra columns stay, and those named
like a result column, ``_source`` or ``_unnamed`` give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import save

#: Sources in code point order, null last, weigh so, repeating.
WEIGHTS = (3, 1, 2)
SHARE, MAX_RATE = 1.5, 2.0
#: More sources than this are joined by a shuffle instead of a broadcast.
BROADCAST_ROWS = 50_000


def size_of(text: str = "text") -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per source: source, source_size, target.

    Excess over ``max_rate`` times a source's size goes to the others by weight until none is above: in
    rising order of limit / weight, sources are filled to their limits as long as an equal level for the
    rest would be above them. The windows run over one row per source.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(every) - 1) % len(weights) + 1)
    sources = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(max_rate))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    level = (F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    sources = sources.withColumn("level", level).withColumn("at", F.row_number().over(filling))
    sources = sources.withColumn("_over", F.when(F.col("cap") / F.col("weight") > F.col("level"), F.struct("at", "level")))
    sources = sources.withColumn("_first", F.min("_over").over(whole))
    target = F.when(F.col("_first").isNull() | (F.col("at") < F.col("_first.at")), F.col("cap")).otherwise(F.col("_first.level") * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"))


def unnamed(doc_id: str = "doc_id", text: str = "text") -> Column:
    """What rows without doc_id draw by; null for the others, whose texts it doesn't read."""
    return F.when(F.col(doc_id).isNull(), F.md5(F.coalesce(F.col(text), F.lit(""))))


def draw(doc_id: str, seed: int, other: Column | None = None) -> Column:
    """A number in [0, 1) that the seed and the document's id, or else ``other``, fix."""
    key = F.coalesce(F.col(doc_id).cast("string"), *([] if other is None else [other]), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def plan(rows: DataFrame, sized: DataFrame, seed: int = 8) -> DataFrame:
    """Adds source_size, target and copies to rows with doc_id, source and, if there is one, ``_unnamed``; ``sized`` has the source and
    size of all of them."""
    other = F.col("_unnamed") if "_unnamed" in rows.columns else None
    sources, _ = save(targets(sized).withColumnRenamed("source", "_source"), "targets")
    if sources.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        sources = F.broadcast(sources)
    rows = rows.drop("source_size", "target", "copies", "_source").join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return rows.withColumn("copies", (F.floor(rate) + F.when(draw("doc_id", seed, other) < rate - F.floor(rate), 1).otherwise(0)).cast("int")).drop("_unnamed")


def mix(docs: DataFrame, seed: int = 8) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns. Words are counted in one pass, and
    the documents are read once more to be emitted."""
    rows = docs.select("doc_id", "source", unnamed().alias("_unnamed"), F.struct("*").alias("_row"))
    return plan(rows, docs.select("source", size_of().alias("size")), seed).select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("_row.*")
