"""Nested documents, and the way back from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nested(rows: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row per value of the first key, its document as JSON text: maps by the other keys, in order, with the fields as
    leaves. Null leaves are left out; rows without any field go before nesting, so that no branch is empty. Keys are quoted
    as JSON needs; a null key is named 'null'. Rows are unique by their keys."""
    some = F.coalesce(*[F.col(f).cast("string") for f in fields]).isNotNull()
    named = [F.coalesce(F.col(k).cast("string"), F.lit("null")).alias(k) for k in keys[1:]]
    out = rows.filter(some).select(keys[0], *named, F.struct(*fields).alias("doc"))
    for depth in range(len(keys) - 1, 0, -1):
        entries = F.collect_list(F.struct(F.col(keys[depth]).alias("k"), F.col("doc").alias("d")))
        entries = F.array_sort(entries, lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))
        out = out.groupBy(*keys[:depth]).agg(F.map_from_entries(entries).alias("doc"))
    return out.select(keys[0], F.to_json("doc").alias("doc"))


def flattened(docs: DataFrame, keys: list[str], fields: dict[str, str]) -> DataFrame:
    """The leaves of ``nested`` documents: one row for each field that is there, (keys, field, value as text)."""
    schema = "struct<" + ", ".join(f"{f}: {t}" for f, t in fields.items()) + ">"
    for _ in keys[1:]:
        schema = f"map<string, {schema}>"
    out = docs.select(keys[0], F.from_json("doc", schema).alias("doc"))
    for depth, k in enumerate(keys[1:], 1):
        out = out.select(*keys[:depth], F.explode("doc").alias(k, "doc"))
    leaves = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"doc.{f}").cast("string").alias("value")) for f in fields])).alias("leaf")
    return out.select(*keys, leaves).select(*keys, "leaf.*").filter("value IS NOT NULL")
