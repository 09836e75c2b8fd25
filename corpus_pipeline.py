"""The training-text pipeline: documents that fail the quality rules go, lines that many documents share stay
in one of them, of each group of near copies one document stays, sources are mixed to their weights, and what
is left becomes token ids.

Every stage works on all that its predecessor kept, and its result is written before the next one reads it; what a
stage wrote for itself, and its input, are deleted then.
All but the last return the columns of ``documents``; ``n_chars`` follows the text. Rows without doc_id are
kept by every stage. A test runs the whole of it against a brute-force version, since SQL can't express the
last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelstats.llm import bpe, line_dedup, mixing, ngram_join, quality_rules, storage
from panelstats.plans.ship import ship
from panelstats.sources import table


def _rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def _lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def _copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component stays. Rows that share a doc_id are one document to the join:
    they go or stay together, and of those that repeat id and text the smallest by their other columns stays."""
    ship(spark)
    gone = ngram_join.link_components(docs).filter("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    some = kept.join(repeated.hint("merge"), "doc_id", "left_semi")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    once = some.groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("_others")).select("doc_id", "text", "_others.*").select(*docs.columns)
    return once.unionByName(kept.join(repeated.hint("merge"), "doc_id", "left_anti").select(*docs.columns))


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def _tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids (little-endian unsigned 32-bit) and whether they decode to the text."""
    import public_tokenizers

    ship(spark)
    encoded = bpe.encode(docs.select("doc_id", "source", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decoded="decoded")
    return encoded.select("doc_id", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"))


STAGES = [("quality rules", _rules), ("line dedup", _lines), ("n-gram Jaccard join", _copies), ("mixing to target weights", _mix), ("byte-level BPE", _tokens)]

#: The last stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, at = table(spark, sf_dir, "documents"), storage.mark()
    for name, stage in STAGES[:-1]:
        docs, path = storage.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        storage.drop(spark, *[p for p in storage.since(at) if p != path])  # the stage's own tables and its input
    return STAGES[-1][1](spark, docs, sf_dir)
