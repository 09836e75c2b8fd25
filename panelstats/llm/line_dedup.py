"""Line dedup by levelled sorted runs of line hashes.

Documents come in batches of falling doc_id, so that the first document in which a line is met is the
largest that holds it. A batch reduces its lines to one row per key (documents holding it, largest doc_id),
merge-anti-joins the keys that the runs already know to be frequent (nothing about those can change), and
adds the rest as a new sorted run. When a level has ``fanout`` runs they are merged into one of the next
level. Runs are tables bucketed and sorted by key, so that merges and anti-joins are sort-merge joins and
aggregations without a shuffle. In the end the keys of at least ``min_docs`` documents go back to
the documents.

Defined results: a null or empty text is one empty line; a doc_id that repeats counts as one document, and
each of its rows loses the same lines; rows without doc_id are neither counted nor changed; an empty table
gives an empty result; extra columns stay, and those named like a result column, or ``_k1``, ``_k2`` and ``_doc``,
give way. A text that loses every line becomes empty.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .storage import drop, drop_table, save, tidy
from .text import BLANKS, pieces

_KEYS = "doc_id long, k1 long, k2 long"
_BLANK_BYTES = BLANKS.encode()


def _key(line: bytes) -> bytes:
    return line.strip(_BLANK_BYTES).lower()


def _long_keys(lines: list[bytes], min_chars: int):
    """(index, 16-byte hash) of the lines whose key has at least ``min_chars`` code points."""
    for i, line in enumerate(lines):
        if len(line) >= min_chars:
            key = _key(line)
            if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
                yield i, hashlib.blake2b(key, digest_size=16).digest()


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row for each row of (doc_id, text) and each distinct key in its text."""

    @tidy
    def keys(batches):
        for batch, texts in pieces(batches):
            ids, hashes = [], []
            for doc, t in zip(batch.column(0).to_pylist(), texts.to_pylist(), strict=True):
                own = {h for _, h in _long_keys(t.encode().split(b"\n"), min_chars)}
                ids += [doc] * len(own)
                hashes += own
            k = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy())], ["doc_id", "k1", "k2"])

    return docs.mapInArrow(keys, _KEYS)


class Runs:
    """The levels of sorted runs, one bucketed table each, in the session's warehouse."""

    def __init__(self, spark, min_docs: int, fanout: int):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.format("parquet").bucketBy(self.buckets, "k1", "k2").sortBy("k1", "k2").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _merged(self, names: list[str]) -> DataFrame:
        rows = reduce(DataFrame.unionByName, map(self.spark.table, names))
        return rows.groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.max("last").alias("last"))

    def add(self, keys: DataFrame) -> None:
        """Adds a batch of (k1, k2, n, last), without the keys that a run shows to be frequent already."""
        for name in self._names():
            keys = keys.join(self.spark.table(name).filter(F.col("n") >= self.min_docs).select("k1", "k2"), ["k1", "k2"], "left_anti")
        self._write(keys, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._write(self._merged(old), level + 1)
            self.drop(old)
            level += 1

    def drop(self, names: list[str] | None = None) -> None:
        drop_table(self.spark, *(self._names() if names is None else names))

    def frequent(self) -> DataFrame:
        """Keys of at least ``min_docs`` documents, with the largest doc_id holding each."""
        return self._merged(self._names()).filter(F.col("n") >= self.min_docs).select("k1", "k2", "last")


def _kept(schema: pa.Schema, min_chars: int):
    @tidy
    def apply(batches):
        for batch, texts in pieces(batches):
            own = {n: batch.column(batch.schema.get_field_index(n)) for n in ("_k1", "_k2")}
            out, n_lines, n_dropped = [], [], []
            for t, a, b in zip(texts.to_pylist(), own["_k1"], own["_k2"], strict=True):
                lines = t.encode().split(b"\n")
                n_lines.append(len(lines))
                if a.is_valid:
                    flat = np.stack([a.values.to_numpy(), b.values.to_numpy()], 1).astype("<i8").tobytes()
                    gone = {flat[i : i + 16] for i in range(0, len(flat), 16)}
                    lost = {i for i, h in _long_keys(lines, min_chars) if h in gone}
                    lines = [x for i, x in enumerate(lines) if i not in lost]
                n_dropped.append(n_lines[-1] - len(lines))
                out.append(b"\n".join(lines).decode())
            new = {"text": out, "n_lines": n_lines, "n_dropped": n_dropped}
            yield pa.RecordBatch.from_arrays([pa.array(new[f.name], f.type) if f.name in new else batch.column(batch.schema.get_field_index(f.name)) for f in schema], schema=schema)

    return apply


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with their texts thinned, and n_lines (before) and n_dropped.

    The keys are taken in one pass over the texts and kept, split by batch (24 bytes a line of ``min_chars``
    or more); the texts are shuffled once, to meet the keys that they lose.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped", "_k1", "_k2", "_doc")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).head()[0] or []
    once = ids.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty()
    batch = reduce(lambda s, c: s + F.when(F.col("doc_id") <= c, 1).otherwise(0), cuts, F.lit(0))  # 0: the largest ids
    keyed = line_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL"), min_chars).withColumn("batch", batch)
    if not once:
        keyed = keyed.distinct()
    lines, path = save(keyed, "lines", "batch")
    runs = Runs(spark, min_docs, fanout)
    try:
        for i in range(batches):
            runs.add(lines.filter(F.col("batch") == i).groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("doc_id").alias("last")))
        # A table of its own, so that both sides of the join are plain and Spark can split the task of a very common line.
        frequent, frequent_path = save(runs.frequent(), "frequent-lines")
    finally:
        runs.drop()
    lost = lines.join(frequent.hint("merge"), ["k1", "k2"]).filter("doc_id < last").groupBy("doc_id").agg(F.collect_list(F.struct("k1", "k2")).alias("_l")).select("doc_id", F.col("_l.k1").alias("_k1"), F.col("_l.k2").alias("_k2"))
    lost, _ = save(lost, "lost-lines")
    drop(spark, path, frequent_path)
    # The same join at every size: a broadcast of the lost keys would grow with the documents.
    both = docs.join(lost.withColumnRenamed("doc_id", "_doc").hint("merge"), F.col("doc_id") == F.col("_doc"), "left").drop("_doc")
    schema = StructType([*docs.schema.fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    return both.mapInArrow(_kept(to_arrow_schema(schema), min_chars), schema)
