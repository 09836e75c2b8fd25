"""Target-distribution importance resampling over hashed n-grams, by prefix CRCs.

A document is folded, its words are joined by one space, and the running CRC-32 of that text is taken once. The CRC of any
run of words follows from the running CRCs R at its two ends: with shift(c, n) the effect of n zero bytes on a register,
which is linear over GF(2),

    crc32(run) = R[end] ^ shift(R[start] ^ 0xFFFFFFFF, n) ^ 0xFFFFFFFF,

what stood before the start cancels. No n-gram is built or hashed on its own, and all lengths cost the same. Texts are
laid side by side in lanes of fixed width, whose registers step together; the carry from lane to lane is the same shift.

Every n-gram falls into one of ``buckets`` by its CRC. One pass counts the buckets of all documents (a task sends at most one row
a bucket), the target is counted alike, and the log ratio of the smoothed shares is a bucket's gain. A second pass reads
the texts again, which costs less than to keep their buckets, gives each document the floored mean of its gains and adds a Gumbel draw
that its id fixes: the highest scores are a sample without replacement by the weights' exponential. Places are
given by a range partitioning on (score, doc_id) and the sizes of the parts, so that no task holds more than its range.

Defined results: a null text has no words, no features and weight 0; rows without doc_id draw as the empty id does and come
last among ties; rows that share a doc_id draw alike, each counts, and ties between them go by weight and number of features; documents
with fewer than ``min_words`` words have a score and no rank; an empty target makes every bucket's gain follow from smoothing
alone; an empty table gives an empty result; extra columns stay, and those named like a result column give way.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .storage import drop, save, tidy
from .text import fold, pieces, word_bounds

_ONES = np.uint32(0xFFFFFFFF)
#: Words are runs of ASCII letters and digits and of all bytes beyond ASCII.
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: Bytes of a lane, and bytes of normalised text whose registers are held at once.
LANE, SEGMENT = 512, 1 << 22


class Shift:
    """The registers after n zero bytes: a table of four bytes for each n below LANE, and one for each power of two."""

    def __init__(self):
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = np.where(step & 1, (step >> np.uint32(1)) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
        self.step = step  # of one byte
        near = np.empty((LANE + 1, 4, 256), np.uint32)
        near[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        for n in range(LANE):
            near[n + 1] = step[near[n] & np.uint32(255)] ^ (near[n] >> np.uint32(8))
        self.near, self.lane, self.powers = near, near[LANE].tolist(), [near[LANE]]

    @staticmethod
    def _through(table: np.ndarray, c: np.ndarray) -> np.ndarray:
        return table[0][c & 255] ^ table[1][c >> 8 & 255] ^ table[2][c >> 16 & 255] ^ table[3][c >> 24]

    def __call__(self, c: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Each register of ``c`` after its own number of zero bytes."""
        low = n % LANE
        out = self.near[low, 0, c & 255] ^ self.near[low, 1, c >> 8 & 255] ^ self.near[low, 2, c >> 16 & 255] ^ self.near[low, 3, c >> 24]
        far, k = n // LANE, 0
        while (far >> k).any():
            if k == len(self.powers):
                self.powers.append(self._through(self.powers[-1], self.powers[-1]))
            some = np.flatnonzero(far >> k & 1)
            out[some] = self._through(self.powers[k], out[some])
            k += 1
        return out


_shift: list[Shift] = []


def shift() -> Shift:
    if not _shift:
        _shift.append(Shift())
    return _shift[0]


def running_crcs(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Registers (start 0, no final complement) before the bytes at the places ``at`` of a byte array."""
    s = shift()
    lanes = -(-len(data) // LANE) + 1
    padded = np.zeros(lanes * LANE, np.uint8)
    padded[: len(data)] = data
    columns = np.ascontiguousarray(padded.reshape(lanes, LANE).T).astype(np.uint32)
    own = np.zeros((LANE + 1, lanes), np.uint32)
    for i in range(LANE):
        own[i + 1] = s.step[(own[i] ^ columns[i]) & np.uint32(255)] ^ (own[i] >> np.uint32(8))
    carry, c, (a, b, d, e) = [], 0, s.lane
    for last in own[LANE].tolist():
        carry.append(c)
        c = a[c & 255] ^ b[c >> 8 & 255] ^ d[c >> 16 & 255] ^ e[c >> 24] ^ last
    lane, within = at // LANE, at % LANE
    return own[within, lane] ^ s(np.array(carry, np.uint32)[lane], within)


def ngram_crcs(texts: pa.Array, n: int = 2):
    """Yields (text, crc) arrays of all runs of 1 to ``n`` words of the texts of a large_string array, and the numbers of
    words of all texts first."""
    data, starts, stops, first = word_bounds(texts, _SEPARATOR)
    yield np.diff(first)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(stops, starts[i] + SEGMENT, "right")))
        more = min(j + n - 1, len(starts))  # runs that begin before j may end after it
        lo, hi = int(starts[i]), int(stops[more - 1])
        raw = data[lo:hi]
        word = ~_SEPARATOR[raw]
        kept = word.copy()
        kept[1:] |= word[:-1]  # the separator after each word
        normal = np.where(word, fold(raw), np.uint8(32))[kept]
        place = np.cumsum(kept) - 1
        begin, end = place[starts[i:more] - lo], place[stops[i:more] - 1 - lo] + 1
        crcs = running_crcs(normal, np.concatenate([begin, end]))
        at_begin, at_end = crcs[: len(begin)], crcs[len(begin) :]
        for k in range(n):
            m = min(j, len(starts) - k) - i
            if m <= 0:
                break
            whole = owner[i : i + m] == owner[i + k : i + k + m]
            a, b = np.flatnonzero(whole), np.flatnonzero(whole) + k
            yield owner[i:][a], at_end[b] ^ shift()(at_begin[a] ^ _ONES, end[b] - begin[a]) ^ _ONES
        i = j


def bucket_counts(docs: DataFrame, n: int = 2, buckets: int = 10_000) -> np.ndarray:
    """How many n-grams of all texts fall into each bucket."""

    @tidy
    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for _, texts in pieces(batches):
            found = ngram_crcs(texts, n)
            next(found)
            for _, crc in found:
                counts += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["bucket", "n"])

    total = np.zeros(buckets, np.int64)
    for r in docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r["bucket"]] = r["n"]
    return total


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share of the target over that of the documents."""
    size, sum_own, sum_target = len(own), float(own.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (sum_own + size) / ((s + 1.0) * (sum_target + size)))) for s, t in zip(own.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, n: int = 2) -> DataFrame:
    """``docs`` with n_words, n_features and weight, the floored mean of the gains of their features."""
    from pyspark.sql.pandas.types import to_arrow_schema

    new = ["n_words", "n_features", "weight"]
    docs = docs.drop(*new)
    schema = StructType([*docs.schema.fields, *[StructField(c, LongType()) for c in new]])
    arrow = to_arrow_schema(schema)

    @tidy
    def run(batches):
        for batch, texts in pieces(batches):
            found = ngram_crcs(texts, n)
            words = next(found)
            features, total = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for text, crc in found:
                features += np.bincount(text, minlength=len(texts))
                total += np.bincount(text, gain[crc % np.uint32(len(gain))], len(texts)).astype(np.int64)  # sums below 2^53 are exact
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(words.astype(np.int64)), pa.array(features), pa.array(total // np.maximum(features, 1))], schema=arrow)

    return docs.mapInArrow(run, schema)


def gumbel(doc_id: str, seed: int):
    """floor(-1000 ln(-ln u)), with u from the hash of the seed and the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def scored(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """``docs`` with n_words, n_features, weight and score; both frames have a text."""
    gain = gains(bucket_counts(docs, n, buckets), bucket_counts(target, n, buckets))
    return weighed(docs.drop("score"), gain, n).withColumn("score", F.col("weight") + gumbel("doc_id", seed))


def _order() -> list:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features").desc()]


def ranked(rows: DataFrame, percent: int = 25, min_words: int = 20) -> DataFrame:
    """Adds rank (long) to rows with doc_id, n_words, n_features, weight and score: 1, 2, 3... of the drawn ones, else null. The rows
    are read several times: a written table, not a plan over texts."""
    spark = rows.sparkSession
    able = F.coalesce(F.col("n_words") >= min_words, F.lit(False))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.filter(able).repartitionByRange(parts, *_order()).sortWithinPartitions(*_order())
    # The number holds the partition from bit 33 on, in the order of the ranges, and below it the place within.
    placed, _ = save(dealt.withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", 33)
    before, offsets = 0, []
    for r in placed.groupBy(part.alias("_part")).count().orderBy("_part").collect():  # one row a partition
        offsets.append((r["_part"], before))
        before += r["count"]
    starts = spark.createDataFrame(offsets, "_part long, _start long")
    place = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    done = placed.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn("rank", F.when(place <= percent * before // 100, place).cast("long"))
    return done.select(*rows.columns, "rank").unionByName(rows.filter(~able).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000, percent: int = 25, min_words: int = 20, seed: int = 7) -> DataFrame:
    """The drawn documents with their own columns, n_words, n_features, weight and score. Texts are not shuffled: the last drawn
    place tells of each document by itself whether it is drawn. Rows equal in id, weight and number of features are drawn together."""
    rows, path = save(scored(docs.select("doc_id", "text"), target, n, buckets, seed).drop("text"), "scores")
    last = ranked(rows, percent, min_words).filter("rank IS NOT NULL").orderBy(F.col("rank").desc()).head()
    drop(docs.sparkSession, path)
    again = scored(docs, target, n, buckets, seed)
    if last is None:
        return again.filter("false")
    key = lambda score, doc, weight, features: F.struct(-score, doc.isNull(), doc.cast("long"), -weight, -features)
    mine = key(*map(F.col, ("score", "doc_id", "weight", "n_features")))
    return again.filter((F.col("n_words") >= min_words) & (mine <= key(*(F.lit(last[c]).cast("long") for c in ("score", "doc_id", "weight", "n_features")))))
