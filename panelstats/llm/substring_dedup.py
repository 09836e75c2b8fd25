"""Substring dedup by super-k-mer partitioning.

A window is ``width`` consecutive words of one document. Its minimiser is the least of the runs of ``m`` words in it, under one order of all
runs; consecutive windows that share it form a super-k-mer, which travels as one packed string to the bucket of the minimiser: the
number of its words, two bytes for each word (a frequent one's number), and the other words as they are. Equal words
pack equally. Equal windows have equal minimisers, so they meet there: the bucket's windows are sorted by a 64-bit hash, and
those with equal hashes are compared as bytes, which gives each distinct window the least doc_id that it starts in, exactly.

A task packs equal super-k-mers once, with the least and largest doc_id it met them in. The order of runs puts frequent ones
last (a bitmap of fixed size that tasks' counts mark), so that windows which merely touch a passage of many documents go to
the buckets of what is beside it. Thus a passage of a third of all documents costs its buckets a row or so a task. The
order decides where windows travel, never what is found.

Buckets answer with the super-k-mers of which a document can lose a window: a 128-bit digest and the least doc_id of each window.
A second pass over the texts meets the answers by digest, in a plain join that Spark can split, and what each document loses is
joined with the texts.

Defined results: the kept words are joined by one space; a null text has no words; texts shorter than a window lose nothing; rows that share a
doc_id are one document, so windows that they share with each other stay in each; equal rows lose alike; rows without doc_id neither lose
nor take words; words are compared as they are; an empty table gives an empty result; extra columns stay, and those named
like a result column, or ``_v``, ``_doc``, ``_of`` and ``_hits``, give way. Windows are judged on the input alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .storage import drop, save, tidy
from .text import mix, pieces, word_bounds, word_hashes

#: Bits of the bitmap of frequent runs, runs that mark it at most, runs that a task counts together and the count it reports.
BITMAP_BITS, MARKS, COUNTED, FREQUENT = 23, 1 << 20, 1 << 22, 8
#: Words with a number at most, bytes of such a word at most, and bits of the table that finds them. They set the size of packed strings, nothing else.
NUMBERED, SHORT, TABLE_BITS = 0xFFFF, 32, 20
#: Super-k-mers that a task packs together, and bytes of packed strings that a bucket's task sorts together at least.
PACKED, SORTED = 1 << 17, 1 << 21
_BASE = np.uint64(0xD1B54A32D192ED03)
_LITERAL = 0xFFFF


class Numbers:
    """Numbers of frequent words, found by hash and length; words that meet in a slot of the table keep one number."""

    def __init__(self, words: list[bytes]):
        ends = np.cumsum([len(w) for w in words] or [0])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.lengths = (ends - starts)[: len(words)]
        self.hashes = word_hashes(np.frombuffer(b"".join(words), np.uint8), starts, ends, folded=False)[: len(words)]
        self.table = np.full(1 << TABLE_BITS, -1, np.int32)
        self.table[(self.hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = np.arange(len(words))

    def of(self, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each word, or _LITERAL."""
        at = self.table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
        if not len(self.hashes):
            return np.full(len(hashes), _LITERAL, np.uint16)
        known = (at >= 0) & (self.hashes[at] == hashes) & (self.lengths[at] == lengths)
        return np.where(known, at, _LITERAL).astype(np.uint16)


class Order:
    """What all tasks share, of bounded size: the marks of frequent runs and the numbers of frequent words."""

    def __init__(self, marks: np.ndarray, words: list[bytes]):
        self.marks, self.words, self._numbers = np.packbits(marks), words, None

    def __getstate__(self):
        return self.marks, self.words

    def __setstate__(self, state):
        (self.marks, self.words), self._numbers = state, None

    def ready(self) -> tuple[np.ndarray, Numbers]:
        if self._numbers is None:
            self._numbers = np.unpackbits(self.marks).astype(bool), Numbers(self.words)
        return self._numbers


def _run_hashes(words: np.ndarray, m: int) -> np.ndarray:
    """Of each word but the last m - 1, the hash of the ``m`` words from it on."""
    factor = mix(np.arange(1, m + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    out = np.zeros(max(0, len(words) - m + 1), np.uint64)
    for k in range(m):
        out += words[k : k + len(out)] * factor[k]
    return mix(out)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values, by doubling."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def super_kmers(texts: pa.Array, order: Order, width: int, m: int):
    """(text, word at which it starts, minimiser, packed bytes) of every super-k-mer, as arrays and a list."""
    marks, numbers = order.ready()
    data, starts, stops, first = word_bounds(texts)
    counts = np.diff(first)
    valid = np.repeat(first[1:] - width, counts) >= np.arange(len(starts))  # words that begin a window
    at = np.flatnonzero(valid)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, []
    lengths = stops - starts
    words = word_hashes(data, starts, stops, folded=False)
    runs = _run_hashes(words, m)
    late = marks[(runs & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)]
    minimiser = _least(runs >> np.uint64(1) | late.astype(np.uint64) << np.uint64(63), width - m + 1)[at]
    owner = np.repeat(np.arange(len(texts)), counts)[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (minimiser[1:] != minimiser[:-1]) | (owner[1:] != owner[:-1])
    began = np.flatnonzero(fresh)
    since = np.arange(len(at)) - np.repeat(began, np.diff(np.append(began, len(at))))
    begin = np.flatnonzero(since % (width - m + 1) == 0)  # a run that repeats in a text is cut
    windows = np.diff(np.append(begin, len(at)))
    codes = numbers.of(words, lengths)
    literal = np.flatnonzero(codes == _LITERAL)
    # The literal words of the piece, one blank after each, and where those of each word begin.
    whole = data.tobytes()
    flat = b"".join([whole[a:b] + b" " for a, b in zip(starts[literal].tolist(), stops[literal].tolist())])
    place = np.zeros(len(codes) + 1, np.int64)
    place[literal + 1] = lengths[literal] + 1
    place = np.cumsum(place)
    low, high = at[begin], at[begin] + windows + width - 1
    coded, sizes = codes.astype("<u2").tobytes(), [bytes([n]) for n in range(256)]
    packed = [sizes[b - a] + coded[2 * a : 2 * b] + flat[x:y] for a, b, x, y in zip(low.tolist(), high.tolist(), place[low].tolist(), place[high].tolist())]
    return owner[begin], low - first[owner[begin]], minimiser[begin].view(np.int64), packed


def _order(docs: DataFrame, m: int) -> Order:
    """The slots of the runs that tasks meet most, and the words; bounded numbers of both come to the driver."""

    @tidy
    def run(batches):
        held, size = [], 0

        def rows(kind, keys, words, n):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), pa.array(keys, pa.int32()), pa.array(words, pa.binary()), pa.array(n, pa.int64())], ["kind", "slot", "word", "n"])

        def often():
            counts = np.bincount(np.concatenate(held), minlength=1 << BITMAP_BITS)
            some = np.flatnonzero(counts >= FREQUENT)
            return rows(0, some.astype(np.int32), [None] * len(some), counts[some])

        for _, texts in pieces(batches):
            data, starts, stops, _first = word_bounds(texts)
            words = word_hashes(data, starts, stops, folded=False)
            found, counts = np.unique(words, return_counts=True)
            found, counts = found[counts >= FREQUENT], counts[counts >= FREQUENT]
            one = np.zeros(1 << TABLE_BITS, np.int64)
            one[(words >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = np.arange(len(words))
            at = one[(found >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
            if len(words):
                sound = (words[at] == found) & (stops[at] - starts[at] <= SHORT)
                yield rows(1, [None] * int(sound.sum()), [bytes(data[a:b]) for a, b in zip(starts[at[sound]].tolist(), stops[at[sound]].tolist())], counts[sound])
            held.append((_run_hashes(words, m) & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int32))
            size += len(held[-1])
            if size >= COUNTED:
                yield often()
                held, size = [], 0
        if held:
            yield often()

    counts, path = save(docs.select("text").mapInArrow(run, "kind int, slot int, word binary, n long").groupBy("kind", "slot", "word").agg(F.sum("n").alias("n")), "frequent")
    top = lambda kind, most: counts.filter(F.col("kind") == kind).orderBy(F.col("n").desc(), "slot", "word").limit(most)
    marks = np.zeros(1 << BITMAP_BITS, bool)
    marks[top(0, MARKS).select("slot").toArrow()["slot"].to_numpy()] = True
    words = top(1, NUMBERED).select("word").toArrow()["word"].to_pylist()
    drop(docs.sparkSession, path)
    return Order(marks, words)


def _packed(docs: DataFrame, order, width: int, m: int) -> DataFrame:
    """(minimiser, packed, lo, hi) of the distinct super-k-mers of a task, with the least and largest doc_id."""
    together = PACKED

    @tidy
    def run(batches):
        held, size = [], 0

        def once():
            rows = pa.concat_tables(held).group_by("packed", use_threads=False).aggregate([("minimiser", "min"), ("doc_id", "min"), ("doc_id", "max")])
            for batch in rows.select(["minimiser_min", "packed", "doc_id_min", "doc_id_max"]).rename_columns(["minimiser", "packed", "lo", "hi"]).combine_chunks().to_batches(max_chunksize=1 << 15):
                yield batch

        for batch, texts in pieces(batches):
            owner, _at, minimiser, packed = super_kmers(texts, order.value, width, m)
            if len(packed):
                held.append(pa.table({"minimiser": minimiser, "packed": pa.array(packed, pa.binary()), "doc_id": batch.column(0).to_numpy(zero_copy_only=False)[owner]}))
                size += len(packed)
            if size >= together:
                yield from once()
                held, size = [], 0
        if held:
            yield from once()

    return docs.select("doc_id", "text").mapInArrow(run, "minimiser long, packed binary, lo long, hi long")


def _windows_of(packed: pa.Array, width: int):
    """Of packed super-k-mers: the super-k-mer of each window, a hash of its words, and a function of windows that gives their words as bytes."""
    ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1].astype(np.int64)
    data = np.frombuffer(packed.buffers()[2], np.uint8)
    sizes = data[ends[:-1]].astype(np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(packed)), sizes)
    byte = np.repeat(ends[:-1] + 1 - 2 * first[:-1], sizes) + 2 * np.arange(first[-1])
    codes = data[byte].astype(np.uint16) | data[byte + 1].astype(np.uint16) << np.uint16(8)
    # What stands behind the numbers of a super-k-mer are its literal words, a blank after each.
    behind = np.ones(len(data), bool)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, ends[:-1], 1)
    np.add.at(inside, ends[:-1] + 1 + 2 * sizes, -1)
    behind = np.cumsum(inside[:-1], dtype=np.int8) == 0
    behind[: ends[0]] = False
    behind[ends[-1] :] = False
    flat = data[behind]
    literal = np.flatnonzero(codes == _LITERAL)
    stops = np.flatnonzero(flat == 32)
    starts = np.concatenate([[0], stops[:-1] + 1]).astype(np.int64) if len(stops) else stops
    words = mix(codes.astype(np.uint64) + np.uint64(1))
    words[literal] = word_hashes(flat, starts, stops, folded=False)
    place = np.zeros(len(codes) + 1, np.int64)
    place[literal + 1] = stops - starts + 1
    place = np.cumsum(place)
    sums = np.zeros(len(words) + 1, np.uint64)
    powers = np.full(len(words) + 1, _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    np.cumsum(words * powers[:-1], out=sums[1:])
    count = sizes - width + 1
    of = np.repeat(np.arange(len(packed)), count)
    at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + first[of]
    # Hashes are compared at the same power: multiplied up to that of the last word instead of divided.
    hashes = mix((sums[at + width] - sums[at]) * powers[len(words) - at])
    coded, whole = codes.astype("<u2").tobytes(), flat.tobytes()

    def spelled(some: np.ndarray) -> list[bytes]:
        low, high = at[some], at[some] + width
        return [coded[2 * a : 2 * b] + whole[x:y] for a, b, x, y in zip(low.tolist(), high.tolist(), place[low].tolist(), place[high].tolist())]

    return of, hashes, spelled


def _answers(rows: pa.Table, width: int):
    """(h1, h2, least) of those super-k-mers that hold a window which a document with a smaller doc_id than one of theirs holds too; ``least`` has the
    least doc_id of each of their windows."""
    packed = rows["packed"].combine_chunks()
    lo, hi = rows["lo"].to_numpy(), rows["hi"].to_numpy()
    of, hashes, spelled = _windows_of(packed, width)
    order = np.argsort(hashes)
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    shared = np.zeros(len(order), bool)
    shared[1:] |= same
    shared[:-1] |= same
    least = lo[of]
    several = order[shared]
    if len(several):
        seen, keys = {}, spelled(several)
        for key, doc in zip(keys, least[several].tolist()):
            if doc < seen.get(key, doc + 1):
                seen[key] = doc
        least[several] = [seen[key] for key in keys]
    hit = {packed[int(i)].as_py(): i for i in np.unique(of[least < hi[of]])}  # tasks may have packed the same one
    texts, hit = list(hit), np.array(list(hit.values()), np.int64)
    spans = np.searchsorted(of, np.stack([hit, hit + 1]))
    digests = np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts), "<i8").reshape(-1, 2)
    lists = [least[a:b] for a, b in zip(*spans.tolist())]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*lists, least[:0]])))], ["h1", "h2", "least"])


def _sorted_buckets(packed: DataFrame, width: int) -> DataFrame:
    """Answers of all buckets. Rows come sorted by minimiser, and whole minimisers are taken together, a bounded number of bytes and one
    minimiser's rows at most at once."""
    together = SORTED

    @tidy
    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([batch])
            if size >= together:
                keys = batch.column(0).to_numpy()
                cut = int(np.searchsorted(keys, held[-1]["minimiser"][-1].as_py(), "right"))
                if cut < len(keys):
                    yield _answers(pa.concat_tables([*held, rows.slice(0, cut)]), width)
                    held, size, rows = [], 0, rows.slice(cut)
            held.append(rows)
            size += rows["packed"].nbytes
        if held:
            yield _answers(pa.concat_tables(held), width)

    dealt = packed.repartition("minimiser").sortWithinPartitions("minimiser")
    return dealt.mapInArrow(run, "h1 long, h2 long, least array<long>")


def _met(docs: DataFrame, order, width: int, m: int) -> DataFrame:
    """(h1, h2, doc_id, _v, at) of every super-k-mer of (doc_id, _v, text)."""

    @tidy
    def run(batches):
        for batch, texts in pieces(batches):
            owner, at, _minimiser, packed = super_kmers(texts, order.value, width, m)
            digests = np.frombuffer(b"".join([hashlib.blake2b(p, digest_size=16).digest() for p in packed]), "<i8").reshape(-1, 2)
            of = lambda i: pa.array(batch.column(i).to_numpy(zero_copy_only=False)[owner])
            yield pa.RecordBatch.from_arrays([pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()), of(0), of(1), pa.array(at.astype(np.int64))], ["h1", "h2", "doc_id", "_v", "at"])

    return docs.select("doc_id", "_v", "text").mapInArrow(run, "h1 long, h2 long, doc_id long, _v long, at long")


def _without(schema: pa.Schema, width: int):
    @tidy
    def apply(batches):
        for batch, texts in pieces(batches):
            data, starts, stops, first = word_bounds(texts)
            hits = batch.column(batch.schema.get_field_index("_hits"))
            out, n_removed = [], []
            whole = data.tobytes()
            for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                keep = np.ones(b - a, bool)
                if hits[i].is_valid:
                    packed = hits[i].values.to_numpy()
                    edge = np.zeros(b - a + 1, np.int64)
                    for k in range(width):
                        begin = (packed >> 16)[packed >> k & 1 == 1] + k
                        np.add.at(edge, begin, 1)
                        np.add.at(edge, begin + width, -1)
                    keep = np.cumsum(edge)[:-1] == 0
                n_removed.append(b - a - int(keep.sum()))
                out.append(b" ".join([whole[s:e] for s, e in zip(starts[a:b][keep].tolist(), stops[a:b][keep].tolist())]).decode())
            new = {"text": out, "n_words": np.diff(first).astype(np.int64), "n_removed": n_removed}
            yield pa.RecordBatch.from_arrays([pa.array(new[f.name], f.type) if f.name in new else batch.column(batch.schema.get_field_index(f.name)) for f in schema], schema=schema)

    return apply


def dedup_substrings(docs: DataFrame, width: int = 13, m: int = 2) -> DataFrame:
    """``docs`` with their texts as kept words joined by one space, and n_words (before) and n_removed: a word goes that is covered by a window
    whose words also start in a document with a smaller doc_id."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if not 1 <= m <= width or width - m + 1 > 16 or width > 128:
        raise ValueError("a window has at most 128 words, a minimiser 1 to width, and at most 16 places in a window")
    spark = docs.sparkSession
    docs = docs.drop("n_words", "n_removed", "_v", "_doc", "_of", "_hits")
    named = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = spark.sparkContext.broadcast(_order(named, m))
    answers, a_path = save(_sorted_buckets(_packed(named, order, width, m), width), "answers")

    # Rows that share a doc_id are told apart by their texts.
    unique = named.groupBy("doc_id").count().filter("count > 1").isEmpty()
    version = F.lit(0).cast("long") if unique else F.xxhash64(F.coalesce("text", F.lit("")))
    met = _met(named.withColumn("_v", version), order, width, m).join(answers.hint("merge"), ["h1", "h2"])
    lost = F.aggregate(F.transform("least", lambda x, i: F.when(x < F.col("doc_id"), F.call_function("shiftleft", F.lit(1), i)).otherwise(F.lit(0))), F.lit(0), lambda t, x: t + x)
    hits = met.select("doc_id", "_v", (F.call_function("shiftleft", F.col("at"), F.lit(16)) + lost).alias("hit")).filter(F.col("hit").bitwiseAND(0xFFFF) != 0)
    hits, h_path = save(hits.groupBy(F.col("doc_id").alias("_doc"), F.col("_v").alias("_of")).agg(F.collect_set("hit").alias("_hits")), "lost-words")
    drop(spark, a_path)

    # The same join at every size: a broadcast of what is lost would grow with the documents.
    on = F.col("doc_id").cast("long") == F.col("_doc")
    both = docs.join(hits.hint("merge"), on if unique else on & (version == F.col("_of")), "left").drop("_doc", "_of")
    schema = StructType([*docs.schema.fields, StructField("n_words", LongType()), StructField("n_removed", LongType())])
    return both.mapInArrow(_without(to_arrow_schema(schema), width), schema)
