"""Language-model scoring from a log-frequency Bloom filter.

Tasks count the word and word-pair hashes of their training documents, and send sorted keys with counts to
shards of the key space, where they are summed. A count c becomes a level, 1 + floor(log2 c) for words and pairs
alike; key and level go into the shard's Bloom filter for every level up to the count's. The filters, of a few bits
an entry, are broadcast while they are within ``max_filter_mb`` (their size is counted first; a worker holds them once); a corpus whose
filters outgrow that sends the distinct keys of each block of documents to the shards, whose filters send the same levels back to the
block, so that scores are equal either way. A count comes back by probing level after level until one is absent. The model mixes the pair's
relative frequency with the word's smoothed one, 0.4 to 0.6.

The base score needs exact counts: those of the most frequent words (``head_words`` at most) are broadcast, and
the other words of a document meet the table of counts in a join, so nothing broadcast grows with the input.

Defined results: a null or empty text is its end token alone; a text of any length is scored whole; rows without doc_id
are for training; a repeated row counts as often as it occurs; other columns of any name are left out; without training documents N and V are 0 and every count too.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import save, tidy
from .text import mix, pieces, word_bounds, word_hashes

MAX_FILTER_MB, HEAD_WORDS = 256, 500_000
#: Bits for each entry and level, probes for each, the weight of pairs, and characters of text for each shard.
BITS, PROBES, PAIR_WEIGHT, SHARD_CHARS = 8, 4, 0.4, 1 << 24
#: Tokens that a task counts together.
COUNTED = 1 << 22
_END = np.uint64(0x5851F42D4C957F2D)
_A, _B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_WORD, _PAIR = 0, 1
#: Bytes of a key that are sent and probed. Words keep all, since their counts are exact. A shard holds a bounded number of
#: pairs (a few millions), among which 40 bits of the hash, beside the bits that chose the shard, seldom collide.
_WIDTH = {_WORD: 8, _PAIR: 5}


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text and its end token, and the index of each text's first token."""
    data, starts, stops, first = word_bounds(texts)
    words = word_hashes(data, starts, stops)
    out = np.insert(words, first[1:], _END)
    return out, first[:-1] + np.arange(len(texts))


def pairs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's predecessor (the end token before a text's first) and the hash of the two."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[first] = _END
    return before, mix(before * _A + words * _B)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of keys of equal width."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def pack(kind: int, keys: np.ndarray) -> bytes:
    """The lowest bytes of each key."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : _WIDTH[kind]].tobytes()


def unpack(kind: int, data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // _WIDTH[kind], 8), np.uint8)
    out[:, : _WIDTH[kind]] = np.frombuffer(data, np.uint8).reshape(-1, _WIDTH[kind])
    return out.reshape(-1).view("<u8")


def levels_of(kind: int, counts: np.ndarray) -> np.ndarray:
    """The same for both kinds: a key met once has level 1."""
    return np.floor(np.log2(counts)).astype(np.int64) + 1


def count_of(kind: int, levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that a level stands for, 0 for level 0."""
    power = levels - 1
    return np.where(levels == 0, 0.0, np.where(power == 0, 1.0, np.exp2(power + 0.5)))


class Filter:
    """Bit arrays of shards of one kind of key."""

    def __init__(self, arrays: list[bytes], kind: int = _WORD):
        self.mask = np.uint64((1 << 8 * _WIDTH[kind]) - 1)
        self.bits = np.frombuffer(b"".join(arrays), np.uint8)
        self.size = np.array([8 * len(a) for a in arrays], np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]]).astype(np.uint64)

    @staticmethod
    def positions(keys: np.ndarray, level, probe: int, size) -> np.ndarray:
        h = mix(keys ^ np.uint64(level * int(_A) & 0xFFFFFFFFFFFFFFFF))
        return (h + np.uint64(probe) * (h >> np.uint64(32) | np.uint64(1))) % size

    @classmethod
    def build(cls, kind: int, keys: np.ndarray, counts: np.ndarray, entry_bits: int = BITS) -> bytes:
        top, keys = levels_of(kind, counts), keys & np.uint64((1 << 8 * _WIDTH[kind]) - 1)
        size = -(-int(top.sum()) * entry_bits // 64) * 64 or 64
        bits = np.zeros(size, bool)
        for level in range(1, int(top.max(initial=0)) + 1):
            own = keys[top >= level]
            for probe in range(PROBES):
                bits[cls.positions(own, level, probe, np.uint64(size)).astype(np.int64)] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Probes each key's levels until one is absent."""
        out, shard = np.zeros(len(keys), np.int64), shard_of(keys, len(self.size))  # one array takes every key
        keys, left, level = keys & self.mask, np.arange(len(keys)), 1
        while len(left):
            for probe in range(PROBES):
                s = shard[left]
                at = self.start[s] + self.positions(keys[left], level, probe, self.size[s])
                left = left[self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0]
            out[left] = level
            level += 1
        return out


def _counted(docs: DataFrame, shards: int) -> DataFrame:
    """(kind, shard, keys, counts): sorted distinct keys of what a task has read, cut at the shards' borders."""

    @tidy
    def run(batches):
        held: dict[int, list] = {_WORD: [], _PAIR: []}
        size = 0

        def rows():
            for kind, parts in held.items():
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                cut = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
                filled = [s for s in range(shards) if cut[s] < cut[s + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(filled), pa.int32()), pa.array(filled, pa.int32()), pa.array([pack(kind, keys[cut[s] : cut[s + 1]]) for s in filled], pa.binary()), pa.array([counts[cut[s] : cut[s + 1]].astype("<u4").tobytes() for s in filled], pa.binary())],
                    ["kind", "shard", "keys", "counts"],
                )

        for _, texts in pieces(batches):
            words, first = tokens(texts)
            held[_WORD].append(words)
            held[_PAIR].append(pairs(words, first)[1])
            size += len(words)
            if size >= COUNTED:
                yield from rows()
                held, size = {_WORD: [], _PAIR: []}, 0
        if size:
            yield from rows()

    return docs.select("text").mapInArrow(run, "kind int, shard int, keys binary, counts binary")


def _summed(key: tuple, part: pd.DataFrame, entry_bits: int = BITS) -> pd.DataFrame:
    """One shard: the counts of its keys, words only, and its filter."""
    kind, shard = key
    keys = np.concatenate([unpack(kind, x) for x in part["keys"]])
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in part["counts"]])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys, counts = keys[starts], np.add.reduceat(counts.astype(np.int64), starts)
    bits = Filter.build(kind, keys, counts, entry_bits)
    kept = (keys.tobytes(), counts.astype("<i8").tobytes()) if kind == _WORD else (b"", b"")
    return pd.DataFrame({"kind": [kind], "shard": [shard], "bits": [bits], "keys": [kept[0]], "counts": [kept[1]], "n": [int(counts.sum())], "v": [len(keys)]})


def train(docs: DataFrame, bits: int = BITS) -> tuple[DataFrame, int]:
    """The shards of counts and filters of (text), and their number: one shuffle of distinct keys of each task."""
    chars = docs.agg(F.sum(F.length("text"))).head()[0] or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(chars // SHARD_CHARS))
    summed = _counted(docs, shards).groupBy("kind", "shard").applyInPandas(lambda key, part: _summed(key, part, bits), "kind int, shard int, bits binary, keys binary, counts binary, n long, v long")
    return summed, shards


def _counts(model: DataFrame) -> DataFrame:
    """(key, c) of the training words."""

    def run(batches):
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, "<i8")), pa.array(np.frombuffer(counts, "<i8"))], ["key", "c"])

    return model.filter(f"kind = {_WORD}").select("keys", "counts").mapInArrow(run, "key long, c long")


def _head(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys (sorted) and counts of the words met ``least`` times or more, and the smallest ``least`` for which
    these are ``most`` at most; it comes from the numbers of words of each count."""
    steps = counts.groupBy(F.least("c", F.lit(1 << 20)).alias("c")).agg(F.count("*").alias("words"))
    fit = steps.withColumn("over", F.sum("words").over(Window.orderBy(F.col("c").desc()))).filter(F.col("over") <= most)
    least = fit.agg(F.min("c")).head()[0]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), 1 << 62
    head = counts.filter(F.col("c") >= least).toArrow()  # 16 bytes a word, never rows of objects
    keys = head["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], head["c"].to_numpy()[order], least


def _find(keys: np.ndarray, sought: np.ndarray) -> np.ndarray:
    """Indices of the sought in sorted keys, -1 where absent."""
    if not len(keys):
        return np.full(len(sought), -1)
    at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
    return np.where(keys[at] == sought, at, -1)


def _probability(pair, before, word, smooth: float, size: float):
    """Of the counts that levels stand for: the pair's share of its first word, mixed with the word's own."""
    shared = np.where(pair > 0, np.minimum(1.0, pair / np.maximum(before, 1.0)), 0.0)
    return PAIR_WEIGHT * shared + (1 - PAIR_WEIGHT) * (word + smooth) / size


def _scored(docs: DataFrame, model, head, n: int, v: int, smooth: float, with_score: bool) -> DataFrame:
    """One row per document: the score, the base sum over the head's words, and the other words' keys; ``uid`` is
    the row's place in its task's output. Without filters the first row of each block of documents has the block's
    words: their sorted hashes, the index of each token's, and the index of each document's first token."""
    size = max(n + smooth * (v + 1), 1e-300)

    @tidy
    def run(batches):
        filters, (keys, counts) = model.value if with_score else None, head.value
        uid = TaskContext.get().partitionId() << 40
        for batch, texts in pieces(batches):
            words, first = tokens(texts)
            own, inverse = np.unique(words, return_inverse=True)
            at = _find(keys, own)
            base = np.where(at >= 0, np.log10((counts[at] + smooth) / size), 0.0) if len(keys) else np.zeros(len(own))
            rare = at[inverse] < 0
            last = np.concatenate([first[1:], [len(words)]])
            before, both = pairs(words, first)
            columns = {
                "uid": pa.array(np.arange(uid, uid + len(batch))),
                "doc_id": batch.column(0),
                "held_out": batch.column(1),
                "n_tokens": pa.array((last - first).astype(np.int64)),
                "base": pa.array(np.add.reduceat(base[inverse], first)),
                "known": pa.array(np.add.reduceat((~rare).astype(np.int64), first)),
                "rare": pa.array([words[a:b][rare[a:b]].view(np.int64) for a, b in zip(first, last)], pa.list_(pa.int64())),
            }
            if with_score:
                count = count_of(_WORD, filters[_WORD].levels(own))
                behind = count[np.minimum(np.searchsorted(own, before), len(own) - 1)]
                p = _probability(count_of(_PAIR, filters[_PAIR].levels(both)), behind, count[inverse], smooth, size)
                columns["score"] = pa.array(np.add.reduceat(np.log10(p), first))
            else:
                rest = [None] * (len(batch) - 1)
                for name, array in (("own", own), ("tokens", inverse.astype("<i4")), ("first", first.astype("<i8"))):
                    columns[name] = pa.array([array.tobytes(), *rest], pa.binary())
            uid += len(batch)
            yield pa.RecordBatch.from_pydict(columns)

    schema = "uid long, doc_id long, held_out boolean, n_tokens long, base double, known long, rare array<long>, "
    return docs.mapInArrow(run, schema + ("score double" if with_score else "own binary, tokens binary, first binary"))


def _asked(blocks: DataFrame, shards: int) -> DataFrame:
    """(uid, kind, shard, keys): the sorted distinct keys of each block, cut at the shards' borders."""

    def run(batches):
        for batch in batches:
            for uid, *block in zip(*(c.to_pylist() for c in batch.columns)):
                own, tokens, first = (np.frombuffer(x, t) for x, t in zip(block, ("<u8", "<i4", "<i8")))
                for kind, keys in ((_WORD, own), (_PAIR, np.unique(pairs(own[tokens], first)[1]))):
                    cut = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
                    filled = [s for s in range(shards) if cut[s] < cut[s + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uid] * len(filled), pa.int64()), pa.array([kind] * len(filled), pa.int32()), pa.array(filled, pa.int32()), pa.array([pack(kind, keys[cut[s] : cut[s + 1]]) for s in filled], pa.binary())],
                        ["uid", "kind", "shard", "keys"],
                    )

    return blocks.mapInArrow(run, "uid long, kind int, shard int, keys binary")


def _answered(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """One shard: the level of each key that a block asks for, a byte each, in the order of the keys."""
    kind = int(left["kind"].iloc[0]) if len(left) else _WORD
    single = Filter([right["bits"].iloc[0]] if len(right) else [bytes(8)], kind)
    levels = [single.levels(unpack(kind, x)).astype(np.uint8).tobytes() for x in left["keys"]]
    return left[["uid", "kind", "shard"]].assign(levels=levels)


def _sharded_score(rows: DataFrame, model: DataFrame, shards: int, n: int, v: int, smooth: float) -> DataFrame:
    """(uid, score) with the filters left where they are: each shard answers the blocks' distinct keys."""
    size = max(n + smooth * (v + 1), 1e-300)
    blocks = rows.filter("own IS NOT NULL").select("uid", "own", "tokens", "first")
    at = ["kind", "shard"]
    levels = _asked(blocks, shards).groupBy(*at).cogroup(model.select(*at, "bits").groupBy(*at)).applyInPandas(_answered, "uid long, kind int, shard int, levels binary")
    levels, _ = save(levels, "lm-levels")

    def scores(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        own, tokens, first = (np.frombuffer(left[c].iloc[0], t) for c, t in (("own", "<u8"), ("tokens", "<i4"), ("first", "<i8")))
        right = right.sort_values("shard")  # ranges of keys in order: put together, the levels are in the keys' order
        word, pair = (count_of(kind, np.frombuffer(b"".join(right.loc[right["kind"] == kind, "levels"]), np.uint8).astype(np.int64)) for kind in (_WORD, _PAIR))
        before, both = pairs(own[tokens], first)
        p = _probability(pair[np.unique(both, return_inverse=True)[1]], word[np.searchsorted(own, before)], word[tokens], smooth, size)
        return pd.DataFrame({"uid": left["uid"].iloc[0] + np.arange(len(first)), "score": np.add.reduceat(np.log10(p), first)})

    return blocks.groupBy("uid").cogroup(levels.groupBy("uid")).applyInPandas(scores, "uid long, score double")


def score(docs: DataFrame, smooth: float = 0.1, max_filter_mb: float = MAX_FILTER_MB, head_words: int = HEAD_WORDS, bits: int = BITS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False)).alias("held_out"), "text")
    model, shards = train(docs.filter("NOT held_out").select("text"), bits)
    model, _ = save(model, "lm-shards")
    n, v, mb = model.agg(F.sum(F.when(F.col("kind") == _WORD, F.col("n"))), F.sum(F.when(F.col("kind") == _WORD, F.col("v"))), F.sum(F.length("bits")) / 1e6).head()
    n, v, mb = n or 0, v or 0, mb or 0
    counts, _ = save(_counts(model), "lm-counts")
    keys, head_counts, _ = _head(counts, head_words)
    head = spark.sparkContext.broadcast((keys, head_counts))
    fits = mb <= max_filter_mb
    filters = None
    if fits:
        arrays = {kind: [bytes(8)] * shards for kind in (_WORD, _PAIR)}
        for row in model.select("kind", "shard", "bits").toLocalIterator():
            arrays[row["kind"]][row["shard"]] = bytes(row["bits"])
        filters = spark.sparkContext.broadcast({kind: Filter(a, kind) for kind, a in arrays.items()})
    rows, _ = save(_scored(docs.withColumn("doc_id", F.col("doc_id").cast("long")), filters, head, n, v, smooth, fits), "lm-rows")
    size = F.lit(max(n + smooth * (v + 1), 1e-300))
    rare = rows.select("uid", F.explode("rare").alias("key")).join(counts.hint("merge"), "key", "left")
    c = F.coalesce("c", F.lit(0))
    rare = rare.groupBy("uid").agg(F.sum(F.log10((c + smooth) / size)).alias("rare_base"), F.sum(F.when(c > 0, 1).otherwise(0)).alias("rare_known"))
    out = rows.drop("rare", "own", "tokens", "first").join(rare.hint("merge"), "uid", "left")
    if not fits:
        out = out.join(_sharded_score(rows, model, shards, n, v, smooth), "uid")
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), "score",
    )
