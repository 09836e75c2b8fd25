"""Token ids in binary files: patched frame-of-reference blocks.

Documents are dealt by ranges of doc_id and sorted, so that the files hold the ids in ascending order of
doc_id. A file is a row of a Parquet table (Spark's own writer commits it, whatever executor is lost): the
documents it holds, their lengths, and their ids as one payload. Of each block of a payload the minimum is
taken away; what is left is packed in the width of its 90th percentile, and the values that are wider stand
in an exception list. An index of block starts lets a reader open a single block.

Defined results: a null or empty text has only the end id; rows that share a doc_id follow each other,
ordered by text, and rows without doc_id come first; an empty table gives no files.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import save, tidy
from .text import pieces

BLOCK, PERCENTILE, FILE_IDS = 1024, 0.9, 1 << 17
_FILES = "part int, file int, doc_ids array<long>, lengths array<long>, n_ids long, payload binary"
_LANES = 64


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64 values of ``width`` bits as rows of ``width`` 64-bit words."""
    out = np.zeros((len(values), width), np.uint64)
    for i in range(_LANES if width else 0):
        word, shift = divmod(i * width, 64)
        out[:, word] |= values[:, i] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= values[:, i] >> np.uint64(64 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.empty((len(words), _LANES), np.uint64)
    for i in range(_LANES):
        word, shift = divmod(i * width, 64)
        out[:, i] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            out[:, i] |= words[:, word + 1] << np.uint64(64 - shift)
    return out & np.uint64((1 << width) - 1)


def encode_ids(ids: np.ndarray) -> bytes:
    """Unsigned 32-bit ids as a payload: number of ids and blocks; of each block its minimum, width, number of
    exceptions and start; then the blocks, each its packed values, exception positions and exception values."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return np.array([0, 0], "<u4").tobytes()
    rows = np.concatenate([ids, np.full(blocks * BLOCK - n, ids[-1])]).astype(np.uint64).reshape(blocks, BLOCK)
    low = rows.min(1)
    rows = rows - low[:, None]
    width = np.searchsorted(np.uint64(1) << np.arange(33, dtype=np.uint64), np.partition(rows, int(PERCENTILE * BLOCK), 1)[:, int(PERCENTILE * BLOCK)], "right")
    wide = rows >> width[:, None].astype(np.uint64) > 0
    packed: list = [b""] * blocks
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        words = _pack((rows[at] & np.uint64((1 << w) - 1)).reshape(-1, _LANES), w).astype("<u8").reshape(len(at), -1)
        for k, b in enumerate(at.tolist()):
            where = np.flatnonzero(wide[b])
            packed[b] = words[k].tobytes() + where.astype("<u2").tobytes() + rows[b, where].astype("<u4").tobytes()
    starts = np.cumsum([0, *map(len, packed[:-1])])
    head = np.stack([low, width, wide.sum(1), starts], 1).astype("<u4").tobytes()
    return np.array([n, blocks], "<u4").tobytes() + head + b"".join(packed)


def _head(payload: bytes) -> tuple[int, np.ndarray, int]:
    n, blocks = np.frombuffer(payload, "<u4", 2).tolist()
    return n, np.frombuffer(payload, "<u4", 4 * blocks, 8).reshape(blocks, 4), 8 + 16 * blocks


def decode_block(payload: bytes, block: int) -> np.ndarray:
    """The ids of one block, found by the index; the rest of the payload is not read."""
    n, head, body = _head(payload)
    low, width, n_wide, start = head[block].tolist()
    at = body + start
    values = _unpack(np.frombuffer(payload, "<u8", BLOCK // _LANES * width, at).reshape(-1, width), width).reshape(-1) if width else np.zeros(BLOCK, np.uint64)
    at += BLOCK // 8 * width
    values[np.frombuffer(payload, "<u2", n_wide, at)] = np.frombuffer(payload, "<u4", n_wide, at + 2 * n_wide)
    return (values + np.uint64(low)).astype(np.uint32)[: n - block * BLOCK]


def decode_ids(payload: bytes) -> np.ndarray:
    """All ids of a payload; the blocks of one width are unpacked together."""
    n, head, body = _head(payload)
    out = np.zeros((len(head), BLOCK), np.uint64)
    for w in np.unique(head[:, 1]).tolist():
        at = np.flatnonzero(head[:, 1] == w)
        if w:
            words = np.stack([np.frombuffer(payload, "<u8", BLOCK // _LANES * w, body + int(head[b, 3])) for b in at])
            out[at] = _unpack(words.reshape(-1, w), w).reshape(len(at), BLOCK)
    for b in np.flatnonzero(head[:, 2]).tolist():
        _, w, n_wide, start = head[b].tolist()
        at = body + start + BLOCK // 8 * w
        out[b, np.frombuffer(payload, "<u2", n_wide, at)] = np.frombuffer(payload, "<u4", n_wide, at + 2 * n_wide)
    return (out + head[:, :1]).astype(np.uint32).reshape(-1)[:n]


def _without_normalizer(path: str) -> str:
    """The tokenizer's file for text that is composed and lower-cased already."""
    with open(path, encoding="utf-8") as f:
        return json.dumps(json.load(f) | {"normalizer": None})


class Encoder:
    """Texts to ids. The tokenizer composes and lower-cases, drops white space, and cuts what is left into letters,
    single digits and other marks before its merges, so the ids of a text are those of its words one after the
    other. Words that have been met are kept; the new words of many texts are given to the tokenizer together, joined by
    blanks and without its first two steps, which are done already, and its tokens that end a piece say which ids are whose."""

    MAX_WORDS, LONG_WORD, TOGETHER = 300_000, 48, 256
    #: Below U+0300 nothing composes, so there capitals may be folded first.
    _BEYOND = r"[^\x00-\x{2ff}]"
    #: Words of marks, digits and letters for which lower-casing and the cut do not depend on the Unicode version.
    _PLAIN = re.compile(r"[!-~¡-įı-ʯ]+")
    #: The tokenizer's own cut.
    _CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.lowered = Tokenizer.from_file(path), Tokenizer.from_str(_without_normalizer(path))
        for t in (self.tokenizer, self.lowered):
            t.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # words of the last but one filling

    def _encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        plain, counts, alone = [], [], []
        for w in words:
            if w.isalpha():  # A-Z and a-z alone
                plain.append(w)
                counts.append(1)
            elif self._PLAIN.fullmatch(text := w.decode()):
                plain.append(w)
                counts.append(len(self._CUT.findall(text.lower())))
            else:
                alone.append(w)
        for i in range(0, len(plain), self.TOGETHER):
            some = plain[i : i + self.TOGETHER]
            e = self.lowered.encode_batch_fast([b" ".join(some).decode().lower()], add_special_tokens=False)[0]
            ids = np.array(e.ids, "<u4")
            cuts = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])[np.cumsum([0, *counts[i : i + self.TOGETHER]])] * 4
            ids = ids.tobytes()
            out.update((w, ids[a:b]) for w, a, b in zip(some, cuts[:-1].tolist(), cuts[1:].tolist()))
        for i in range(0, len(alone), self.TOGETHER):
            some = alone[i : i + self.TOGETHER]
            for w, e in zip(some, self.tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)):
                out[w] = np.array(e.ids, "<u4").tobytes()
        return out

    def ids(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text. Words are cut and numbered by Arrow, each distinct one is looked up once, and the
        ids of all words are gathered at once."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts
        if len(self.words) > self.MAX_WORDS:
            self.words, self.older = {}, self.words
        beyond = pc.match_substring_regex(texts, self._BEYOND)
        cut = pc.ascii_split_whitespace(pc.if_else(beyond, texts, pc.ascii_lower(texts)))  # other blanks are left to the tokenizer
        coded = cut.flatten().dictionary_encode()
        distinct, codes = coded.dictionary.cast(pa.large_binary()).to_pylist(), coded.indices.to_numpy()
        new = [w for w in distinct if w not in self.words]
        self.words.update((w, self.older[w]) for w in new if w in self.older)
        self.words.update(self._encoded([w for w in new if w not in self.older]))
        made = [self.words[w] for w in distinct]
        for w in new:
            if len(w) > self.LONG_WORD:
                del self.words[w]
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        first, every = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(made), "<u4")
        n = sizes[codes]
        upto = np.concatenate([[0], np.cumsum(n)])
        out = every[np.repeat(first[codes] - upto[:-1], n) + np.arange(upto[-1])].tobytes()
        ends = (4 * upto[cut.offsets.to_numpy() - cut.offsets[0].as_py()]).tolist()
        return [out[a:b] for a, b in zip(ends[:-1], ends[1:])]


@lru_cache(1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Encodes (doc_id, text), each text followed by ``end_id``, and writes the files: one shuffle of the texts,
    by range. A file is closed after the document with which it reaches FILE_IDS ids. Returns the files' table."""
    end = np.array([end_id], "<u4").tobytes()

    @tidy
    def files(batches):
        own, part, number = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        docs_in, lengths, ids, held = [], [], [], 0

        def closed():
            all_ids = np.frombuffer(b"".join(ids), "<u4")
            row = {"part": [part], "file": [number], "doc_ids": [docs_in], "lengths": [lengths], "n_ids": [len(all_ids)], "payload": [encode_ids(all_ids)]}
            return pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), ("file", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("payload", pa.binary())]))

        gc.disable()  # nothing here is garbage in circles, and the collector would walk all known words
        try:
            for batch, texts in pieces(batches):
                for doc, made in zip(batch.column(0).to_pylist(), own.ids(texts)):
                    docs_in.append(doc)
                    ids.append(made + end)
                    lengths.append(len(ids[-1]) // 4)
                    held += lengths[-1]
                    if held >= FILE_IDS:
                        yield closed()
                        number += 1
                        docs_in, lengths, ids, held = [], [], [], 0
            if docs_in:
                yield closed()
        finally:
            gc.enable()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return save(ordered.mapInArrow(files, _FILES), "token-files")[0]


def starts(files: DataFrame) -> DataFrame:
    """(part, file, first): ids in all files before this one. Sums run within parts, and over one row per part."""
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    own = files.select("part", "file", "n_ids", F.sum("n_ids").over(Window.partitionBy("part").orderBy("file")).alias("upto"))
    return own.join(before, "part").select("part", "file", (F.col("before") + F.col("upto") - F.col("n_ids")).alias("first"))


def read(files: DataFrame, crc_only: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32, and unless ``crc_only`` ids."""

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, at = decode_ids(row["payload"]).astype("<u4"), np.cumsum([0, *row["lengths"]])
                cut = [ids[a:b] for a, b in zip(at[:-1], at[1:])]
                columns = {"doc_id": pa.array(row["doc_ids"], pa.int64()), "start": pa.array(at[:-1] + row["first"], pa.int64()), "n_tokens": pa.array(row["lengths"], pa.int64()), "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in cut], pa.int64())}
                if not crc_only:
                    columns["ids"] = pa.array([x.astype(np.int32) for x in cut], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ("" if crc_only else ", ids array<int>")
    return files.join(starts(files), ["part", "file"]).select("doc_ids", "lengths", "payload", "first").mapInArrow(documents, schema)
