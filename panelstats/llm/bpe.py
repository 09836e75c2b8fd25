"""Byte-level BPE: encoding by a lazily determinised transducer, and streaming decoding.

The merges are never replayed over a text. BPE of a prefix ends in exactly one token, the one whose pair
with the last token of what stands before it is itself stable under the merges; so the last tokens of all
prefixes follow from left to right. A state of the transducer is the last token already emitted and the
bytes read since; a step adds a byte, and emits the tokens on which all prefixes that a longer token could
still start from agree. Only those undecided bytes stay, fewer than a few tokens. States and steps are
made when first met, and dropped together when they are too many.

Defined results: a null or empty text has no ids; texts are encoded whole, whatever their length; a repeated row is
encoded as often as it occurs; extra columns stay, and those named like a result column give way to it; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import codecs
import gc
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from .storage import tidy
from .text import pieces

#: Cached stretches and pieces (twice as many while one filling gives way to the next), states and pairs at most,
#: in each Python worker, for each unit of ``cache``: about 150 MB. A larger cache only saves time.
MAX_UNITS, MAX_PIECES, MAX_STATES, MAX_PAIRS, LONG_UNIT = 60_000, 120_000, 30_000, 200_000, 48


_NEVER = 1 << 60


class _State:
    """``last``: the last token of each prefix of ``pending``; ``node``: the longest end of it that begins a token."""

    __slots__ = ("before", "pending", "last", "node", "steps")

    def __init__(self, before: int, pending: bytes, last: list, node: int):
        self.before, self.pending, self.last, self.node = before, pending, last, node
        self.steps: dict[int, tuple[_State, tuple[int, ...]] | None] = {}


class Transducer:
    """Maps the bytes of one piece to token ids."""

    def __init__(self, ranks: dict[bytes, int], cache: int = 1):
        self.ranks, self.cache = ranks, cache
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.length = {v: len(k) for k, v in ranks.items()}
        #: A trie of the tokens; ``goto`` also gets the steps by way of shorter ends, when they are met.
        self.goto: dict[int, int] = {}
        self.token, self.depth, above = [-1], [0], [(0, 0)]
        for text, rank in ranks.items():
            node = 0
            for byte in text:
                to = self.goto.setdefault(node << 8 | byte, len(self.token))
                if to == len(self.token):
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    above.append((node, byte))
                node = to
            self.token[node] = rank
        self.leaf = bytearray(b"\1" * len(self.token))
        for parent, _ in above:
            self.leaf[parent] = 0
        self.shorter = [0] * len(self.token)  # the node of the longest proper end that begins a token
        for node in sorted(range(1, len(above)), key=self.depth.__getitem__):
            parent, byte = above[node]
            if parent:
                self.shorter[node] = self._go(self.shorter[parent], byte, False)
        self.ending: dict[int, tuple[tuple[int, int], ...]] = {}
        self.pairs: dict[int, bool] = {}
        self._reset()

    def _go(self, node: int, byte: int, keep: bool = True) -> int:
        at = node
        while (to := self.goto.get(at << 8 | byte)) is None:
            if not at:
                return 0
            at = self.shorter[at]
        if keep:
            self.goto[node << 8 | byte] = to
        return to

    def _reset(self) -> None:
        for state in getattr(self, "states", {}).values():  # steps lead in circles, and the collector is off
            state.steps.clear()
        self.root = _State(-1, b"", [None], 0)
        self.states = {(-1, b""): self.root}

    def merged(self, piece: bytes) -> list[int]:
        """The merges themselves, for pieces of one or two tokens."""
        rank_of = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = [rank_of(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < _NEVER:
            i = ranks.index(least)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(parts[i] + parts[i + 1], _NEVER)
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] + parts[i], _NEVER)
        return [self.ranks[p] for p in parts]

    def _stable(self, before: int, token: int) -> bool:
        if len(self.pairs) >= MAX_PAIRS * self.cache:
            self.pairs.clear()
        ok = self.pairs[before << 20 | token] = self.merged(self.bytes_of[before] + self.bytes_of[token]) == [before, token]
        return ok

    def _tokens(self, node: int) -> tuple[tuple[int, int], ...]:
        """(token, length) of the tokens that end here, longest first, if the merges of their own bytes give them."""
        found, at = [], node
        while at:
            token = self.token[at]
            if token >= 0 and self.merged(self.bytes_of[token]) == [token]:
                found.append((token, self.length[token]))
            at = self.shorter[at]
        self.ending[node] = out = tuple(found)
        return out

    def _ends(self, last: list, end: int) -> list[int]:
        """Ends of the tokens of the prefix of length ``end``, falling to 0."""
        ends = [end]
        while end:
            end -= self.length[last[end]]
            ends.append(end)
        return ends

    def _read(self, before: int, last: list, node: int, text: bytes) -> int:
        """Appends to ``last`` the token that ends with each byte, and gives the node reached."""
        goto, ending, pairs = self.goto, self.ending, self.pairs
        n = len(last)
        for byte in text:
            to = goto.get(node << 8 | byte)
            node = self._go(node, byte) if to is None else to
            tokens = ending.get(node)
            for token, length in self._tokens(node) if tokens is None else tokens:
                prior = last[n - length] if n > length else before
                if prior < 0:
                    break
                ok = pairs.get(prior << 20 | token)
                if ok or (ok is None and self._stable(prior, token)):
                    break
            last.append(token)
            n += 1
        return node

    def _finish(self, state: _State, rest: bytes) -> list[int]:
        """The tokens from a state to the end, without making states."""
        last = [*state.last]
        self._read(state.before, last, state.node, rest)
        end, back = len(last) - 1, []
        while end:
            back.append(last[end])
            end -= self.length[last[end]]
        return back[::-1]

    def _step(self, state: _State, byte: int) -> tuple[_State, tuple[int, ...]]:
        last = [*state.last]
        node = self._read(state.before, last, state.node, bytes((byte,)))
        n, live, at = len(last) - 1, [], node
        while at:  # where a token that is still being read may have begun
            if not self.leaf[at]:
                live.append(n - self.depth[at])
            at = self.shorter[at]
        live.append(n)
        pending, before, emitted = state.pending + bytes((byte,)), state.before, ()
        if live[0]:  # no token can still begin at 0
            cut = end = live[0] if len(live) == 1 else max(set(self._ends(last, live[0])).intersection(*[self._ends(last, i) for i in live[1:]]))
            if cut:
                back = []
                while end:
                    back.append(last[end])
                    end -= self.length[last[end]]
                before, emitted = back[0], tuple(back[::-1])
                pending, last = pending[cut:], [None, *last[cut + 1 :]]
        key = (before, pending)
        if (to := self.states.get(key)) is None:
            if len(self.states) >= MAX_STATES * self.cache:
                self._reset()
            to = self.states[key] = _State(before, pending, last, node)
        made = state.steps[byte] = (to, emitted)
        return made

    def encode(self, piece: bytes) -> list[int]:
        """A step that is met for the first time is only marked, and the rest of the piece read without it."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        state, ids = self.root, []
        for i, byte in enumerate(piece):
            step = state.steps.get(byte, 0)
            if not step:
                if step == 0:
                    state.steps[byte] = None
                    return ids + self._finish(state, piece[i:])
                step = self._step(state, byte)
            state, emitted = step
            if emitted:
                ids += emitted
        return ids + self._finish(state, b"")


class _Known(dict):
    """Ids (little-endian 32-bit) by text; the texts of the last but one filling stay at hand."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.get(text)
        if ids is None:
            ids = self.make(text)
            if len(text) > LONG_UNIT:
                return ids
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[text] = ids
        return ids


class Encoder:
    """Texts to ids, by the stretches between spaces and line ends, which are kept when met."""

    #: Where blanks stand together a piece can span them: such texts are cut by the pattern alone, at spaces or
    #: at line ends.
    _NO_SPACE_CUT = regex.compile(r"\s (?:\s|\Z)")
    _NO_LINE_CUT = regex.compile(r"\s\n|\n(?:\s|\Z)|\s\Z")

    def __init__(self, ranks_path: str, pattern: str, cache: int = 1):
        with open(ranks_path, "rb") as f:
            transducer = Transducer({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, cache)
        packed = {i: i.to_bytes(4, "little") for i in transducer.bytes_of}
        self.cut = cut = regex.compile(pattern).findall
        self.pieces = _Known(lambda piece: b"".join(map(packed.__getitem__, transducer.encode(piece.encode()))), MAX_PIECES * cache)
        piece = self.pieces.__getitem__

        def after_space(unit: str) -> bytes:
            """Letters, and letters with closing marks, need no pattern."""
            if unit.isalpha():
                return piece(" " + unit)
            core = unit.rstrip(".,;:!?")
            if core.isalpha():
                return piece(" " + core) + piece(unit[len(core) :])
            return b"".join(map(piece, cut(" " + unit)))

        self.first = _Known(lambda unit: b"".join(map(piece, cut(unit))), MAX_UNITS * cache)
        self.spaced = _Known(after_space, MAX_UNITS * cache)
        self.transducer = transducer

    def _line(self, line: str) -> bytes:
        first, *others = line.split(" ")
        return self.first[first] + b"".join(map(self.spaced.__getitem__, others))

    def ids(self, text: str) -> bytes:
        if self._NO_SPACE_CUT.search(text):
            return b"".join(map(self.pieces.__getitem__, self.cut(text)))
        if "\n" not in text or self._NO_LINE_CUT.search(text):
            return self._line(text)
        return self.pieces["\n"].join(map(self._line, text.split("\n")))


class Decoder:
    """Ids to bytes and text, in chunks."""

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as f:
            self.bytes_of = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}

    def stream(self, ids: bytes, chunk: int = 1 << 14) -> Iterator[str]:
        """Text as it becomes complete: an incremental UTF-8 state machine keeps a code point that the
        ids read so far have only begun; malformed bytes become U+FFFD."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        values = np.frombuffer(ids, "<u4")
        for i in range(0, len(values), chunk):
            yield machine.decode(b"".join(map(self.bytes_of.__getitem__, values[i : i + chunk].tolist())))
        yield machine.decode(b"", True)


@lru_cache(1)
def encoder(ranks_path: str, pattern: str, cache: int = 1) -> Encoder:
    """One for each Python worker."""
    return Encoder(ranks_path, pattern, cache)


@lru_cache(1)
def decoder(ranks_path: str) -> Decoder:
    return Decoder(ranks_path)


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in names], *columns.values()], [*names, *columns])


def encode(docs: DataFrame, ranks_path: str, pattern: str, decoded: str | None = None, cache: int = 1) -> DataFrame:
    """Adds ``ids``, the token ids of each text as little-endian unsigned 32-bit integers in a binary, in one
    pass without a shuffle, and with ``decoded`` a column of that name with their text, from the same pass.
    Extra columns stay; those named like a result column give way."""

    @tidy
    def run(batches):
        own, back = encoder(ranks_path, pattern, cache), decoder(ranks_path)
        gc.disable()  # it would walk all states again and again, and there is no garbage in circles
        try:
            for batch, texts in pieces(batches):
                ids = [own.ids(t) for t in texts.to_pylist()]
                more = {decoded: pa.array(["".join(back.stream(x)) for x in ids], pa.string())} if decoded else {}
                yield _with(batch, ids=pa.array(ids, pa.binary()), **more)
        finally:
            gc.enable()

    added = [StructField("ids", BinaryType())] + ([StructField(decoded, StringType())] if decoded else [])
    docs = docs.drop(*[f.name for f in added])
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added]))


def decode(rows: DataFrame, ranks_path: str, to: str = "decoded") -> DataFrame:
    """Adds the text of ``ids`` as column ``to``; a null gives an empty text."""

    def run(batches):
        own = decoder(ranks_path)
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.slice(i, 256)
                ids = part.column(part.schema.get_field_index("ids")).to_pylist()
                yield _with(part, **{to: pa.array(["".join(own.stream(x or b"")) for x in ids], pa.string())})

    rows = rows.drop(to)
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(to, StringType())]))


def digests() -> list:
    """n_tokens, ids_sha256 and decoded_sha256 of encoded and decoded rows."""
    return [(F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")]
