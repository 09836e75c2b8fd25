"""Personal data: fixed rules, and a linear-chain conditional random field over word shapes.

The rules give the base spans. The field is trained on a small labelled table: ``labelled_lines``, lines with marked
spans of which the rules find none (addresses written apart, numbers with dots or brackets or without a plus, cards with a
digit misread) and lines that only look so, and a few lines of the corpus itself as the rules label them. A word scores by several
features of its shape and of its neighbours', so that forms outside the table are found by what they share with it. It learns which
shapes stand where, and adds spans that the rules miss; it takes none away. Lines are its sequences. Lines without a digit, ``@`` or ``+``
consist of one shape, and training proves from the weights whether such a line can only decode to nothing; then these
lines need no decoding.

Defined results: a null or empty text has no spans; texts are searched whole; positions are code points, the
end exclusive; spans that begin together stand in the order of their kinds; rows that repeat get equal spans each; an empty table gives an empty result; extra columns stay, and those named like a result column give way.
"""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .storage import save, tidy
from .text import pieces

KINDS = ("email", "ip", "card", "phone")
#: Documents (of this many characters at most) whose lines are in the training, words on either side of a word with a digit,
#: @ or + that are, and the length from which all shapes are one.
TRAIN_DOCS, TRAIN_CHARS, AROUND, LONG_SHAPE = 400, 20_000, 3, 40
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPECIAL = re.compile(r"[0-9@+]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SHAPES = ((re.compile(r"[^\W\d_]+"), "a"), (re.compile(r"[0-9]+"), lambda m: f"{min(len(m.group()), 12):x}"))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the rules, by start and kind."""
    if not _SPECIAL.search(text):
        return []
    found = list(_emails(text))
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 12 <= len(digits := re.sub(r"[^0-9]", "", m.group())) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def shape(word: str) -> str:
    """Letters as one a, digits by how many, the rest as it is; closing marks fall away; words without a digit,
    @ or + have one shape, and so have words whose shape is longer than LONG_SHAPE."""
    if not _SPECIAL.search(word):
        return "plain"
    word = word.strip(".,;:!?\"'")
    for pattern, to in _SHAPES:
        word = pattern.sub(to, word)
    return word if len(word) <= LONG_SHAPE else "long"


def features(shape: str) -> list[str]:
    """What a shape is made of, so that one that was not in the training scores by what it shares with those that were: its
    form without lengths, marks and how often each stands in it, digits and groups of digits by classes of number, the first and last group,
    and the classes of the ends."""
    if shape in ("plain", "long", ""):
        return [f"is {shape}"]
    groups = [int(x, 16) for x in re.findall("[0-9b-f]|(?<![a-z])a(?![a-z])", shape) if x != "a"]
    many = sum(groups)
    digits = next(i for i, top in enumerate((0, 2, 4, 6, 8, 11, 15, 19, 1 << 30)) if many <= top)
    marks = Counter(re.findall(r"[^0-9a-f]", shape))
    kind = lambda c: "digit" if c in "0123456789bcdef" else "letter" if c == "a" else c
    form = re.sub("[0-9b-f]", "9", shape)
    out = [f"form {form}", f"digits {digits}", f"groups {min(len(groups), 5)}", f"digits {digits} in {min(len(groups), 5)}", f"first {kind(shape[0])}", f"last {kind(shape[-1])}", f"length {min(len(shape), 12) // 3}"]
    out += [f"mark {c}" for c in marks] + [f"mark {c} {min(n, 4)}" for c, n in marks.items()] + [f"digits {digits} mark {c}" for c in marks]
    if groups:
        out += [f"first group {min(groups[0], 5)}", f"last group {min(groups[-1], 8)}", f"largest group {min(max(groups), 8)}"]
    return [*out, "letters" if "a" in shape else "no letters"]


class Field:
    """Label 0 is nothing, then KINDS. Scores: the features of a word's shape and of its neighbours', and label to label. A shape's score is
    the sum of its features' weights; it is kept in a row for each shape, of those met after the training too."""

    BORDER, OTHER, PLAIN = 0, 1, 2
    #: Rows kept at most.
    ROWS = 1 << 16

    def __init__(self, shapes: list[str]):
        self.ids = {"plain": self.PLAIN} | {s: i + 3 for i, s in enumerate(s for s in shapes if s != "plain")}
        n, k = len(self.ids) + 2, len(KINDS) + 1
        rows = [["border"], ["other"], *map(features, self.ids)]
        self.names = {f: i for i, f in enumerate(sorted({f for row in rows for f in row}))}
        self.made_of = np.zeros((n, len(self.names)))
        for i, row in enumerate(rows):
            self.made_of[i, [self.names[f] for f in row]] = 1
        self.weights = np.zeros((3, len(self.names), k))
        self.emit, self.move = np.zeros((3, n, k)), np.zeros((k, k))
        self.trained, self.fresh = n, []
        self.plain_is_nothing = False

    def encode(self, words: list[str]) -> list[int]:
        out = []
        for s in map(shape, words):
            if s not in self.ids:
                self.ids[s] = len(self.ids) + 2
                self.fresh.append(self.weights[:, [self.names[f] for f in features(s) if f in self.names]].sum(1))
            out.append(self.ids[s])
        return out

    def settle(self) -> None:
        """Puts the rows of new shapes behind the others'."""
        if self.fresh:
            self.emit, self.fresh = np.concatenate([self.emit, np.stack(self.fresh, 1)], 1), []

    def forget(self) -> None:
        """Drops the rows of shapes met after the training where they are many; ids given before are void then."""
        if len(self.ids) > self.ROWS:
            self.ids, self.emit, self.fresh = {s: i for s, i in self.ids.items() if i < self.trained}, self.emit[:, : self.trained], []

    @staticmethod
    def padded(sequences: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """(sequences, longest + 2) ids within borders, and the lengths."""
        lengths = np.array([len(s) for s in sequences])
        out = np.zeros((len(sequences), lengths.max() + 2), np.int64)
        for row, s in zip(out, sequences):
            row[1 : len(s) + 1] = s
        return out, lengths

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self.emit[0][x[:, 1:-1]] + self.emit[1][x[:, :-2]] + self.emit[2][x[:, 2:]]

    def fit(self, windows: dict[tuple, int], rounds: int = 150, ridge: float = 3e-2, rate: float = 0.2) -> None:
        """Gradient ascent (Adam) on the conditional likelihood of windows (the shape before, shapes, the shape behind,
        labels) with how often each occurs, by forward and backward sums over padded windows."""
        windows = dict(sorted(windows.items()))
        x, lengths = self.padded([w[1] for w in windows])
        for row, w in zip(x, windows):
            row[0], row[len(w[1]) + 1] = w[0], w[2]
        y = self.padded([w[3] for w in windows])[0][:, 1:-1]
        often = np.array(list(windows.values()), float)
        n, t, k = len(x), x.shape[1] - 2, len(self.move)
        inside = np.arange(t)[None, :] < lengths[:, None]
        each = often[:, None, None] * inside[..., None]
        gold = np.eye(k)[y] * each
        gold_move = np.einsum("nti,ntj->ij", np.eye(k)[y][:, :-1], (np.eye(k)[y] * each)[:, 1:])
        moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (self.weights, self.move)]
        total = max(1.0, float((often * lengths).sum()))

        def logsum(a, axis):
            top = a.max(axis, keepdims=True)
            return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)

        for step in range(1, rounds + 1):
            e = self.emissions(x)
            alpha, beta = np.empty((n, t, k)), np.zeros((n, t, k))
            alpha[:, 0] = e[:, 0]
            for i in range(1, t):
                new = logsum(alpha[:, i - 1, :, None] + self.move, 1) + e[:, i]
                alpha[:, i] = np.where(inside[:, i, None], new, alpha[:, i - 1])
            z = logsum(alpha[:, -1], 1)
            for i in range(t - 2, -1, -1):
                new = logsum(self.move[None] + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
                beta[:, i] = np.where(inside[:, i + 1, None], new, beta[:, i + 1])
            own = np.exp(alpha + beta - z[:, None, None]) * each
            expected_move = np.zeros((k, k))
            for i in range(1, t):
                joint = np.exp(alpha[:, i - 1, :, None] + self.move + (e[:, i] + beta[:, i])[:, None, :] - z[:, None, None])
                expected_move += (joint * each[:, i, :, None]).sum(0)
            d_emit = np.zeros_like(self.emit)
            for which, ids in enumerate((x[:, 1:-1], x[:, :-2], x[:, 2:])):
                np.add.at(d_emit[which], ids.reshape(-1), (gold - own).reshape(-1, k))
            d_weights = np.einsum("nf,wnk->wfk", self.made_of, d_emit)
            for w, d, (m, s) in ((self.weights, d_weights, moments[0]), (self.move, gold_move - expected_move, moments[1])):
                d = d / total - ridge * w / n
                m += 0.1 * (d - m)
                s += 0.01 * (d * d - s)
                w += rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-9)
            self.emit = np.einsum("nf,wfk->wnk", self.made_of, self.weights)
        self._prove()

    def _prove(self) -> None:
        """Whether any label in a line of plain words costs more than it can gain: the best emission and the best
        move into a word, against nothing all along, and the best move out."""
        around = [self.BORDER, self.PLAIN]
        gain = max(float((e := self.emit[0][self.PLAIN] + self.emit[1][a] + self.emit[2][b])[1:].max() - e[0]) for a in around for b in around)
        step = float(self.move.max() - self.move[0, 0])
        self.plain_is_nothing = gain + max(0.0, step) < 0 and gain + 2 * max(0.0, step) < 0

    def decode(self, sequences: list[list[int]]) -> list[np.ndarray]:
        """Viterbi over batches of lines of similar length."""
        self.settle()
        out: list = [None] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and to - at < 4096 and len(sequences[order[to]]) <= 2 * len(sequences[order[at]]) + 8 and (to - at + 1) * len(sequences[order[to]]) <= 1 << 20:
                to += 1
            x, lengths = self.padded([sequences[i] for i in order[at:to]])
            e = self.emissions(x)
            n, t, k = e.shape
            best, back = e[:, 0].copy(), np.zeros((n, t, k), np.int8)
            for i in range(1, t):
                options = best[:, :, None] + self.move
                back[:, i] = options.argmax(1)
                new = options.max(1) + e[:, i]
                on = (i < lengths)[:, None]
                back[:, i] = np.where(on, back[:, i], np.arange(k))
                best = np.where(on, new, best)
            path = np.empty((n, t), np.int64)
            path[:, -1] = best.argmax(1)
            for i in range(t - 1, 0, -1):
                path[:, i - 1] = np.take_along_axis(back[:, i], path[:, i, None], 1)[:, 0]
            for row, i, length in zip(path, order[at:to], lengths):
                out[i] = row[:length]
            at = to
        return out


def _lines(text: str):
    """(start, end) of the lines."""
    at = 0
    for line in text.split("\n"):
        yield at, at + len(line)
        at += len(line) + 1


#: The labelled table, as patterns: N is a digit, W a word, M one to nine digits, anything else itself. Spans of personal data as
#: people write them and the rules do not read them, and what looks like them and is none.
MARKED = {
    "email": ["W @ W.W.com", "WNN @ W.org", "W@ W.net", "W @W.de", "W.W @ W.com", "W_W @ W.W", "W.W@ W.W.uk", "WN @W.W.fr"],
    "phone": ["NNN.NNN.NNNN", "(NNN) NNN-NNNN", "NNN-NNN-NNNN", "0NN/NNN-NNNN", "00NN-NNN-NNNNNNN", "NNN/NNN/NNNN", "(NNN)NNN-NNNN", "(NNN) NNN.NNNN", "0NN-NNNN-NNNN", "0NNN.NNN.NNN", "0NNN/NNNNNN", "00NN.NNN.NNN.NNN", "NNN_NNN_NNNN", "NN-NN-NN-NN-NN", "(0NN) NNNN-NNNN", "0NNN-NNNNNN", "00NN/NNN/NNNNNN"],
    "card": ["NNNN-NNNN-NNNN-NNNN", "NNNN.NNNN.NNNN.NNNN", "NNNN/NNNN/NNNN/NNNN", "NNNN_NNNN_NNNN_NNNN", "NNNN-NNNNNN-NNNNN", "NNNN.NNNNNN.NNNNN"],
    "ip": ["NN.NNN.NN.x", "NNN.NN.*.*", "NNN.NNN.NN.x", "NNN.N.*.*", "NN.NN.NN.xx", "NNN.NNN.NNN.*", "N.NN.NNN.x", "NNN.NNN.N.?"],
}
LOOKS_LIKE = [
    "NNNN-NN-NN", "NN/NN/NNNN", "NN.NN.NNNN", "N.N.NN", "vN.N", "$NNN.NN", "NN%", "#NNNNNN", "M", "NN:NN", "(N)", "NNN-N-NN-NNNNNN-N", "N,NNN,NNN", "NNNN NNNN", "WNN", "@W", "W + W", "N + N", "W @ NN", "https://W.com/NNN?page=N", "NNNN-NNNN", "NN-NN", "NNN.NN", "(NNNN)",
    "NN/NN/NN", "N/N", "NN.N.NN", "NN:NN:NN", "N.NNN.NNN", "$N,NNN", "NN-W-NNNN", "W-NNNN", "(NN)", "@W_NN", "@NN", "NN_NN", "N-N", "NNN/NNN", "W.W", "vN.NN.N",
]


def labelled_lines(n: int = 24, seed: int = 7, marked: dict | None = None, looks_like: list | None = None) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Lines with their spans (kind, start, end): ``n`` of each pattern, filled by a seeded draw, between words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9)))
    some = lambda k=4: " ".join(word() for _ in range(rng.randint(1, k)))
    digit = lambda k=1: "".join(rng.choice("0123456789") for _ in range(k))
    filled = lambda pattern: re.sub("[NWM]", lambda m: digit() if m.group() == "N" else word() if m.group() == "W" else digit(rng.randint(1, 9)), pattern)
    out = []
    for kind, patterns in (MARKED if marked is None else marked).items():
        for pattern in patterns:
            for _ in range(n):
                while base_spans(line := (before := some() + " ") + (own := filled(pattern)) + rng.choice([" ", ", ", ". "]) + some()):
                    pass
                out.append((line, [(kind, len(before), len(before) + len(own))]))
    return out + [(f"{some()} {filled(pattern)} {some()}", []) for pattern in (LOOKS_LIKE if looks_like is None else looks_like) for _ in range(n)]


def windows(lines, field: Field) -> Counter:
    """Windows of (text, spans): runs of words with AROUND words on either side of those with a digit, @ or +, between the
    shapes that stand before and behind them; of words of one shape, three."""
    out: Counter = Counter({(Field.BORDER, (Field.PLAIN,) * 3, Field.BORDER, (0,) * 3): 1, (Field.PLAIN, (Field.PLAIN,) * 3, Field.PLAIN, (0,) * 3): 1})
    for text, spans in lines:
        tokens = list(_WORD.finditer(text))
        shapes = field.encode([m.group() for m in tokens])
        own = [next((1 + KINDS.index(k) for k, s, e in spans if m.start() < e and m.end() > s), 0) for m in tokens]
        near = sorted({j for i, s in enumerate(shapes) if s != Field.PLAIN or own[i] for j in range(max(0, i - AROUND), min(len(tokens), i + AROUND + 1))})
        i = 0
        while i < len(near):
            j = i
            while j + 1 < len(near) and near[j + 1] == near[j] + 1 and j - i < 40:
                j += 1
            a, b = near[i], near[j] + 1
            out[(shapes[a - 1] if a else Field.BORDER, tuple(shapes[a:b]), shapes[b] if b < len(tokens) else Field.BORDER, tuple(own[a:b]))] += 1
            i = j + 1
    return out


def train(texts: list[str], table: list | None = None) -> Field:
    """A field from the labelled table and from the lines of a few texts, labelled by the rules."""
    lines = list(labelled_lines() if table is None else table)
    for text in texts:
        spans = base_spans(text)
        for a, b in _lines(text):
            if _SPECIAL.search(text, a, b):
                lines.append((text[a:b], [(k, s - a, e - a) for k, s, e in spans if s < b and e > a]))
    field = Field(sorted({shape(m.group()) for line, _ in lines for m in _WORD.finditer(line)}))
    field.fit(windows(lines, field))
    return field


def _added(texts: list[str], base: list[list], field: Field) -> list[list[tuple[str, int, int]]]:
    """Spans of the field that meet none of the rules'."""
    field.forget()
    at, sequences = [], []
    for i, text in enumerate(texts):
        if field.plain_is_nothing and not _SPECIAL.search(text):
            continue
        for a, b in _lines(text):
            if field.plain_is_nothing and not _SPECIAL.search(text, a, b):
                continue
            if words := list(_WORD.finditer(text, a, b)):
                at.append((i, words))
                sequences.append(field.encode([m.group() for m in words]))
    out: list[list] = [[] for _ in texts]
    for (i, words), labels in zip(at, field.decode(sequences) if sequences else []):
        k = 0
        while labels.any() and k < len(labels):
            j = k + 1
            while j < len(labels) and labels[j] == labels[k]:
                j += 1
            if labels[k]:
                s, e = words[k].start(), words[j - 1].end()
                while s < e and texts[i][s] in ".,;:!?\"'":
                    s += 1
                while e > s and texts[i][e - 1] in ".,;:!?\"'":
                    e -= 1
                if s < e and all(e <= x or s >= y for _, x, y in base[i]):
                    out[i].append((KINDS[labels[k] - 1], s, e))
            k = j
    return out


_SPAN = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def training_texts(docs: DataFrame, text: str = "text") -> list[str]:
    """At most TRAIN_DOCS different whole texts with something to label, smallest hashes first. The hashes are
    chosen before any text is sent, so that tasks send numbers, and only the chosen texts come to the driver."""
    some = docs.select(F.col(text).alias("t")).filter(F.col("t").rlike("[0-9]{4}|@|[0-9][.][0-9]") & (F.length("t") <= TRAIN_CHARS)).withColumn("h", F.xxhash64("t"))
    chosen = sorted(r[0] for r in save(some.select("h").distinct().orderBy("h").limit(TRAIN_DOCS), "training")[0].collect())
    if not chosen:
        return []
    return [r["t"] for r in some.filter(F.col("h") <= chosen[-1]).distinct().orderBy("h", "t").collect()]


def find(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """Adds ``base_spans`` and ``spans`` (base and added), arrays of (kind, start, end) by start and kind, in
    one pass without a shuffle; trains a field on ``docs`` if none is given."""
    field = field or train(training_texts(docs, text))
    docs = docs.drop("base_spans", "spans")
    model = docs.sparkSession.sparkContext.broadcast(field)

    @tidy
    def run(batches):
        own = model.value
        for batch, texts in pieces(batches, text):
            texts = texts.to_pylist()
            base = [base_spans(t) for t in texts]
            more = _added(texts, base, own) if own else [[]] * len(texts)
            both = [sorted([*b, *m], key=lambda s: (s[1], KINDS.index(s[0]))) if m else b for b, m in zip(base, more)]
            columns = [pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in x], _ARROW_SPAN) for x in (base, both)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "base_spans", "spans"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("base_spans", _SPAN), StructField("spans", _SPAN)]))


def joined(spans: str):
    """A column of spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def number(kind: str):
    return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
