"""Quality classifier by co-training.

Two views of each document: its text (ratios of symbols, capitals, repeated words and lines and so on) and
its page metadata (language, source, recorded length); they share no feature. Logistic classifiers are fitted on a bounded sample of
labelled rows; in each round either view hands its judgements on all unlabelled documents to the other, where its
calibration puts them beyond ``confident``. They replace those of the round before; a view that was not fitted anew
has nothing new to hand over. The handed documents are reduced to distinct feature vectors with their
numbers, which stay in Spark: each Newton step sums its terms over them, and only the sums reach the driver. In the
end the calibrated views are added up as log-odds, and every document is scored by column expressions.

Defined results: a null or empty text has zeros for its ratios; null language or source is a value of its
own; labels that repeat count by the smallest; with labels of one class only, or none, every score is the
share of good labels (1 without labels); a text of any length counts whole; ties of hashes in the sample go by doc_id;
repeated rows are scored alike; other columns of any name are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import drop, save

#: Labelled rows used at most, rounds, and the calibrated probability from which a view hands its judgements over.
MAX_LABELLED, ROUNDS, CONFIDENT = 20_000, 3, 0.95
#: Tasks that add up what the others have summed.
_SUMS = 8
_BUCKETS, _POWERS = {"lang": 8, "source": 32}, 17


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def text_view() -> list[Column]:
    t = F.coalesce(F.col("text"), F.lit(""))
    count = lambda pattern: F.regexp_count(t, F.lit(pattern))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x != "")
    chars = F.length(t)
    return [
        _share(count(r"[#*$%&|<>]"), F.size(words)), _share(count(r"\p{Lu}"), chars), _share(count("[0-9]"), chars),
        _share(count("[!?]"), F.size(words)), _share(count(r"\|"), F.size(words)), _share(chars, F.size(words)), _share(F.size(F.array_distinct(words)), F.size(words)),
        _share(F.size(F.array_distinct(lines)), F.size(lines)), _share(F.size(lines), F.size(words)), _share(count(r"[.](?:\n|$)"), F.size(lines)), _share(count(r"[,;]"), F.size(words)),
    ]


def metadata_view(columns: list[str]) -> list[Column]:
    """What is known of the page without its text: language, source, and the recorded length in powers of two (the
    text's own only where ``n_chars`` is no column)."""
    hot = [F.when(F.pmod(F.xxhash64(F.coalesce(F.col(c), F.lit("?"))), F.lit(k)) == i, 1.0).otherwise(0.0) for c, k in _BUCKETS.items() for i in range(k)]
    n = (F.col("n_chars") if "n_chars" in columns else F.length("text")).cast("double")
    power = F.coalesce(F.least(F.floor(F.log2(F.greatest(n, F.lit(0.0)) + 1)), F.lit(_POWERS)), F.lit(-1))
    return [*hot, *[F.when(power == i, 1.0).otherwise(0.0) for i in range(-1, _POWERS + 1)]]


def _summed(terms: Callable, x: np.ndarray, y: np.ndarray, handed: DataFrame | None) -> np.ndarray:
    """``terms`` (an array of sums) of the rows x, y and of ``handed`` (x, y, n: how often), added up by Spark."""
    total = terms(x, y, np.ones(len(x)))
    if handed is None:
        return total

    def run(batches):
        part = 0.0
        for batch in batches:
            if batch.num_rows:
                part = part + terms(batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1), batch.column(1).to_numpy(), batch.column(2).to_numpy())
        if np.ndim(part):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % _SUMS], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["at", "v"])

    def added(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"v": [sum(np.frombuffer(v) for v in part["v"]).tobytes()]})

    parts = handed.select("x", "y", "n").mapInArrow(run, "at int, v binary").groupBy("at").applyInPandas(added, "v binary").collect()
    return total + sum(np.frombuffer(r["v"]) for r in parts)


class Logistic:
    """Ridge logistic regression by Newton steps; classes weigh alike."""

    def fit(self, x: np.ndarray, y: np.ndarray, handed: DataFrame | None = None, ridge: float = 1.0) -> Logistic:
        k, base = x.shape[1], x.mean(0)
        sums = _summed(lambda x, y, n: np.r_[n.sum(), n @ y, n @ (x - base), n @ (x - base) ** 2], x, y, handed)
        good, off, square = sums[1] / sums[0], sums[2 : k + 2] / sums[0], sums[k + 2 :] / sums[0]
        mean, scale = base + off, np.sqrt(np.maximum(square - off**2, 0.0)) + 1e-9
        w = np.zeros(k + 1)
        keep = ridge * np.r_[0.0, np.ones(k)]

        def terms(x, y, n):
            z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
            weight = n * np.where(y > 0, 0.5 / max(good, 1e-9), 0.5 / max(1 - good, 1e-9))
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            return np.r_[z.T @ (weight * (y - p)), ((z * (weight * p * (1 - p))[:, None]).T @ z).ravel()]

        for _ in range(25):
            sums = _summed(terms, x, y, handed)
            step = np.linalg.solve(sums[k + 1 :].reshape(k + 1, k + 1) + np.diag(keep + 1e-9), sums[: k + 1] - keep * w)
            w = w + step
            if np.abs(step).max() < 1e-8:
                break
        self.w = w[1:] / scale
        self.b = float(w[0] - self.w @ mean)
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w + self.b


class View(Logistic):
    """A classifier with a calibration of its logit, a * logit + b, on rows kept apart."""

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> View:
        s = self.logit(x)
        a, b = 0.0, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
            v = p * (1 - p)
            h = np.array([[(v * s * s).sum() + 1e-3, (v * s).sum()], [(v * s).sum(), v.sum() + 1e-3]])
            step = np.linalg.solve(h, [((y - p) * s).sum() - 1e-3 * a, (y - p).sum()])
            size = np.abs(step).max()
            a, b = a + step[0] / max(1.0, size), b + step[1] / max(1.0, size)
            if size < 1e-8:
                break
        self.a, self.off = max(0.0, float(a)), float(b)
        return self

    def column(self, features: str) -> Column:
        """The calibrated log-odds."""
        total = F.lit(self.b)
        for i, w in enumerate(self.w.tolist()):
            total = total + F.col(features)[i] * F.lit(w)
        return F.lit(self.a) * total + F.lit(self.off)


def score(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, max_labelled: int = MAX_LABELLED, confident: float = CONFIDENT, exchanged: list | None = None) -> DataFrame:
    """(doc_id, labelled, p_text, p_metadata, score, kept) of every row of docs (doc_id, text, lang, source), from
    labels (doc_id, quality). ``kept``: score of at least one half. To a list given as ``exchanged`` each round adds (round,
    'text' or 'metadata', documents handed over by that view)."""
    spark = docs.sparkSession
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min(F.when(F.col("quality") > 0, 1.0).otherwise(0.0)).alias("y"))
    rows = docs.select("doc_id", F.array(*text_view()).alias("t"), F.array(*metadata_view(docs.columns)).alias("m"))
    rows, _ = save(rows.join(known.hint("merge"), "doc_id", "left"), "views")
    # A share of the hashes first, so that a task orders no more than its part of the sample; the rows are written
    # before they are collected, so that the driver gets the sample and not each task's candidates for it.
    labelled, h = rows.filter("y IS NOT NULL"), F.xxhash64("doc_id")
    share = min(1.0, 2 * max_labelled / max(1, labelled.count()))
    labelled = labelled.filter(h <= F.lit(int(-(2**63) + share * (2**64 - 2**11))).cast("long"))
    sample = save(labelled.orderBy(h, "doc_id").limit(max_labelled), "sample")[0].toPandas()
    sample = sample.iloc[np.lexsort((sample["doc_id"],))]
    t, m = (np.stack(sample[c]) if len(sample) else np.zeros((0, 1)) for c in ("t", "m"))
    y = sample["y"].to_numpy(float)
    if len(set(y)) < 2:
        share = F.lit(float(y.mean()) if len(y) else 1.0)
        return rows.select("doc_id", F.col("y").isNotNull().alias("labelled"), share.alias("p_text"), share.alias("p_metadata"), share.alias("score"), (share >= 0.5).alias("kept"))
    apart = np.random.default_rng(6).permutation(len(y)) % 5 == 0
    if len(set(y[apart])) < 2:
        apart[:] = True
    train = ~apart if len(set(y[~apart])) == 2 else np.ones(len(y), bool)
    sample = {"t": t, "m": m}
    handed: dict[str, DataFrame | None] = {"t": None, "m": None}

    def fitted(of: str) -> View:
        return View().fit(sample[of][train], y[train], handed[of]).calibrate(sample[of][apart], y[apart])

    views = {of: fitted(of) for of in handed}
    bar = float(np.log(confident / (1 - confident)))
    free = rows.filter("y IS NULL AND doc_id IS NOT NULL")
    changed, paths = set(views), {}
    for turn in range(rounds):
        fresh, old = {}, []
        for own, to in (("t", "m"), ("m", "t")):
            if own not in changed:
                continue
            odds = free.select(F.col(to).alias("x"), views[own].column(own).alias("odds")).filter(F.abs("odds") >= bar)
            table, path = save(odds.groupBy("x", (F.col("odds") > 0).cast("double").alias("y")).agg(F.count("*").cast("double").alias("n")), f"handed-{to}")
            fresh[to] = None if table.isEmpty() else table
            if exchanged is not None:
                exchanged.append((turn, {"t": "text", "m": "metadata"}[own], int(table.agg(F.sum("n")).head()[0] or 0)))
            old += [paths[to]] if to in paths else []
            paths[to] = path
        changed = {to for to in fresh if fresh[to] is not None or handed[to] is not None}
        handed |= fresh
        drop(spark, *old)
        if not changed:
            break
        views |= {to: fitted(to) for to in sorted(changed)}
    drop(spark, *paths.values())
    prior = float(np.log((y[apart].sum() + 1) / (len(y[apart]) - y[apart].sum() + 1)))
    p = lambda odds: 1 / (1 + F.exp(-odds))
    a, b = views["t"].column("t"), views["m"].column("m")
    out = rows.select("doc_id", F.col("y").isNotNull().alias("labelled"), p(a).alias("p_text"), p(b).alias("p_metadata"), p(a + b - F.lit(prior)).alias("score"))
    return out.withColumn("kept", F.col("score") >= 0.5)
