"""Exact top-k inner-product search by an impact-ordered, score-at-a-time index.

A vector's components are its postings. The index deals vectors to blocks and keeps, per block and dimension, segments of
postings of about one size (one bit length), the quantised impact, and the vectors' squared lengths. A task meets one
block with a batch of queries and reads the segments by falling impact (the size of their postings times the weight of
their dimension in the queries), adding to accumulators of the ids that a segment holds. After each step every score is known up
to |query| * |what of the vector has not been read|. A query stops when at most 4 k vectors can still belong to its k best,
or when nothing is left; the task stops reading when all its queries have. What can still belong is scored
anew from the whole vectors. The k best of all blocks are then merged.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part, nor do
rows without id; of rows that share an id the smallest vector counts; a shorter vector counts as if zeros
followed; ties go to the smaller id; other columns of any name are left out; an empty table gives an empty result. Scores
are exact 64-bit integers; where vectors are so large that one could leave that range, the search raises an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a block about, and queries that meet it at once.
BLOCK, BATCH = 4096, 1024
#: Steps in which the postings of a block are read: half of what is left each time, since bounds seldom prove anything early.
STEPS = 6


def quantise(vectors: DataFrame, scale: int = 64, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, as whole numbers."""
    x = F.transform(F.col(embedding), lambda e: e.cast("double"))
    sound = F.col(vec_id).isNotNull() & (F.size(x) > 0) & F.forall(x, lambda e: e.isNotNull() & (F.abs(e) < F.lit(float("inf"))))
    rows = vectors.filter(F.coalesce(sound, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda e: F.when(F.abs(e * scale) < F.lit(2.0**53), F.floor(e * scale).cast("long")).otherwise(F.raise_error(F.lit("a component is too large for exact scores")).cast("long"))).alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _level(x):
    """Bit length of |x|: the quantised impact of a posting."""
    return F.when(x == 0, 0).otherwise(F.length(F.conv(F.abs(x).cast("string"), 10, 2)))


def index(rows: DataFrame, blocks: int) -> DataFrame:
    """The segments: (block, level, dim, ids array, impacts array), one row each, impacts signed; and for each block one row
    of dim -1 with the ids and squared lengths of all its vectors."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    postings = dealt.select("block", "vec_id", F.posexplode("v").alias("dim", "impact")).filter("impact <> 0").withColumn("level", _level(F.col("impact")).cast("int"))
    squares = F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x)
    squares = F.when(squares < F.lit(2.0**62), squares.cast("long")).otherwise(F.raise_error(F.lit("a vector is too large for exact scores")).cast("long"))
    lengths = dealt.select("block", "vec_id", F.lit(-1).alias("dim"), squares.alias("impact"), F.lit(0).alias("level"))
    return (
        postings.unionByName(lengths).groupBy("block", "level", "dim")
        .agg(F.sort_array(F.collect_list(F.struct("vec_id", "impact"))).alias("p"))
        .select("block", "level", "dim", F.col("p.vec_id").alias("ids"), F.col("p.impact").alias("impacts"))
    )


def _exact(a: int, b: int, width: int) -> type:
    """The cheapest type that holds the inner products of numbers up to a and b exactly."""
    top = (a + 1) * (b + 1) * width
    if top >= 1 << 62:
        raise ValueError("these vectors are too large for exact 64-bit scores")
    return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64


def search_block(segments: pd.DataFrame, queries: pd.DataFrame, k: int) -> tuple[pd.DataFrame, float]:
    """The k best of one block for each query of a batch, and the share of the postings that were read for it."""
    lengths = segments[segments["dim"] < 0].iloc[0]
    segments = segments[segments["dim"] >= 0]
    ids, rest = np.asarray(lengths["ids"]), np.asarray(lengths["impacts"]).astype(float)
    width = int(max(segments["dim"].max() + 1 if len(segments) else 1, queries["v"].map(len).max()))
    q = np.zeros((len(queries), width), np.int64)
    for i, v in enumerate(queries["v"]):
        q[i, : len(v)] = v
    dims = segments["dim"].to_numpy(int)
    sizes = segments["ids"].map(len).to_numpy(int) if len(segments) else np.zeros(0, int)
    kind = _exact(int(np.abs(q).max(initial=0)), max((int(np.abs(x).max()) for x in segments["impacts"]), default=0), width)
    qk, q_norm = q.astype(kind), np.sqrt((q.astype(float) ** 2).sum(1))
    query_ids = queries["query_id"].to_numpy()
    own = np.minimum(np.searchsorted(ids, query_ids), len(ids) - 1)
    own = np.where(ids[own] == query_ids, own, -1)
    order = np.argsort(-(2.0 ** segments["level"].to_numpy(float)) * np.sqrt((q.astype(float) ** 2).mean(0))[dims], kind="stable")
    total, top = int(sizes.sum()), min(k, len(ids))
    cuts = np.searchsorted(np.cumsum(sizes[order]), np.append(1 - 0.5 ** np.arange(1, STEPS), 1) * total - 0.5) + 1
    all_ids, all_impacts = segments["ids"].to_list(), segments["impacts"].to_list()
    scores = np.zeros((len(q), len(ids)), kind)
    active, read, at, possible = np.arange(len(q)), 0, 0, [np.arange(len(ids))] * len(q)
    for cut in np.minimum(cuts, len(order)).tolist():
        step, at = order[at:cut], cut
        if not len(step):
            continue
        place = np.searchsorted(ids, np.concatenate([all_ids[i] for i in step]))
        x = np.concatenate([all_impacts[i] for i in step])
        who, row = np.unique(place, return_inverse=True)
        some, column = np.unique(np.repeat(dims[step], sizes[step]), return_inverse=True)
        part = np.zeros((len(who), len(some)), kind)
        part[row, column] = x
        scores[np.ix_(active, who)] += qk[np.ix_(active, some)] @ part.T
        rest[who] = np.maximum(rest[who] - (part.astype(float) ** 2).sum(1), 0)
        read += len(x)
        known, slack = scores[active].astype(float), q_norm[active, None] * np.sqrt(rest)[None, :] * (1 + 1e-9) + 1024 * (kind is np.int64)
        least = known - slack
        mine = np.flatnonzero(own[active] >= 0)
        least[mine, own[active][mine]] = -np.inf
        bar = np.partition(least, len(ids) - top, 1)[:, len(ids) - top]
        can = known + slack >= bar[:, None]
        done = (can.sum(1) <= 4 * k) | (at == len(order))  # the proof: no other vector can be among the k best
        for i in np.flatnonzero(done).tolist():
            possible[active[i]] = np.flatnonzero(can[i])
        active = active[~done]
        if not len(active):
            break
    needed = np.unique(np.concatenate(possible))
    spot = np.full(len(ids), -1)
    spot[needed] = np.arange(len(needed))
    whole = np.zeros((len(needed), width), kind)
    for d, i, x in zip(dims, all_ids, all_impacts):
        r = spot[np.searchsorted(ids, i)]
        whole[r[r >= 0], d] = np.asarray(x)[r >= 0]
    out = []
    for i, who in enumerate(possible):
        who = who[who != own[i]]
        score = (whole[spot[who]] @ qk[i]).astype(np.int64)
        if len(who) > k:
            bar = np.partition(score, len(score) - k)[len(score) - k]
            who, score = who[score >= bar], score[score >= bar]
        best = np.lexsort((ids[who], -score))[:k]
        out.append(pd.DataFrame({"query_id": query_ids[i], "vec_id": ids[who[best]], "score": score[best]}))
    return pd.concat(out), read / max(1, total)


def top_k(queries: DataFrame, rows: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows other than its own for each query; both frames have
    (vec_id, v). The index is shuffled once, each block to one task; the queries stream past every block, a batch at a time, so that a task holds
    one block and one batch, and gives k rows a query."""
    blocks = max(1, -(-rows.count() // BLOCK))
    segments = index(rows, blocks).select("block", F.lit(None).cast("long").alias("query_id"), "level", "dim", "ids", "impacts")
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.col("vec_id").alias("query_id"), *[F.lit(None).cast("int").alias(c) for c in ("level", "dim")], F.lit(None).cast("array<long>").alias("ids"), F.col("v").alias("impacts"))
    batch = BATCH

    def run(frames):
        block, own, held, waiting = None, [], None, []

        def answers():
            nonlocal held, waiting
            if held is None:
                held = pd.concat(own)
            some, waiting = pd.concat(waiting), []
            return search_block(held, some.rename(columns={"impacts": "v"}), k)[0]

        for frame in frames:
            for at, part in frame.groupby("block", sort=True):
                if at != block:
                    if waiting:
                        yield answers()
                    block, own, held = at, [], None
                is_query = part["query_id"].notna()
                if len(mine := part[~is_query]):
                    own.append(mine)
                asking = part[is_query].astype({"query_id": "int64"})
                while len(asking) and own:  # a block without vectors answers nothing
                    room = batch - sum(map(len, waiting))
                    waiting.append(asking.iloc[:room])
                    asking = asking.iloc[room:]
                    if sum(map(len, waiting)) >= batch:
                        yield answers()
        if waiting:
            yield answers()

    # Nulls come first: the segments of a block stand before the queries that meet it.
    dealt = segments.unionByName(asked).repartition("block").sortWithinPartitions("block", F.col("query_id").asc_nulls_first())
    found = dealt.mapInPandas(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
