"""N-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles. Similar documents form groups: those whose link to a shared pivot has
been proved, with the documents that share most with one of them, in chunks of bounded size. The matrix
holds for each shingle the groups with it. A query document reads the rows of the shingles that every
partner must share one of (a prefix under one order of all shingles), which gives the groups that it can
meet, unless too little of both stands from that shingle on; of those the union of the members' shingles bounds the overlap, and only groups whose bound
reaches the threshold are opened and their members compared exactly. Documents whose component is the same
already are never compared again, so a group of any number of copies costs a comparison or two a document.

The order of shingles puts the frequent ones last. Frequent are those that tasks meet repeatedly among
their own documents; their hashes mark a bitmap of fixed size, which is all that is broadcast. The order
decides how much is compared, never what is linked.

Defined results: a null or empty text, or one without words, has no shingles and is linked with nothing;
with fewer words than ``n`` the whole sequence is the one shingle; rows that share a doc_id are one node
with the links of each; rows without doc_id have no component; texts of any length count whole; a tie between
documents goes to the smallest doc_id; other columns of any name are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import saved_components
from .storage import drop, drop_table, save, save_bucketed, tidy
from .text import mix, pieces, word_bounds, word_hashes

#: Bits of the bitmap of frequent shingles, shingles that mark it at most, and the count that makes one frequent.
BITMAP_BITS, MARKS, FREQUENT = 23, 1 << 20, 8
#: Members of a group at most, and shingles that a task counts together.
GROUP, COUNTED = 64, 1 << 22
#: Parts of a large component when it is cut, and queries that meet a group in one task.
SALTS, ASKED = 64, 1024


def shingle_sets(texts: pa.Array, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    data, starts, stops, first = word_bounds(texts)
    words = word_hashes(data, starts, stops)
    factor = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    m = max(0, len(words) - n + 1)
    rolled = np.zeros(m, np.uint64)
    for k in range(n):
        rolled += words[k : k + m] * factor[k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            out.append(mix((words[a:b] * factor[: b - a]).sum(keepdims=True, dtype=np.uint64) ^ np.uint64(b - a)))
        else:
            out.append(rolled[:0])
    return out


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _columns(batch: pa.RecordBatch, *names: str) -> list:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def _measured(docs: DataFrame, n: int) -> DataFrame:
    """kind 0: doc_id, n and the digest (a, b) of each document's set; kind 1: shingles (a) that a task met in
    ``b`` different sets, two at least."""

    @tidy
    def run(batches):
        seen, held, size = set(), [], 0

        def rows(kind, ids, sizes, a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["kind", "doc_id", "n", "a", "b"])

        def repeated():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts > 1
            return rows(1, np.zeros(many.sum(), np.int64), np.zeros(many.sum(), np.int64), values[many].view(np.int64), counts[many].astype(np.int64))

        for batch, texts in pieces(batches):
            sets = shingle_sets(texts, n)
            digests = [_digest(s) for s in sets]
            for s, d in zip(sets, digests):
                if d not in seen and len(s):
                    seen.add(d)
                    held.append(s)
                    size += len(s)
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield rows(0, batch.column(0), [len(s) for s in sets], both[:, 0].copy(), both[:, 1].copy())
            if size >= COUNTED:
                yield repeated()
                held, size = [], 0
        if held:
            yield repeated()

    return docs.mapInArrow(run, "kind int, doc_id long, n long, a long, b long")


def _bitmap(counts: DataFrame) -> np.ndarray:
    """Marks of the most repeated shingles; at most MARKS numbers come to the driver."""
    top = counts.groupBy("a").agg(F.sum("b").alias("n")).filter(F.col("n") >= FREQUENT).orderBy(F.col("n").desc(), "a").limit(MARKS)
    marks = np.zeros(1 << BITMAP_BITS, bool)
    marks[top.select((F.col("a").bitwiseAND((1 << BITMAP_BITS) - 1)).cast("int").alias("bit")).distinct().toArrow()["bit"].to_numpy()] = True
    return marks


def _postings(docs: DataFrame, n: int, percent: int, marks) -> DataFrame:
    """(token, doc_id, n, pos) of the prefix of each set, in the order of all shingles: any two sets that reach the threshold
    share one of them. Of equal sets a task gives one."""

    @tidy
    def run(batches):
        frequent, seen = marks.value, set()
        for batch, texts in pieces(batches):
            ids, sizes, tokens, places = [], [], [], []
            for doc, s in zip(batch.column(0).to_pylist(), shingle_sets(texts, n)):
                if not len(s) or (d := _digest(s)) in seen:
                    continue
                seen.add(d)
                late = frequent[(s & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)]
                prefix = np.concatenate([s[~late], s[late]])[: len(s) + percent * len(s) // -100 + 1]
                tokens.append(prefix)
                ids.append(np.full(len(prefix), doc, np.int64))
                sizes.append(np.full(len(prefix), len(s), np.int64))
                places.append(np.arange(len(prefix)))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places))], ["token", "doc_id", "n", "pos"])

    return docs.filter("doc_id IS NOT NULL").mapInArrow(run, "token long, doc_id long, n long, pos long")


def _near(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _proved(pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """Of (a, b, text_a, text_b) the pairs (a, b) that reach the threshold."""

    @tidy
    def run(batches):
        for batch, texts in pieces(batches, "text_a"):
            others = batch.column(batch.schema.get_field_index("text_b")).cast(pa.large_string()).fill_null("")
            hit = [_near(x, y, percent) for x, y in zip(shingle_sets(texts, n), shingle_sets(pa.concat_arrays([others]), n))]
            yield batch.filter(pa.array(hit)).select(["a", "b"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _opened(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """The links (a, b) of queries with members of the groups that their bound opens, members of smaller components alone. The
    rows (family, chunk, part, query, component, doc_id, text) of a task are sorted, the members of a group before the queries
    that it meets, so that only the shingles of one group's members are held. Of the members of one component a query
    looks for one link."""

    @tidy
    def run(batches):
        group, own, union, least = None, [], None, 0
        for batch, texts in pieces(batches):
            found = []
            for *key, query, component, doc, s in zip(*_columns(batch, "family", "chunk", "part", "query", "component", "doc_id"), shingle_sets(texts, n)):
                if key != group:
                    group, own, union = key, [], None
                if not query:
                    own.append((component, doc, s))
                    continue
                if union is None:
                    union, least = np.unique(np.concatenate([x for _, _, x in own])), min(len(x) for _, _, x in own)
                bound = len(np.intersect1d(s, union, assume_unique=True))
                if 100 * bound >= percent * max(len(s), least):
                    linked = set()
                    for c, m, x in own:
                        if c < component and c not in linked and _near(s, x, percent):
                            linked.add(c)
                            found.append((doc, m))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    return rows.select("family", "chunk", "part", "query", "component", "doc_id", "text").mapInArrow(run, "a long, b long")


def _chunked(members: DataFrame) -> DataFrame:
    """Adds ``chunk`` to (doc_id, family, component): families of more than GROUP documents are cut by hash into chunks of
    about that size. Their sizes meet the documents by family and SALTS parts of the hash, so that the documents of one
    family spread over as many tasks; smaller families need no size."""
    big = members.groupBy("family").agg(F.count("*").alias("of")).filter(F.col("of") > GROUP)
    big = big.select("family", "of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    chunk = F.when(F.col("of").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.ceil(F.col("of") / GROUP))).cast("long")
    return salted.join(big.hint("merge"), ["family", "salt"], "left").select("doc_id", "family", "component", chunk.alias("chunk"))


def link_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    measured, m_path = save(_measured(docs, n), "shingles", "kind")
    own = measured.filter("kind = 0").select("doc_id", "n", "a", "b")
    marks = spark.sparkContext.broadcast(_bitmap(measured.filter("kind = 1").select("a", "b")))

    classes, c_path = save(own.filter("n > 0 AND doc_id IS NOT NULL").groupBy("a", "b").agg(F.min("doc_id").alias("rep")), "classes")
    members, r_path = save(own.join(classes.hint("merge"), ["a", "b"], "left").select("doc_id", "n", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("doc_id")).alias("rep")), "members")
    rep_of = members.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", "rep").distinct()

    prefixes, p_path = save(_postings(docs, n, percent, marks), "prefixes")
    shared = prefixes.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").select("token")
    shared = prefixes.join(shared.hint("merge"), "token", "left_semi")
    shared, s_path = save(shared.join(rep_of.hint("merge"), "doc_id").select("token", F.col("rep").alias("doc_id"), "n", "pos").distinct(), "shared")
    del prefixes
    drop(spark, p_path, m_path, c_path)

    # Texts of the documents that share a prefix shingle with another, in buckets; all comparing is among them.
    involved = shared.select("doc_id").distinct()
    texts, table = save_bucketed(docs.join(involved.hint("merge"), "doc_id", "left_semi"), "ngram_texts", "doc_id")
    try:
        links = _links(shared, texts, n, percent)
    finally:
        drop_table(spark, table)
    # One document may stand for several sets, if its doc_id repeats.
    several = members.filter("doc_id IS NOT NULL").select("doc_id", "rep").distinct()
    first = several.groupBy("doc_id").agg(F.min("rep").alias("a"), F.count("*").alias("c")).filter("c > 1").select("doc_id", "a")
    same = several.join(first.hint("merge"), "doc_id").select("a", F.col("rep").alias("b"))
    final, _ = saved_components(links.unionByName(same), "components")
    drop(spark, s_path)
    return members.join(final.hint("merge"), F.col("rep") == F.col("node"), "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


def _links(shared: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Proved links (a, b) that connect all that link, from the shared prefix shingles (token, doc_id, n) and the texts
    of their documents in buckets by doc_id."""
    spark = shared.sparkSession
    # Groups: each document with the pivot (smallest document of a shingle) it shares most with, once proved.
    pivots = shared.groupBy("token").agg(F.min("doc_id").alias("pivot"), F.count("*").alias("c")).filter("c > 1").select("token", "pivot")
    with_pivot = shared.join(pivots.hint("merge"), "token").filter("doc_id <> pivot").groupBy("doc_id", "pivot").agg(F.count("*").alias("c"))
    pairs = with_pivot.groupBy("doc_id").agg(F.max_by("pivot", F.struct("c", -F.col("pivot"))).alias("b")).select(F.col("doc_id").alias("a"), "b")
    pairs, q_path = save(pairs, "pairs")
    # A pivot of many documents meets them in several tasks, with a copy of its text in each.
    pivots = pairs.groupBy("b").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("parts"))
    salted = pairs.join(pivots.hint("merge"), "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("salt"))
    of_pivots = pivots.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b").select("b", "text_b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    both = salted.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a").join(of_pivots.hint("merge"), ["b", "salt"])
    near, n_path = save(_proved(both, n, percent), "near")
    first, f_path = saved_components(near, "components")

    # A family is a component with the documents that are most like one of its members; a document alone is its own.
    of = lambda name, to: first.select(F.col("node").alias(name), F.col("component").alias(to)).hint("merge")
    nodes = shared.select("doc_id").distinct().join(of("doc_id", "component"), "doc_id", "left").join(pairs.select(F.col("a").alias("doc_id"), "b").hint("merge"), "doc_id", "left")
    nodes = nodes.join(of("b", "_of_b"), "b", "left")
    nodes = nodes.select("doc_id", F.coalesce("component", "_of_b", "b", "doc_id").alias("family"), F.coalesce("component", "doc_id").alias("component"))
    nodes, d_path = save(nodes, "families")
    chunks, g_path = save(_chunked(nodes), "chunks")

    # The matrix: shingles met in more than one component, with the chunks of members that have them.
    placed, l_path = save(shared.join(chunks.hint("merge"), "doc_id"), "placed")
    open_ = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("token")
    met = placed.join(open_.hint("merge"), "token", "left_semi")
    at = ["family", "chunk"]
    matrix = met.groupBy("token", *at).agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("pos")).alias("left"), F.min("component").alias("lowest"))
    queries = met.select("token", F.col("doc_id").alias("q"), F.col("n").alias("q_n"), (F.col("n") - F.col("pos")).alias("q_left"), F.col("component").alias("q_component"))
    # Of two components that of the larger number asks.
    close = (F.col("q_component") > F.col("lowest")) & (100 * F.col("most") >= percent * F.col("q_n")) & (100 * F.col("q_n") >= percent * F.col("least"))
    # The first shingle in order that a query and a member share bounds what they share by what stands from it on in each.
    # Both are in classes of length, a factor of 100 / percent wide, and meet in those alone that admit a link.
    width = max(math.log(100 / percent), 1e-6)
    length = lambda n, slack: F.floor(F.log(n.cast("double")) / width + slack)
    queries = queries.withColumn("length", length(F.col("q_n"), 1e-9))
    matrix = matrix.withColumn("length", F.explode(F.sequence(length(F.col("least") * percent / 100, 0.0), length(F.col("most") * 100 / percent, 2e-9))))
    close = close & ((100 + percent) * F.least("q_left", "left") >= percent * (F.col("q_n") + F.col("least")))
    asked, a_path = save(queries.join(matrix.hint("merge"), ["token", "length"]).filter(close).select("q", "q_component", *at).distinct(), "asked")

    # Groups that many queries meet are opened in several tasks.
    groups = asked.groupBy(*at).agg(F.ceil(F.count("*") / ASKED).alias("parts"))
    who = chunks.join(groups.hint("merge"), at).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    who = who.select("doc_id", "component", *at, "part", F.lit(False).alias("query"))
    asking = asked.join(groups.hint("merge"), at).select(F.col("q").alias("doc_id"), F.col("q_component").alias("component"), *at, F.pmod(F.xxhash64("q"), F.col("parts")).alias("part"), F.lit(True).alias("query"))
    rows = who.unionByName(asking).join(texts.hint("merge"), "doc_id")
    rows = rows.repartition(*at, "part").sortWithinPartitions(*at, "part", "query", "doc_id")
    links, _ = save(near.unionByName(_opened(rows, n, percent)), "links")
    drop(spark, q_path, n_path, f_path, d_path, g_path, l_path, a_path)
    return links
