"""The registered queries of the operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelstats.plans.ship import ship
from panelstats.sources import table

from . import bpe, centroids, cotraining, line_dedup, lm_scoring, mixing, ngram_join, pii, quality_rules, resampling, storage, substring_dedup, token_files, topk

QUERIES, ORACLES = {}, {}


def _query(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return f


@_query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    measured, _ = storage.save(quality_rules.measure(docs).drop("text"), "rules")
    return quality_rules.judge(measured).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = storage.save(topk.quantise(table(spark, sf_dir, "embeddings")), "vectors")
    return topk.top_k(rows.filter("vec_id % 20 = 0"), rows, 20)


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded="decoded", cache=3).select("doc_id", *bpe.digests())


@_query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized, _ = storage.save(docs.select("doc_id", "source", mixing.size_of().alias("size"), mixing.unnamed().alias("_unnamed")), "sizes")
    return mixing.plan(sized, sized).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@_query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)
    return token_files.read(files, crc_only=True)


@_query
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


@_query
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"))


@_query
def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [pii.number(k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined("base_spans"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


@_query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = resampling.scored(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    rows, _ = storage.save(scored.drop("text"), "scores")
    return resampling.ranked(rows).select("doc_id", "n_features", "weight", "score", "rank")


@_query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@_query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    digests = F.array(*[F.lit(centroids.digest(c)) for c in found]) if len(found) else F.array(F.lit(""))
    return rows.withColumn("centroid_sha256", F.get(digests, F.col("cluster")))


#: Blanks as a DuckDB string, and documents as words and lines.
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES["op3_quality_rules"] = rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
m AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l, w FROM w),
g AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM m)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM d) GROUP BY doc_id),
a AS (SELECT m.doc_id, source, n_words, word_chars, n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines FROM m LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a),
c AS (SELECT *, base_failed OR n_symbols > n_words OR 2 * n_dup_lines > n_lines AS rule_failed FROM b),
h AS (SELECT source, count(*) AS n, sum(rule_failed::INT) AS f FROM c GROUP BY source),
s AS (SELECT sum(n) AS n, sum(f) AS f, count(*) AS k, sum(f) / sum(n)::DOUBLE AS m FROM h),
v AS (SELECT any_value(s.m) AS m, (sum(h.n * pow(h.f / h.n::DOUBLE - s.m, 2)) - (any_value(s.k) - 1) * any_value(s.m) * (1 - any_value(s.m))) / any_value(s.n) AS v FROM h, s),
p AS (SELECT m, greatest(1.0, least(1e6, CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 1e6 END)) AS w FROM v),
x AS (SELECT source, (f + m * w) / (n + w) > 0.6 AS bad FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT rule_failed AND NOT x.bad AS kept
FROM c JOIN x ON c.source IS NOT DISTINCT FROM x.source
"""

ORACLES["op2_line_dedup"] = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
f AS (SELECT k, max(doc_id) AS last FROM k WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.doc_id, i, line, f.k IS NOT NULL AND k.doc_id < f.last AS gone FROM k LEFT JOIN f ON k.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

ORACLES["op8_mixing"] = f"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, CASE WHEN doc_id IS NULL THEN md5(coalesce(text, '')) END AS unnamed FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, source_size * 2.0::DOUBLE AS cap FROM s),
f AS (SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k,
  (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
o AS (SELECT min(k) AS k, arg_min(level, k) AS level FROM f WHERE cap / w > level),
t AS (SELECT f.source, f.source_size, CASE WHEN o.k IS NULL OR f.k < o.k THEN f.cap ELSE o.level * f.w END AS target FROM f, o),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
  ('0x' || substr(md5('8:' || coalesce(d.doc_id::VARCHAR, d.unnamed, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""

ORACLES["op1_topk_search"] = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""

ORACLES["op10_ngram_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT a AS node, b AS seen FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.seen), d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.node = d.doc_id GROUP BY d.doc_id
"""

ORACLES["op12_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT g, min(doc_id) AS least FROM g GROUP BY g HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM (SELECT doc_id, i FROM g JOIN f USING (g) WHERE least < doc_id)),
w AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
k AS (SELECT w.doc_id, count(c.p) AS n_removed, string_agg(word, ' ' ORDER BY w.p) FILTER (c.p IS NULL) AS kept FROM w LEFT JOIN c ON c.doc_id = w.doc_id AND c.p = w.p GROUP BY w.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

_ASSIGN = """a{k} AS (SELECT vec_id, v, arg_min(n, (d, n)) AS n, min(d) AS d FROM (SELECT e.vec_id, e.v, c.n, list_inner_product(e.v, e.v) - 2 * list_inner_product(e.v, c.c) + list_inner_product(c.c, c.c) AS d FROM e, c{k} c) GROUP BY vec_id, v),"""
_MOVE = """m{k} AS (SELECT n, list(s ORDER BY i) AS c FROM (SELECT n, i, floor(sum(x) / count(*)) AS s FROM (SELECT n, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{j}) GROUP BY n, i) GROUP BY n),
c{k} AS (SELECT n, coalesce(m.c, o.c) AS c FROM c{j} o LEFT JOIN m{k} m USING (n)),"""
ORACLES["op13_centroid_clustering"] = f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR)) - 1 AS n, v AS c FROM e ORDER BY n LIMIT 16),
{_ASSIGN.format(k=0)} {" ".join(_MOVE.format(k=k, j=k - 1) + _ASSIGN.format(k=k) for k in (1, 2, 3))}
i AS (SELECT n, sum(d)::BIGINT AS cluster_inertia FROM a3 GROUP BY n)
SELECT vec_id, n::INT AS cluster, d::BIGINT AS distance, cluster_inertia, (SELECT sum(cluster_inertia)::BIGINT FROM i) AS inertia,
  sha256(array_to_string(list_transform(c, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256 FROM a3 JOIN i USING (n) JOIN c3 USING (n)
"""
