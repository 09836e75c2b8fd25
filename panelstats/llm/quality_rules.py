"""Host-level quality rules, in DataFrame functions alone.

Documents are measured by rules; failures are summed per host (``documents.source``), each host's
failure rate is shrunk towards the rates of all hosts by a beta prior fitted to them, and the verdict on
the host goes back to its documents.

Defined results: a null or empty text has no words and fails the base rule; null hosts form one host; a
repeated row is judged as often as it occurs; an empty table gives an empty result; extra columns stay,
and those named like a result column give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import save
from .text import BLANK_RUN, BLANKS

#: A host is rejected when its shrunk rate of failing documents is above this.
HOST_MAX = 0.6
#: More rejected hosts than this are joined by a shuffle instead of a broadcast (a host name and a flag each).
BROADCAST_ROWS = 10_000
_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in 5-word windows that occur twice or more.

    Windows become 64-bit hashes. Where all differ the count is 0; else (hash, position) pairs are sorted,
    so that equal windows are neighbours, and the union of the repeated windows is measured over their
    sorted positions: sorting alone, whatever the text's length.
    """

    def covered(at: Column) -> Column:
        following = F.concat(F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))), F.array(F.element_at(at, -1) + 5))
        return F.aggregate(F.zip_with(at, following, lambda a, b: F.least(b - a, F.lit(5))), F.lit(0).cast("long"), lambda s, x: s + x)

    def repeated(pairs: Column) -> Column:
        hit = lambda p, i: (p["h"] == F.get(pairs, i + 1)["h"]) | ((i > 0) & (p["h"] == F.get(pairs, i - 1)["h"]))
        return F.array_sort(F.transform(F.filter(pairs, lambda p, i: F.coalesce(hit(p, i), F.lit(False))), lambda p: p["i"]))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 5), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)]))

    def count(h: Column) -> Column:
        some = _let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), lambda p: _let(repeated(p), covered))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), some).otherwise(F.lit(0).cast("long"))

    return F.when(F.size(words) >= 6, _let(words, lambda w: _let(windows(w), count))).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the rules' measures and verdicts to every document: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed and rule_failed (base_failed, or over a symbol a word, or over half its
    lines repeated)."""
    t = F.coalesce(F.col(text), F.lit(""))
    squeezed = F.btrim(t, F.lit(BLANKS))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    ones = docs.drop(*_MEASURES, "base_failed", "rule_failed", "_w", "_l").withColumns({"_w": F.when(squeezed == "", F.array().cast("array<string>")).otherwise(F.split(squeezed, BLANK_RUN)), "_l": lines})
    ones = ones.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "word_chars": F.length(F.array_join("_w", "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
            "n_repeat_words": _repeat_words(F.col("_w")),
        }
    )
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    failed = base | (F.col("n_symbols") > F.col("n_words")) | (2 * F.col("n_dup_lines") > F.size("_l"))
    kept = [F.col(f"`{c}`") for c in ones.columns if c not in (*_MEASURES, "_w", "_l")]
    # A generator, so that a filter on a verdict is not moved below it, where it would repeat the measuring.
    row = F.explode(F.array(F.struct(*_MEASURES, base.alias("base_failed"), failed.alias("rule_failed")))).alias("_rules")
    return ones.select(*kept, row).select(*kept, "_rules.*")


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: n, n_failed and the shrunk rate (n_failed + a) / (n + a + b).

    a and b come from the hosts themselves by moments: with m the overall rate and v the variance of the
    hosts' rates beyond binomial noise, a + b = m (1 - m) / v - 1, kept within 1 and 1e6. Sums are over
    one row per host; failures combine on the map side, so that a hot host costs one row per task.
    """
    hosts = measured.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), F.sum(F.col("rule_failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n")
    sums = hosts.agg(F.sum("n").alias("_n"), F.sum("n_failed").alias("_f"), F.count("*").alias("_k"))
    sums = sums.withColumn("_m", F.try_divide(F.col("_f"), F.col("_n")))
    spread = hosts.crossJoin(F.broadcast(sums)).agg(
        F.first("_m").alias("_m"),
        F.try_divide(F.sum(F.col("n") * F.pow(rate - F.col("_m"), 2)) - (F.first("_k") - 1) * F.first("_m") * (1 - F.first("_m")), F.first("_n")).alias("_v"),
    )
    weight = F.greatest(F.lit(1.0), F.least(F.lit(1e6), F.when(F.col("_v") > 0, F.col("_m") * (1 - F.col("_m")) / F.col("_v") - 1).otherwise(F.lit(1e6))))
    prior = spread.select("_m", weight.alias("_w"))
    return hosts.crossJoin(F.broadcast(prior)).select("host", "n", "n_failed", ((F.col("n_failed") + F.col("_m") * F.col("_w")) / (F.col("n") + F.col("_w"))).alias("rate"))


def judge(measured: DataFrame, host: str = "source", host_max: float = HOST_MAX) -> DataFrame:
    """Adds ``kept``: the document passes the rules and its host's shrunk failure rate is at most ``host_max``."""
    bad = host_rates(measured, host).filter(F.col("rate") > host_max).select(F.col("host").alias("_host"), F.lit(True).alias("_bad"))
    if bad.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    joined = measured.drop("kept", "_host", "_bad").join(bad, F.col(host).eqNullSafe(F.col("_host")), "left")
    return joined.withColumn("kept", ~F.col("rule_failed") & F.col("_bad").isNull()).drop("_host", "_bad")


def filter_documents(docs: DataFrame, text: str = "text", host: str = "source", host_max: float = HOST_MAX) -> DataFrame:
    """The documents that pass, with their own columns. The texts are measured once, and written with the verdict of
    the rules (without those that fail); host rates come from the verdicts alone. No shuffle of texts."""
    measured = measure(docs.select(F.struct("*").alias("_row")), f"_row.`{text}`")
    row = F.when(~F.col("rule_failed"), F.col("_row")).alias("_row")
    measured, _ = save(measured.select(row, F.col(f"_row.`{host}`").alias("source"), "rule_failed"), "ruled")
    return judge(measured, host_max=host_max).filter("kept").select("_row.*")
