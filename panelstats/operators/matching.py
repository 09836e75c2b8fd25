"""Texts against keys and names against names without comparing all with all: equi-joins on what a match must share."""

from __future__ import annotations

import difflib
import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from panelstats.sources import written

#: Length of the substring by which a key is found.
ANCHOR = 3


def substrings(s: Column, n: int) -> Column:
    """All substrings of ``n`` characters, in order."""
    return F.when(F.length(s) >= n, F.transform(F.sequence(F.lit(1), F.length(s) - (n - 1)), lambda i: F.substring(s, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def keyed(texts: DataFrame, rules: DataFrame, text: str = "_s") -> DataFrame:
    """Pairs of a text and a rule (with key and how) that holds for it: the text is the key ('exact'), has it ('contains') or begins with it
    ('startswith'); an empty key holds for none. A key is found by a part of it: the whole, its first ANCHOR characters,
    or, of its substrings of that length, the one that the fewest texts have. Texts meet keys by an equi-join on these and are
    verified afterwards, so that the work follows the texts and what they nearly match, not texts times rules."""
    s, key = F.col(text), F.col("key")
    inside = F.flatten(F.array(*[substrings(s, n) for n in range(1, ANCHOR + 1)]))
    marks = F.concat(F.array(F.concat(F.lit("="), s)), F.transform(F.array(*[F.substring(s, 1, n) for n in range(1, ANCHOR + 1)]), lambda x: F.concat(F.lit("^"), x)), F.transform(inside, lambda x: F.concat(F.lit("~"), x)))
    texts = written(texts.filter(F.length(s) > 0), "texts")
    held = texts.select("*", F.explode(F.array_distinct(marks)).alias("_anchor"))
    # How many texts have each candidate of a key decides which one stands for it.
    whole = F.when(F.length(key) >= ANCHOR, F.transform(substrings(key, ANCHOR), lambda x: F.concat(F.lit("~"), x))).otherwise(F.array(F.concat(F.lit("~"), key)))
    anchors = F.when(F.col("how") == "exact", F.array(F.concat(F.lit("="), key))).when(F.col("how") == "startswith", F.array(F.concat(F.lit("^"), F.substring(key, 1, ANCHOR)))).otherwise(whole)
    rules = rules.filter(F.length(key) > 0)
    candidates = rules.select("key", "how", F.explode(F.array_distinct(anchors)).alias("_anchor")).distinct()
    counts = held.groupBy("_anchor").agg(F.count("*").alias("_texts"))
    chosen = candidates.join(counts, "_anchor", "left").groupBy("key", "how").agg(F.min_by("_anchor", F.struct(F.coalesce("_texts", F.lit(0)), F.col("_anchor"))).alias("_anchor"))
    met = held.join(rules.join(chosen, ["key", "how"]), "_anchor").drop("_anchor")
    return met.filter(F.when(F.col("how") == "exact", s == key).when(F.col("how") == "contains", s.contains(key)).otherwise((F.col("how") == "startswith") & s.startswith(key)))


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib's ratio."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])


def pairs_bound(least: float) -> bool:
    """Whether two texts of ratio ``least`` that are not equal always share a pair of letters. With m matched characters and d others,
    the matched ones stand in at most d + 1 blocks and hold m - d - 1 pairs."""
    if 1.5 * least <= 1:
        return False
    return all((s - d) // 2 - d - 1 >= 1 for s in range(2, math.ceil(2 / (1.5 * least - 1)) + 3) for d in range(1, math.floor((1 - least) * s + 1e-9) + 1) if (s - d) % 2 == 0)


def _tokens(texts: DataFrame, n: int) -> DataFrame:
    """(x, side, t) of the substrings of ``n`` characters of each text, the k-th of a kind marked so, that common ones of two texts count as a set."""

    def run(frames):
        for frame in frames:
            rows = []
            for x, side in zip(frame["x"], frame["side"]):
                met: Counter = Counter()
                for i in range(len(x) - n + 1):
                    met[x[i : i + n]] += 1
                    rows.append((x, side, f"{x[i : i + n]}{met[x[i : i + n]]}"))
            yield pd.DataFrame(rows, columns=["x", "side", "t"])

    return texts.select("x", "side").mapInPandas(run, "x string, side int, t string")


def _common(n: int):
    @F.pandas_udf("long")
    def count(a: pd.Series, b: pd.Series) -> pd.Series:
        held: dict[str, Counter] = {}
        of = lambda x: held.get(x) or held.setdefault(x, Counter(x[i : i + n] for i in range(len(x) - n + 1)))
        return pd.Series([sum(min(k, y[g]) for g, k in x.items() if g in y) for x, y in ((of(p), of(q)) for p, q in zip(a, b))], dtype="int64")

    return count


def alike_candidates(left: DataFrame, right: DataFrame, least: float, name: str = "name") -> DataFrame:
    """Pairs (a, b) of distinct texts whose ratio 2 m / (|a| + |b|) may reach ``least``: those that pass the length bound and share enough tokens
    for it. Tokens are pairs of letters where the ratio implies some (``pairs_bound``), else letters. They are ordered rare first over
    both sides, and a pair meets on a token of both prefixes: the tokens that two texts share can't all stand behind them. A frequent token
    stands in the prefix of few texts."""
    n = 2 if pairs_bound(least) else 1
    size = lambda c: F.length(c)
    matched = lambda total: F.ceil(F.lit(least) * total / 2 - 1e-9)
    shared = (lambda total: matched(total)) if n == 1 else (lambda total: 3 * matched(total) - total - 1)
    # The fewest that a text of a length must share with any admissible one, from the shortest such.
    fewest = lambda a: F.greatest(F.lit(1), F.ceil(a * (least if n == 1 else 3 * least - 2) / (2 - least) - (0 if n == 1 else 1) - 1e-9))
    sides = [frame.select(F.col(name).alias("x")).filter(F.length(name) > 0).distinct() for frame in (left, right)]
    texts = written(sides[0].withColumn("side", F.lit(0)).unionByName(sides[1].withColumn("side", F.lit(1))), "names")
    tokens = _tokens(texts, n)
    counts = tokens.groupBy("t").agg(F.count("*").alias("c"))
    ordered = tokens.join(counts, "t").groupBy("x", "side").agg(F.array_sort(F.collect_list(F.struct("c", "t"))).alias("ts"))
    kept = F.greatest(F.lit(0), F.size("ts") - fewest(size("x")) + 1).cast("int")
    prefixes = ordered.select("x", "side", F.size("ts").alias("n"), F.posexplode(F.transform(F.slice("ts", F.lit(1), kept), lambda s: s["t"])).alias("i", "t"))
    prefixes = written(prefixes.select("x", "side", "t", (F.col("n") - F.col("i")).alias("left")), "prefixes")
    a, b = prefixes.filter("side = 0").select(F.col("x").alias("a"), "t", F.col("left").alias("left_a")), prefixes.filter("side = 1").select(F.col("x").alias("b"), "t", F.col("left").alias("left_b"))
    fits = 2 * F.least(size("a"), size("b")) >= F.lit(least) * (size("a") + size("b")) - 1e-9
    # From the first token in order that two texts share on, what stands in each bounds what they share.
    need = shared(size("a") + size("b"))
    met = a.join(b, "t").filter(fits & (F.least("left_a", "left_b") >= need)).select("a", "b").distinct()
    met = met.filter(_common(n)("a", "b") >= need)
    equal = sides[0].join(sides[1].select("x"), "x").select(F.col("x").alias("a"), F.col("x").alias("b"))
    return met.filter("a <> b").unionByName(equal)


def alike(left: DataFrame, right: DataFrame, least: float, name: str = "name") -> DataFrame:
    """(a, b, ratio) of the distinct texts of both sides whose difflib ratio is at least ``least``."""
    met = alike_candidates(left, right, least, name)
    return met.withColumn("ratio", F.when(F.col("a") == F.col("b"), F.lit(1.0)).otherwise(ratio("a", "b"))).filter(F.col("ratio") >= least)
