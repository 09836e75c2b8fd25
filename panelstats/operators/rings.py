"""Simplification of rings for any number of tolerances in one pass, and the tolerance that meets a budget.

Splitting a line at the vertex farthest from its chord does not depend on the tolerance: the tolerance only says where to stop.
So every vertex has one number, the largest tolerance that still keeps it: its own distance when it splits a stretch, or that of a split above
it where that is less. ``tolerances`` finds it for all vertices, level by level over all open stretches at once; simplifying at a
tolerance is a filter. A stretch of more than ``LARGE`` vertices is split by aggregations and joins, shared by as many
tasks as hold its vertices; what is left of at most that size goes on in one task, with all its stretches in one array.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelstats.sources import written

#: Vertices of a stretch that one task takes.
LARGE = 50_000
RING = ["feature", "poly", "ring"]
_STATE = [*RING, "i", "x", "y", "lo", "lx", "ly", "hx", "hy", "cap"]


def _from_chord(x: Column, y: Column) -> Column:
    """The distance from the line through a stretch's ends, or from its end where both are one point."""
    dx, dy = F.col("hx") - F.col("lx"), F.col("hy") - F.col("ly")
    long = F.hypot(dx, dy)
    return F.when(long > 0, F.abs(dy * (x - F.col("lx")) - dx * (y - F.col("ly"))) / long).otherwise(F.hypot(x - F.col("lx"), y - F.col("ly")))


def split_levels(p: np.ndarray, cap: float, floor: float) -> np.ndarray:
    """The tolerances of the inner points of a line whose ends are fixed. Stretches of a level stand one after the other in one array, with
    their farthest points found by segmented maxima. Below ``floor`` a stretch is not split further."""
    out = np.zeros(len(p))
    low, high, caps = np.array([0]), np.array([len(p) - 1]), np.array([cap])
    while True:
        some = high - low > 1
        low, high, caps = low[some], high[some], caps[some]
        if not len(low):
            return out[1:-1]
        size = high - low - 1
        begin = np.cumsum(size) - size
        inner = np.arange(size.sum()) - np.repeat(begin - low - 1, size)
        a, chord = p[np.repeat(low, size)], np.repeat(p[high] - p[low], size, axis=0)
        off, length = p[inner] - a, np.hypot(*chord.T)
        across = np.abs(chord[:, 1] * off[:, 0] - chord[:, 0] * off[:, 1])
        far = np.where(length > 0, across / np.where(length > 0, length, 1), np.hypot(*off.T))
        most = np.maximum.reduceat(far, begin)
        at = np.minimum.reduceat(np.where(far == np.repeat(most, size), inner, len(p)), begin)
        caps = np.minimum(caps, most)
        out[inner] = np.minimum(np.repeat(caps, size), far)  # stands for those below the floor, the others split later
        out[at] = caps
        on = most > floor
        low, high, caps = np.concatenate([low[on], at[on]]), np.concatenate([at[on], high[on]]), np.concatenate([caps[on], caps[on]])


def tolerances(vertices: DataFrame, floor: float = 0.0) -> DataFrame:
    """(feature, poly, ring, i, x, y, tolerance) of closed rings of vertices (feature, poly, ring, i, x, y), the last not repeating the first. The
    first vertex and the one farthest from it are always kept. Tolerances up to ``floor`` may be any number up to it."""
    vertices = written(vertices.select(*RING, "i", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")), "vertices")
    point = F.struct("i", "x", "y")
    first = vertices.groupBy(*RING).agg(F.min_by(point, "i").alias("first"))
    from_first = F.hypot(F.col("x") - F.col("first.x"), F.col("y") - F.col("first.y"))
    ends = vertices.join(first, RING).groupBy(*RING, "first").agg(F.max_by(point, F.struct(from_first, -F.col("i"))).alias("far"))
    rows = vertices.join(ends, RING)
    before, whole = F.col("i") < F.col("far.i"), F.lit(float("inf"))
    fixed = rows.filter((F.col("i") == F.col("first.i")) | (F.col("i") == F.col("far.i"))).select(*RING, "i", "x", "y", whole.alias("tolerance"))
    side = lambda a, b: [F.when(before, F.col(f"{a}.{c}")).otherwise(F.col(f"{b}.{c}")) for c in ("i", "x", "y")]
    (lo, lx, ly), (_, hx, hy) = side("first", "far"), side("far", "first")
    rows = rows.filter((F.col("i") != F.col("first.i")) & (F.col("i") != F.col("far.i")))
    rows = written(rows.select(*RING, "i", "x", "y", lo.alias("lo"), lx.alias("lx"), ly.alias("ly"), hx.alias("hx"), hy.alias("hy"), whole.alias("cap")), "stretches")

    done, small = [fixed], []
    stretch = [*RING, "lo"]
    while True:
        far = _from_chord(F.col("x"), F.col("y"))
        sizes = rows.groupBy(*stretch).agg(F.count("*").alias("n"), F.max(far).alias("d"), F.max_by(point, F.struct(far, -F.col("i"))).alias("at"))
        large = written(sizes.filter(F.col("n") > LARGE), "splits")
        if large.isEmpty():
            small.append(rows)
            break
        small.append(rows.join(large.select(*stretch), stretch, "left_anti"))
        both = rows.join(large, stretch).withColumn("cap", F.least("cap", "d"))
        over, here, left = F.col("d") > floor, F.col("i") == F.col("at.i"), F.col("i") < F.col("at.i")
        done.append(both.filter(here | ~over).select(*RING, "i", "x", "y", F.col("cap").alias("tolerance")))
        new = {"lo": F.when(left, F.col("lo")).otherwise(F.col("at.i")), "hx": F.when(left, F.col("at.x")).otherwise(F.col("hx")), "hy": F.when(left, F.col("at.y")).otherwise(F.col("hy"))}
        new |= {"lx": F.when(left, F.col("lx")).otherwise(F.col("at.x")), "ly": F.when(left, F.col("ly")).otherwise(F.col("at.y"))}
        rows = written(both.filter(over & ~here).withColumns(new).select(*_STATE), "stretches")

    def finish(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("i")
        (lx, ly, hx, hy, cap) = part[["lx", "ly", "hx", "hy", "cap"]].iloc[0]
        line = np.concatenate([[(lx, ly)], part[["x", "y"]].to_numpy(float), [(hx, hy)]])
        return part[[*RING, "i", "x", "y"]].assign(tolerance=split_levels(line, cap, floor))

    kinds = dict(vertices.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*RING, "i", "x", "y")) + ", tolerance double"
    finished = reduce(DataFrame.unionByName, small).groupBy(*stretch).applyInPandas(finish, schema)
    return reduce(DataFrame.unionByName, [*done, finished])


def simplify(vertices: DataFrame, asked: list[float], speck: float = 1.0) -> DataFrame:
    """(eps, feature, poly, ring, n, area, path) of the rings of vertices (feature, poly, ring, i, x, y) that are left at each
    tolerance. Rings of fewer than three points or under ``speck`` go; with its outer ring (ring 0) a polygon goes whole."""
    kept = tolerances(vertices, min(asked)).withColumn("eps", F.explode(F.filter(F.array(*map(F.lit, map(float, asked))), lambda e: e < F.col("tolerance"))))
    rings = kept.groupBy("eps", *RING).agg(F.array_sort(F.collect_list(F.struct("i", "x", "y"))).alias("points"))

    def drawn(frames):
        for frame in frames:
            x, y = ([np.array([p[c] for p in points]) for points in frame["points"]] for c in ("x", "y"))
            area = [float(np.sum(a * np.roll(b, -1) - np.roll(a, -1) * b)) / 2 for a, b in zip(x, y)]
            path = ["M" + "L".join(map("{:.1f},{:.1f}".format, a, b)) + "Z" for a, b in zip(x, y)]
            yield frame[["eps", *RING]].assign(n=[len(a) for a in x], area=area, path=path)

    kinds = dict(vertices.dtypes)
    rings = rings.mapInPandas(drawn, "eps double, " + ", ".join(f"{c} {kinds[c]}" for c in RING) + ", n int, area double, path string")
    rings = written(rings.withColumn("_whole", (F.col("n") >= 3) & (F.abs("area") >= speck)), "rings")
    gone = rings.filter("ring = 0 AND NOT _whole").select("eps", "feature", "poly")
    return rings.filter("_whole").join(gone, ["eps", "feature", "poly"], "left_anti").select("eps", *RING, "n", "area", "path")


def within_budget(simplified: DataFrame, budget: int) -> DataFrame:
    """The rings at the smallest tolerance whose paths stay below ``budget`` bytes together; none if no tolerance does."""
    sizes = simplified.groupBy("eps").agg(F.sum(F.octet_length("path")).alias("bytes")).filter(F.col("bytes") < budget).agg(F.min("eps").alias("eps"))
    return simplified.join(sizes, "eps", "left_semi")
