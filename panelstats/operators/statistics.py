"""Estimators from sufficient statistics; only those reach the driver or a single group."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelstats.sources import written


def correlations(rows: DataFrame, keys: list[str], x: str, y: str, least: int = 25) -> DataFrame:
    """Pearson and Spearman (average ranks) by group, null below ``least`` pairs."""
    pairs = rows.dropna(subset=[x, y])
    for c in (x, y):
        ties = F.count("*").over(Window.partitionBy(*keys, c))
        pairs = pairs.withColumn(f"_{c}", F.rank().over(Window.partitionBy(*keys).orderBy(c)) + (ties - 1) / 2)
    enough = F.count("*") >= least
    return pairs.groupBy(*keys).agg(F.count("*").alias("n"), F.when(enough, F.corr(x, y)).alias("pearson"), F.when(enough, F.corr(f"_{x}", f"_{y}")).alias("spearman"))


def t_tail(t: float, freedom: int) -> float:
    """Two-sided tail of Student's t: the regularised incomplete beta function by its continued fraction."""
    a, b, x = freedom / 2, 0.5, freedom / (freedom + t * t)
    if x >= 1:
        return 1.0
    flip = x > (a + 1) / (a + b + 2)
    if flip:
        a, b, x = b, a, 1 - x
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a if x > 0 else 0.0
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    f = d
    for m in range(1, 500):
        for n in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + n * d)
            c = 1 + n / c
            f *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return 1 - front * f if flip else front * f


def t_bound(tail: float, freedom: int) -> float:
    """The t with this two-sided tail."""
    low, high = 0.0, 1e6
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if t_tail(mid, freedom) > tail else (low, mid)
    return low


#: Time levels up to which the equations of the time effects are solved on the driver.
DENSE = 500


def _dense_effects(cells: DataFrame, keys: list[str], whole: dict) -> DataFrame:
    """Time effects from the normal equations that absorbing the units leaves: a row for each pair of levels that a unit has, summed by Spark;
    a matrix as large as the levels of a group is solved on the driver."""
    each = cells.groupBy(*keys, "_u").agg(F.collect_list(F.struct("_t", "n")).alias("a"), F.sum("n").alias("of")).select(*keys, "of", F.explode("a").alias("p"), F.col("a").alias("b"))
    pairs = each.select(*keys, "of", "p", F.explode("b").alias("q")).filter("p._t <= q._t")
    entry = F.when(F.col("p._t") == F.col("q._t"), F.col("p.n")).otherwise(0) - F.col("p.n") * F.col("q.n") / F.col("of")
    left = pairs.groupBy(*keys, F.col("p._t").alias("s"), F.col("q._t").alias("t")).agg(F.sum(entry).alias("v")).collect()
    right = cells.groupBy(*keys, "_t").agg(F.sum("sx").alias("sx"), F.sum("sy").alias("sy")).collect()
    at = {k: {t: i for i, t in enumerate(times)} for k, times in whole.items()}
    a, b = {k: np.zeros((len(ts), len(ts))) for k, ts in whole.items()}, {k: np.zeros((len(ts), 2)) for k, ts in whole.items()}
    for *k, s, t, v in left:
        i, j = at[tuple(k)][s], at[tuple(k)][t]
        a[tuple(k)][i, j] = a[tuple(k)][j, i] = v
    for *k, t, sx, sy in right:
        b[tuple(k)][at[tuple(k)][t]] = sx, sy
    found = {k: np.concatenate([[(0.0, 0.0)], np.linalg.pinv(a[k][1:, 1:]) @ b[k][1:]]) for k in whole}  # against the first level
    schema = ", ".join(f"`{c}` {kind}" for c, kind in cells.dtypes if c in (*keys, "_t"))
    order = [c for c in cells.columns if c in (*keys, "_t")]
    rows = [tuple({**dict(zip(keys, k)), "_t": t}[c] for c in order) + (float(dx), float(dy)) for k, ts in whole.items() for t, (dx, dy) in zip(ts, found[k])]
    return cells.sparkSession.createDataFrame(rows, schema + ", dx double, dy double")


def _swept_effects(cells: DataFrame, keys: list[str], tolerance: float = 1e-13, most: int = 10_000) -> DataFrame:
    """Time effects by alternating demeaning: the units' means of what the time effects leave, then the times' means of what those leave, until
    no effect moves by more than ``tolerance`` of the largest. Only tables of one row a level are written between."""
    effects = written(cells.select(*keys, "_t").distinct().withColumns({"dx": F.lit(0.0), "dy": F.lit(0.0)}), "effects")
    rest = lambda c, d: F.sum(F.col(f"s{c}") - F.col("n") * F.col(d + c)) / F.sum("n")
    for _ in range(most):
        units = cells.join(effects, [*keys, "_t"]).groupBy(*keys, "_u").agg(rest("x", "d").alias("ux"), rest("y", "d").alias("uy"))
        times = cells.join(units, [*keys, "_u"]).groupBy(*keys, "_t").agg(rest("x", "u").alias("dx"), rest("y", "u").alias("dy"))
        old = effects.select(*keys, "_t", F.col("dx").alias("ox"), F.col("dy").alias("oy"))
        new = written(times.join(old, [*keys, "_t"]), "effects")
        moved, size = new.agg(F.max(F.greatest(F.abs(F.col("dx") - F.col("ox")), F.abs(F.col("dy") - F.col("oy")))), F.max(F.greatest(F.abs("dx"), F.abs("dy")))).head()
        effects = new.drop("ox", "oy")
        if moved is None or moved <= tolerance * (size or 1.0):
            return effects
    raise ArithmeticError("the time effects do not converge")


def fixed_effects(panel: DataFrame, unit: str, time: str, x: str, y: str, keys: list[str] = ()) -> DataFrame:
    """Two-way fixed effects of y on x with CR1 errors clustered by unit, one row for each group of keys, for unbalanced
    panels. x and y lose their units' means and their time effects (``_dense_effects``, beyond DENSE levels ``_swept_effects``, with equal results);
    what is left gives the coefficient, and by unit the errors. The panel is written once; one row a group comes to the driver. ci95 and p are of t with units - 1
    degrees of freedom. Null below 30 rows, 3 years or 5 units; units need two rows."""
    keys, spark = list(keys), panel.sparkSession
    w = Window.partitionBy(*keys, "_u")
    rows = panel.dropna(subset=[x, y]).select(*keys, F.col(unit).alias("_u"), F.col(time).alias("_t"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    rows = written(rows.withColumn("_n", F.count("*").over(w)).withColumns({c: F.col(c) - F.avg(c).over(w) for c in ("_x", "_y")}), "panel")
    two = F.col("_n") >= 2
    groups = rows.groupBy(*keys).agg(F.count_if(two), F.count_distinct(F.when(two, F.col("_u"))), F.count_distinct(F.when(two, F.col("_t"))), F.sort_array(F.collect_set(F.when(two, F.col("_t"))))).collect()
    found = {tuple(g[: len(keys)]): g[len(keys) :] for g in groups}
    whole = {k: times for k, (n, units, years, times) in found.items() if n >= 30 and years >= 3 and units >= 5}
    sums = {}
    if whole:
        rows = rows.filter(two)
        if keys:
            chosen = spark.createDataFrame(list(whole), ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys))
            rows = rows.join(chosen, keys, "left_semi")
        cells = written(rows.groupBy(*keys, "_u", "_t").agg(F.count("*").alias("n"), F.sum("_x").alias("sx"), F.sum("_y").alias("sy")), "cells")
        effects = _dense_effects(cells, keys, whole) if max(map(len, whole.values())) <= DENSE else _swept_effects(cells, keys)
        rest = rows.join(effects, [*keys, "_t"]).withColumns({"_a": F.col("_x") - F.col("dx"), "_b": F.col("_y") - F.col("dy")})
        rest = rest.withColumns({c: F.col(c) - F.avg(c).over(w) for c in ("_a", "_b")})
        scores = rest.groupBy(*keys, "_u").agg(F.sum(F.col("_a") * F.col("_b")).alias("ab"), F.sum(F.col("_a") * F.col("_a")).alias("aa"))
        group = Window.partitionBy(*keys)  # one row a unit
        scores = scores.withColumns({"bread": F.sum("aa").over(group), "coef": F.sum("ab").over(group) / F.nullif(F.sum("aa").over(group), F.lit(0.0))})
        meat = scores.groupBy(*keys).agg(F.first("coef"), F.first("bread"), F.sum(F.pow(F.col("ab") - F.col("coef") * F.col("aa"), 2)))
        sums = {tuple(r[: len(keys)]): r[len(keys) :] for r in meat.collect()}
    out = []
    for k, (n, units, years, _) in found.items():
        free = n - units - years
        coef, bread, meat = sums.get(k, (None, None, None))
        se = math.sqrt(meat * units / (units - 1) * (n - 1) / free) / bread if coef is not None and free > 0 else None
        bound = t_bound(0.05, units - 1) * se if se is not None else None
        t = coef / se if se else None
        ends = (None, None) if se is None else (coef - bound, coef + bound)
        out.append((*k, n, units, years, coef, se, t, *ends, t_tail(t, units - 1) if se else None))
    schema = "".join(f"`{k}` {panel.schema[k].dataType.simpleString()}, " for k in keys) + "n long, units long, years long, coef double, se double, t double, ci95_low double, ci95_high double, p double"
    return spark.createDataFrame(out, schema)


def jackknife_mean(rows: DataFrame, weight: str, values: list[str], zone: str, rep: str) -> DataFrame:
    """Weighted mean over plausible values with jackknife variance and their combination: one pass gives sums per
    (zone, rep); a replicate leaves one half of a zone out and doubles the other."""
    long = rows.select(zone, rep, F.col(weight).alias("w"), F.posexplode(F.array(*values)).alias("pv", "v"))
    cells = long.groupBy("pv", zone).agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("v")).alias("wv"), F.sum(F.when(F.col(rep) == 1, F.col("w")).otherwise(0.0)).alias("w1"), F.sum(F.when(F.col(rep) == 1, F.col("w") * F.col("v")).otherwise(0.0)).alias("wv1"))
    p = Window.partitionBy("pv")
    cells = cells.withColumn("mean", F.sum("wv").over(p) / F.sum("w").over(p))
    cells = cells.withColumn("replicate", (F.sum("wv").over(p) - F.col("wv") + 2 * F.col("wv1")) / (F.sum("w").over(p) - F.col("w") + 2 * F.col("w1")))
    each = cells.groupBy("pv").agg(F.first("mean").alias("mean"), F.sum(F.pow(F.col("replicate") - F.col("mean"), 2)).alias("sampling"))
    out = each.agg(F.avg("mean").alias("estimate"), F.avg("sampling").alias("sampling"), F.var_samp("mean").alias("between"), F.count("*").alias("m"))
    return out.select("estimate", F.sqrt(F.col("sampling") + (1 + 1 / F.col("m")) * F.col("between")).alias("se"))


def weighted_slope(rows: DataFrame, weight: str, x: str, values: list[str], zone: str, rep: str) -> DataFrame:
    """Weighted least squares slope of each plausible value on x, with the same variance, from the sums of w, wx,
    wxx, wy and wxy per (zone, rep)."""
    long = rows.select(zone, rep, F.col(weight).alias("w"), F.col(x).alias("x"), F.posexplode(F.array(*values)).alias("pv", "y"))
    terms = {"w": F.col("w"), "wx": F.col("w") * F.col("x"), "wxx": F.col("w") * F.col("x") * F.col("x"), "wy": F.col("w") * F.col("y"), "wxy": F.col("w") * F.col("x") * F.col("y")}
    cells = long.groupBy("pv", zone).agg(*[F.sum(t).alias(n) for n, t in terms.items()], *[F.sum(F.when(F.col(rep) == 1, t).otherwise(0.0)).alias(f"{n}1") for n, t in terms.items()])
    p = Window.partitionBy("pv")
    slope = lambda s: (s["w"] * s["wxy"] - s["wx"] * s["wy"]) / (s["w"] * s["wxx"] - s["wx"] * s["wx"])
    whole = {n: F.sum(n).over(p) for n in terms}
    cells = cells.withColumn("slope", slope(whole)).withColumn("replicate", slope({n: whole[n] - F.col(n) + 2 * F.col(f"{n}1") for n in terms}))
    each = cells.groupBy("pv").agg(F.first("slope").alias("slope"), F.sum(F.pow(F.col("replicate") - F.col("slope"), 2)).alias("sampling"))
    out = each.agg(F.avg("slope").alias("slope"), F.avg("sampling").alias("sampling"), F.var_samp("slope").alias("between"), F.count("*").alias("m"))
    return out.select("slope", F.sqrt(F.col("sampling") + (1 + 1 / F.col("m")) * F.col("between")).alias("se"))


def weighted_regression(rows: DataFrame, weight: str, terms: list[str], values: list[str], zone: str, rep: str, factors: list[str] = ()) -> DataFrame:
    """(term, slope, se) of weighted least squares on numbers, dummies of categories (``factor=level``, against the first level) and a constant, over plausible
    values, with jackknife variance and their combination. A row of the design is its non-zero entries; Spark sums the products of its pairs per
    (value, zone) and half, so that absent levels cost nothing; a group of as many rows as there are zones and pairs solves the normal
    equations of the whole and of each replicate. A term that those before it give (by the rank of the whole) has no slope."""
    import pandas as pd

    entry = lambda name, v: F.struct(name.alias("term"), v.cast("double").alias("v"))
    design = [entry(F.lit("constant"), F.lit(1.0)), *[entry(F.lit(t), F.col(t)) for t in terms], *[entry(F.concat(F.lit(f"{f}="), F.col(f).cast("string")), F.lit(1.0)) for f in factors]]
    sound = rows.dropna(subset=[*terms, *factors])
    first = sound.agg(*[F.min(f) for f in factors]).head() if factors else ()
    long = sound.select(zone, rep, F.col(weight).cast("double").alias("_w"), F.array(*design).alias("_z"), F.posexplode(F.array(*values)).alias("_pv", "_y")).filter("_y IS NOT NULL")
    pairs = F.flatten(F.transform("_z", lambda a: F.transform(F.concat("_z", F.array(entry(F.lit("_y"), F.col("_y")))), lambda b: F.struct(a["term"].alias("a"), b["term"].alias("b"), (a["v"] * b["v"]).alias("v")))))
    long = long.select("_pv", zone, rep, "_w", F.inline(pairs)).filter("v <> 0").withColumn("v", F.col("v") * F.col("_w"))
    cells = long.groupBy("_pv", F.col(zone).alias("zone"), "a", "b").agg(F.sum("v").alias("s"), F.sum(F.when(F.col(rep) == 1, F.col("v")).otherwise(0.0)).alias("h"))
    dropped = {f"{f}={v}" for f, v in zip(factors, first)}

    def each(part: pd.DataFrame) -> pd.DataFrame:
        names = ["constant", *terms, *sorted(set(part["a"]) - {"constant", *terms} - dropped)]
        at = {t: i for i, t in enumerate([*names, "_y"])}
        part = part[part["a"].isin(at) & part["b"].isin(at)]
        zones, where = np.unique(part["zone"], return_inverse=True)
        sums = np.zeros((2, len(zones), len(names), len(names) + 1))
        for k, c in enumerate(("s", "h")):
            sums[k, where, part["a"].map(at), part["b"].map(at)] = part[c]
        whole = sums[0].sum(0)
        kept, lower = [], np.zeros((0, 0))
        for i in range(len(names)):  # Cholesky by columns, without those that nothing is left of
            row = np.linalg.solve(lower, whole[kept, i]) if kept else np.zeros(0)
            rest = whole[i, i] - row @ row
            if rest > 1e-9 * whole[i, i]:
                lower = np.block([[lower, np.zeros((len(kept), 1))], [row[None, :], np.array([[np.sqrt(rest)]])]])
                kept.append(i)
        solved = lambda m: np.linalg.lstsq(m[np.ix_(kept, kept)], m[kept, -1], rcond=None)[0]
        beta = solved(whole)
        spread = sum((solved(whole - a + 2 * b) - beta) ** 2 for a, b in zip(*sums))
        return pd.DataFrame({"term": [names[i] for i in kept], "slope": beta, "sampling": spread})

    found = cells.groupBy("_pv").applyInPandas(each, "term string, slope double, sampling double")
    out = found.groupBy("term").agg(F.avg("slope").alias("slope"), F.avg("sampling").alias("sampling"), F.var_samp("slope").alias("between"), F.count("*").alias("m"))
    return out.select("term", "slope", F.sqrt(F.col("sampling") + (1 + 1 / F.col("m")) * F.coalesce("between", F.lit(0.0))).alias("se"))


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, shares: list[float], cells: int = 4096) -> DataFrame:
    """(keys, n, q0, q1...) of the interpolated quantiles of a number, nulls and rows with a null key aside, equal to ``percentile``: the values of each group are counted in ``cells`` of equal
    width between its ends, the cells that hold a wanted rank are cut again until they hold one value or few, and only those are ranked. No group of
    values meets in one task: a pass counts before the shuffle."""
    v = F.col(value).cast("double")
    group = list(keys) or ["_all"]
    rows = rows if keys else rows.withColumn("_all", F.lit(0))
    rows = written(rows.dropna(subset=group).filter(v.isNotNull()).select(*group, v.alias("_v")), "values")
    ends = written(rows.groupBy(*group).agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")), "ends")
    at = [(F.col("n") - 1) * F.lit(float(s)) for s in shares]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(x), F.ceil(x)) for x in at])))
    span = [*group, "lo", "hi"]
    # Open cells: those that hold a wanted rank (from 0), how many values stand below, and how many in them.
    cut = written(ends.select(*span, F.lit(0).cast("long").alias("below"), F.col("n").alias("here"), F.explode(ranks).alias("rank")), "cells")
    done = []
    while True:
        small = (F.col("lo") == F.col("hi")) | (F.col("here") <= cells)
        done.append(cut.filter(small))
        wide = cut.filter(~small)
        if wide.isEmpty():
            break
        number = F.least(F.lit(cells - 1), F.floor((F.col("_v") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / cells))).cast("int")
        inside = rows.join(wide.select(*span).distinct(), group).filter(F.col("_v").between(F.col("lo"), F.col("hi")))
        counts = inside.groupBy(*span, number.alias("cell")).agg(F.count("*").alias("c"), F.min("_v").alias("a"), F.max("_v").alias("b"))
        counts = counts.withColumn("before", F.sum("c").over(Window.partitionBy(*span).orderBy("cell")) - F.col("c"))  # one row a cell
        low = F.col("below") + F.col("before")
        cut = wide.join(counts, span).filter((F.col("rank") >= low) & (F.col("rank") < low + F.col("c")))
        cut = written(cut.select(*group, F.col("a").alias("lo"), F.col("b").alias("hi"), low.alias("below"), F.col("c").alias("here"), "rank"), "cells")
    last = written(reduce(DataFrame.unionByName, done), "cells")
    some = last.filter("lo < hi")
    inside = rows.join(some.select(*span, "below").distinct(), group).filter(F.col("_v").between(F.col("lo"), F.col("hi")))
    place = F.row_number().over(Window.partitionBy(*span).orderBy("_v")) - 1 + F.col("below")  # at most ``cells`` rows
    found = inside.withColumn("rank", place.cast("long")).join(some.select(*span, "rank"), [*span, "rank"]).select(*group, "rank", F.col("_v").alias("v"))
    found = found.unionByName(last.filter("lo = hi").select(*group, "rank", F.col("lo").alias("v")))
    both = ends.join(found.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("m")), group)
    low, high = [F.col("m")[F.floor(x)] for x in at], [F.col("m")[F.ceil(x)] for x in at]
    q = [F.when(F.floor(x) == F.ceil(x), a).otherwise((F.ceil(x) - x) * a + (x - F.floor(x)) * b) for x, a, b in zip(at, low, high)]
    return both.select(*keys, "n", *[c.alias(f"q{i}") for i, c in enumerate(q)])
