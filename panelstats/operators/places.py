"""The nearest of many sites for many points."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelstats.sources import written


def nearest(points: DataFrame, sites: DataFrame, stretch: float = 1.0) -> DataFrame:
    """(id, site, d) of points (id, x, y) and sites (site, x, y): the site with the least ((x - x') * stretch)^2 + (y - y')^2, the smaller on ties; ids are
    unique. Points without coordinates, or where there are no sites, have none.

    Sites and points fall into cells of a grid. A point meets the sites of its own and the eight cells around; every other site is
    further than a cell's width, so that a nearer one found is proved the nearest. The other points go on in a grid of twice the width.
    No list of all sites exists anywhere, and a round shuffles only points that are still open."""
    x, y = F.col("x") * stretch, F.col("y")
    sites = written(sites.dropna(subset=["x", "y"]).select("site", F.col("x").alias("sx"), F.col("y").alias("sy")), "sites")
    points = written(points.select("id", "x", "y"), "points")
    n, left, right, low, high = sites.agg(F.count("*"), F.min(F.col("sx") * stretch), F.max(F.col("sx") * stretch), F.min("sy"), F.max("sy")).head()
    schema = f"id {dict(points.dtypes)['id']}, site {dict(sites.dtypes)['site']}, d double"
    none = points.select("id", F.lit(None).cast(dict(sites.dtypes)["site"]).alias("site"), F.lit(None).cast("double").alias("d"))
    if not n:
        return none
    open_ = points.filter("x IS NOT NULL AND y IS NOT NULL")
    found = [none.join(open_.select("id"), "id", "left_anti")]
    width = max(right - left, high - low) / math.sqrt(n) / 2 or 1.0
    while True:
        at = lambda c: F.floor(c / F.lit(width)).cast("long")  # noqa: B023, E731
        near = F.array(*[F.lit(i) for i in (-1, 0, 1)])
        around = open_.select("*", F.explode(F.transform(near, lambda i: at(x) + i)).alias("cx")).select("*", F.explode(F.transform(near, lambda i: at(y) + i)).alias("cy"))
        cells = sites.select("*", at(F.col("sx") * stretch).alias("cx"), at(F.col("sy")).alias("cy"))
        d = F.pow((F.col("x") - F.col("sx")) * stretch, 2) + F.pow(F.col("y") - F.col("sy"), 2)
        best = around.join(cells, ["cx", "cy"]).groupBy("id").agg(F.min(F.struct(d.alias("d"), "site")).alias("b"))
        both = written(open_.join(best, "id", "left"), "nearest")
        proved = F.coalesce(F.col("b.d") < F.lit(width * width * (1 - 1e-9)), F.lit(False))
        found.append(both.filter(proved).select("id", "b.site", "b.d"))
        open_ = both.filter(~proved).select("id", "x", "y")
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, found).to(points.sparkSession.createDataFrame([], schema).schema)
        width *= 2
