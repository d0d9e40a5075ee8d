"""Series at one point."""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.operators.quality import drop_sentinel
from gridseries.operators.series import time_range
from gridseries.operators.space import cells_around, nearest
from gridseries.schema import CURRENT, HISTORIC, NEIGHBOURS, RADIUS_DEGREES
from gridseries.sources.tables import scan_obs


def point_weights(catalogue: DataFrame, lat: float, lon: float, mode: str = "idw",
                  radius: float = RADIUS_DEGREES) -> list[tuple[int, float]]:
    """(location, weight) of at most four neighbours, fetched to the driver.

    They become literals of the query, so the scan can skip row groups by location.
    """
    k = 1 if mode.lower() == "snap" else NEIGHBOURS
    found = nearest(catalogue, lat, lon, k, radius).select("loc_id", "d").collect()
    if found and found[0]["d"] == 0:
        return [(found[0]["loc_id"], 1.0)]
    total = sum(1 / row["d"] for row in found)
    return [(row["loc_id"], 1 / row["d"] / total) for row in found]


def point_series(obs: DataFrame, catalogue: DataFrame, source: str, lat: float, lon: float,
                 variables: list[str], start, end, mode: str = "idw") -> DataFrame:
    """Time and one column per variable, sorted by time.

    Within a tier a time needs all neighbours; history wins over the current tier; a time needs
    every variable. One grouped pass over the neighbours' rows does all of it.
    """
    variables = list(dict.fromkeys(variables))
    weights = point_weights(catalogue.filter(F.col("source") == source), lat, lon, mode)
    rows = obs.filter((F.col("source") == source) & F.col("var").isin(variables)
                      & F.col("loc_id").isin([loc for loc, _ in weights]))
    rows = drop_sentinel(time_range(rows, start, end))
    weight = reduce(lambda rest, lw: F.when(F.col("loc_id") == lw[0], F.lit(lw[1])).otherwise(rest),
                    weights, F.lit(0.0))
    rows = rows.withColumn("share", F.col("value") * weight)

    def per_tier(var: str, tier: str) -> tuple[Column, Column, Column]:
        here = (F.col("var") == var) & (F.col("tier") == tier)
        return (F.count(F.when(here, F.lit(1))), F.count(F.when(here, F.col("share"))),
                F.sum(F.when(here, F.col("share"))))

    aggregates = {}
    for i, var in enumerate(variables):
        for tier in (HISTORIC, CURRENT):
            for name, agg in zip(("rows", "values", "sum"), per_tier(var, tier)):
                aggregates[f"{tier}_{name}_{i}"] = agg
    k = len(weights)
    grouped = rows.groupBy("time").agg(*[a.alias(n) for n, a in aggregates.items()])

    def full(tier: str, i: int) -> Column:
        return F.col(f"{tier}_rows_{i}") == k

    def value(tier: str, i: int) -> Column:
        return F.when(F.col(f"{tier}_values_{i}") == k, F.col(f"{tier}_sum_{i}"))

    present = [full(HISTORIC, i) | full(CURRENT, i) for i in range(len(variables))]
    columns = [F.when(full(HISTORIC, i), value(HISTORIC, i)).otherwise(value(CURRENT, i)).alias(v)
               for i, v in enumerate(variables)]
    return (grouped.filter(reduce(lambda a, b: a & b, present))
            .select("time", *columns).orderBy("time"))


def point_stored(spark: SparkSession, path: str, catalogue: DataFrame, source: str, lat: float, lon: float,
                 variables: list[str], start, end, mode: str = "idw") -> DataFrame:
    """`point_series` over a written table, reading only the partitions it needs."""
    around = cells_around([(min(179, max(0, math.floor(lat + 90))), min(359, max(0, math.floor(lon + 180))))])
    obs = scan_obs(spark, path, source, [HISTORIC, CURRENT], variables, start=start, end=end, cells=around)
    return point_series(obs, catalogue, source, lat, lon, variables, start, end, mode)


def preview(obs: DataFrame, source: str, var: str, loc_id: int, start=None, end=None) -> DataFrame:
    """One stored series, or a slice of it."""
    one = obs.filter((F.col("source") == source) & (F.col("var") == var) & (F.col("loc_id") == loc_id))
    if start is not None:
        one = time_range(one, start, end)
    return one.orderBy("tier", "time")
