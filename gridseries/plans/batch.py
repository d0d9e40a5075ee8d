"""Series for a table of requests in one job.

Requests that interpolate between the same locations share a *stencil*, the sorted list of
those locations. The observations of a stencil are brought together once per day and used by
all its requests, so shuffled volume follows the number of stencils, not of requests, and the
weighted sums need no further shuffle.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.functions.values import square
from gridseries.operators.quality import drop_sentinel
from gridseries.operators.series import time_range
from gridseries.operators.space import cells_around, idw_weights, knn
from gridseries.operators.validate import unanswered, validate_requests
from gridseries.schema import CURRENT, HISTORIC, NEIGHBOURS, RADIUS_DEGREES, VARIABLES
from gridseries.session import ensure_checkpoint_dir, spread
from gridseries.sinks.writers import write_raw
from gridseries.sources.tables import scan_obs

TIERS = (HISTORIC, CURRENT)
# Requests of one stencil beyond this number are split into groups of their own.
GROUP_LIMIT = 20_000
# `place` is struct(source, stencil). As one column it stays the partitioning key of every step
# even where the source is a constant, which the optimizer would drop from a list of keys.
GROUP = ["place", "salt"]


def request_profile(requests: DataFrame) -> dict:
    """What the scan can be pruned by: sources, variables, time span and one-degree squares (one row).

    Only names of the dictionary are gathered, so the row has a bound; other names have to be passed to
    `extract_points` as `variables`. Raises if an id occurs twice: ranks, weights and answers go by id.
    """
    by_id = requests.groupBy("req_id").agg(
        F.count("*").alias("n"), F.first("source").alias("source"), F.first("vars").alias("vars"),
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.first(square(F.col("lat"), F.col("lon"))).alias("square"))
    exploded = by_id.select("n", "source", F.explode_outer("vars").alias("var"), "start_time", "end_time", "square")
    known = F.col("var").isin(sorted({v for names in VARIABLES.values() for v in names.values()}))
    served = F.col("source").isin(list(VARIABLES))
    row = exploded.agg(F.collect_set(F.when(served, F.col("source"))), F.collect_set(F.when(known, F.col("var"))), F.min("start_time"), F.max("end_time"), F.max("n"), F.collect_set("square")).first()
    if (row[4] or 0) > 1:
        raise ValueError("request ids are not unique")
    return {"sources": sorted(row[0]), "variables": sorted(row[1]), "start": row[2], "end": row[3], "squares": [tuple(s) for s in row[5]]}


def with_stencils(requests: DataFrame, catalogue: DataFrame, radius: float = RADIUS_DEGREES) -> DataFrame:
    """Each request with its neighbours (at most four) as parallel arrays of ids and weights."""
    k = F.when(F.col("mode") == "snap", 1).otherwise(NEIGHBOURS)
    slim = requests.select("req_id", "source", "lat", "lon", k.alias("k"), "vars", "start_time", "end_time")
    weighted = idw_weights(knn(slim, catalogue, NEIGHBOURS, radius))
    keys = ["req_id", "source", "vars", "start_time", "end_time"]
    near = weighted.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("loc_id", "weight"))).alias("near"))
    place = F.struct("source", F.col("near.loc_id").alias("stencil"))
    return near.select("req_id", "vars", "start_time", "end_time", place.alias("place"),
                       F.col("near.weight").alias("weights"))


def with_salt(requests: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Split the requests of crowded stencils into groups of about `group_limit`.

    Crowded stencils are fewer than requests / group_limit; they join without a hint.
    """
    crowded = (requests.groupBy("place").agg(F.count("*").alias("n"))
               .filter(F.col("n") > group_limit)
               .withColumn("salts", F.ceil(F.col("n") / group_limit)))
    salted = requests.join(crowded.drop("n"), "place", "left")
    salt = F.pmod(F.xxhash64("req_id"), F.coalesce("salts", F.lit(1)))
    return salted.withColumn("salt", salt).drop("salts")


def by_day(requests: DataFrame) -> DataFrame:
    start, end = F.to_date("start_time"), F.to_date("end_time")
    days = F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day")))
    return requests.withColumn("day", F.explode(days))


def stencil_values(obs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per (group, time) with `cells`, the complete variables there: (var, values by stencil position).

    `groups` has distinct (place, salt, day). A variable is complete if one tier has a row for every
    location of the stencil; history is taken before the current tier. The number of aggregates
    does not depend on the number of variables.
    """
    members = groups.selectExpr(*GROUP, "day", "place.source", "posexplode(place.stencil) as (pos, loc_id)")
    rows = obs.select("source", "loc_id", "time", "var", "value", F.to_date("time").alias("day"),
                      (F.col("tier") == CURRENT).alias("current"))
    # estimates take rows from small files for small, and a broadcast would then hold all of them in every task
    hits = rows.hint("merge").join(members, ["source", "loc_id", "day"])
    # all rows of a group and day come together here; what follows stays in place
    together = spread(hits, *GROUP, "day")
    aggregates = []
    for name, test in (("history", "not current"), ("current", "current")):
        aggregates.append(f"bit_or(case when {test} then shiftleft(1, pos) end) as has_{name}")
        aggregates += [f"max(case when {test} and pos = {p} then value end) as {name}_{p}" for p in range(NEIGHBOURS)]
    tiers = together.groupBy(*GROUP, "day", "time", "var").agg(*[F.expr(a) for a in aggregates])

    def full(name: str):
        return F.coalesce(F.expr(f"has_{name} = shiftleft(1, size(place.stencil)) - 1"), F.lit(False))

    def at_positions(name: str):
        return F.array(*[f"{name}_{p}" for p in range(NEIGHBOURS)])

    chosen = F.when(full("history"), at_positions("history")).otherwise(at_positions("current"))
    complete = tiers.filter(full("history") | full("current")).withColumn("values", chosen)
    return complete.groupBy(*GROUP, "day", "time").agg(F.collect_list(F.struct("var", "values")).alias("cells"))


def _weighted(weights, values):
    """Sum over the stencil's positions; null if one of its values is."""
    products = F.zip_with(weights, F.slice(values, F.lit(1), F.size(weights)), lambda w, v: w * v)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _extract(requests: DataFrame, obs: DataFrame, catalogue: DataFrame, variables: list[str] | None,
             radius: float, profile: dict | None = None, group_limit: int = GROUP_LIMIT) -> tuple[DataFrame, list[str]]:
    """(req_id, time, answers) with one (var, value) for each variable of the request, and the variables' names."""
    profile = profile or request_profile(requests)
    variables = variables or profile["variables"]
    if not variables:
        nothing = F.lit(None).cast("array<struct<var: string, value: double>>").alias("answers")
        return requests.filter(F.lit(False)).select("req_id", F.lit(None).cast("timestamp_ntz").alias("time"), "vars", nothing), []
    rows = obs.filter(F.col("var").isin(variables) & F.col("source").isin(profile["sources"])
                      & F.col("tier").isin(*TIERS))
    rows = time_range(rows, profile["start"], profile["end"])
    # read several times below; without the cut, the neighbour search would run for each of them
    ensure_checkpoint_dir(requests.sparkSession)
    near = with_stencils(requests, catalogue, radius).checkpoint()
    daily = spread(by_day(with_salt(near, group_limit)), *GROUP, "day")
    shared = stencil_values(drop_sentinel(rows), daily.select(*GROUP, "day").distinct())
    joined = shared.join(daily, [*GROUP, "day"]).filter("time between start_time and end_time")
    wanted = joined.withColumn("cells", F.filter("cells", lambda c: F.array_contains("vars", c["var"])))
    answers = F.transform("cells", lambda c: F.struct(c["var"].alias("var"), _weighted(F.col("weights"), c["values"]).alias("value")))
    # a time needs every variable of the request
    full = wanted.filter(F.size("cells") == F.size("vars")).select("req_id", "time", "vars", answers.alias("answers"))
    return full, variables


def _wide(answers: DataFrame, variables: list[str]) -> DataFrame:
    by_name = F.map_from_entries("answers")
    return answers.select("req_id", "time", *[F.try_element_at(by_name, F.lit(v)).alias(v) for v in variables])


def extract_points(requests: DataFrame, obs: DataFrame, catalogue: DataFrame, variables: list[str] | None = None,
                   radius: float = RADIUS_DEGREES, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Wide results (req_id, time, one column per variable) for accepted requests.

    `requests` has (req_id, source, lat, lon, vars, start_time, end_time, mode) with unique ids.
    Variables a request did not ask for are null in its rows. A few small jobs over the requests run
    at once; the result is lazy. `group_limit` bounds the requests that share one copy of a stencil's
    rows; the result does not depend on it.
    """
    return _wide(*_extract(requests, obs, catalogue, variables, radius, None, group_limit))


def extract_stored(spark: SparkSession, path: str, requests: DataFrame, catalogue: DataFrame,
                   radius: float = RADIUS_DEGREES) -> DataFrame:
    """`extract_points` over a written table, reading only the partitions and neighbourhoods the requests need."""
    need = request_profile(requests)
    obs = scan_obs(spark, path, need["sources"], TIERS, need["variables"], start=need["start"], end=need["end"], cells=cells_around(need["squares"], radius))
    return _wide(*_extract(requests, obs, catalogue, None, radius, need))


def extract_series(requests: DataFrame, obs: DataFrame, catalogue: DataFrame, variables: list[str] | None = None,
                   radius: float = RADIUS_DEGREES, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Long results (req_id, time, var, value), only for the variables each request asked for."""
    answers, _ = _extract(requests, obs, catalogue, variables, radius, None, group_limit)
    return answers.select("req_id", "time", F.inline("answers"))


def extract_answers(requests: DataFrame, obs: DataFrame, catalogue: DataFrame, variables: list[str] | None = None,
                    radius: float = RADIUS_DEGREES, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(req_id, time, answers) with one (var, value) for each variable, in the order the request names them."""
    answers, _ = _extract(requests, obs, catalogue, variables, radius, None, group_limit)
    in_order = F.transform("vars", lambda v: F.filter("answers", lambda a: a["var"] == v)[0])
    return answers.select("req_id", "time", in_order.alias("answers"))


def run_requests(raw: DataFrame, obs: DataFrame, catalogue: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Validate text requests and extract the good ones: (results, rejected with reason).

    The results are written to `path` once and read from there, also to find requests without any.
    """
    accepted, rejected = validate_requests(raw)
    write_raw(extract_points(accepted, obs, catalogue), path)
    results = raw.sparkSession.read.parquet(path)
    return results, rejected.unionByName(unanswered(accepted, results))
