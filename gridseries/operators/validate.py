"""Request validation."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.functions import times, values
from gridseries.schema import SERVED_SOURCES, served_variables


def _allowed(source: Column) -> Column:
    out = F.lit(None).cast("array<string>")
    for name in SERVED_SOURCES:
        out = F.when(source == name, F.array(*[F.lit(v) for v in served_variables(name)])).otherwise(out)
    return out


def checked_requests(raw: DataFrame) -> DataFrame:
    """Parse the text fields and name the first thing wrong with each request, if any.

    An id that several requests share is no id, so all of them are refused. Checks run in a fixed
    order: id given and unique, source given, source known, coordinates given, numeric,
    variables given, known for the source, dates. Any mode but `snap` means `idw`.
    """
    source = F.lower("data_source")
    lat, lon = values.strict_double(F.col("lat")), values.strict_double(F.col("lon"))
    asked = F.split("var_name", ",")
    start, end = times.iso_date(F.col("start_date")), times.iso_date(F.col("end_date"))
    parsed = raw.select(
        "req_id", source.alias("source"), lat.alias("lat"), lon.alias("lon"),
        F.array_distinct(asked).alias("vars"),
        F.filter(asked, lambda v: ~F.array_contains(_allowed(source), v)).alias("_unknown"),
        times.day_start(start).alias("start_time"), times.day_end(end).alias("end_time"),
        F.when(F.lower("interp_mode") == "snap", "snap").otherwise("idw").alias("mode"),
        (F.col("lat").isNull() | F.col("lon").isNull()).alias("_no_place"))
    known = F.col("source").isin(SERVED_SOURCES)
    numeric = values.is_finite(F.col("lat")) & values.is_finite(F.col("lon"))
    problems = [
        (F.col("req_id").isNull(), F.lit("req_id is missing")),
        (F.col("_again").isNotNull(), F.lit("req_id is not unique")),
        (F.col("source").isNull(), F.lit("data_source is missing")),
        (~known, F.lit("data_source is unknown")),
        (F.col("_no_place"), F.lit("lat or lon is missing")),
        (~numeric, F.lit("lat and lon must be finite numbers")),
        (F.col("vars").isNull(), F.lit("var_name is missing")),
        (F.size("_unknown") > 0, F.concat(F.lit("unknown var_name: "), F.array_join("_unknown", ", "))),
        (F.col("start_time").isNull() | F.col("end_time").isNull(),
         F.lit("dates must exist and be written YYYY-MM-DD")),
    ]
    first = reduce(lambda rest, p: F.when(p[0], p[1]).otherwise(rest), reversed(problems),
                   F.lit(None).cast("string"))
    again = raw.groupBy("req_id").agg(F.count("*").alias("_again")).filter(F.col("_again") > 1)
    return parsed.join(again, "req_id", "left").withColumn("error", first).drop("_unknown", "_no_place", "_again")


def validate_requests(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests that can run, rejected requests with their error)."""
    checked = checked_requests(raw)
    accepted = checked.filter(F.col("error").isNull()).drop("error")
    return accepted, checked.filter(F.col("error").isNotNull()).select("req_id", "error")


def unanswered(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Accepted requests for which nothing was found."""
    answered = results.select("req_id").distinct()
    return (requests.join(answered, "req_id", "left_anti")
            .select("req_id", F.lit("no values near the point in the date range").alias("error")))
