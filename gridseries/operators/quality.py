"""Sentinels, gaps, keys and coverage."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridseries.functions import times, values
from gridseries.schema import OBS_KEY, SERIES


def drop_sentinel(obs: DataFrame) -> DataFrame:
    """Remove sentinel rows; rows with a null value stay."""
    return obs.filter(~values.is_sentinel(F.col("value")))


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows with a null or NaN in any column, auxiliary columns included."""
    return df.na.drop("any")


def series_stats(obs: DataFrame, stats: dict[str, Column]) -> DataFrame:
    """One row of statistics per series. `stats` maps a name to an aggregate over rows.

    The aggregates are combined before the shuffle, so a long series never meets in one task.
    """
    return obs.groupBy(*SERIES).agg(*[a.alias(n) for n, a in stats.items()])


def with_series_stats(rows: DataFrame, stats: DataFrame, how: str = "left") -> DataFrame:
    """Attach them by series. Adaptive execution splits the rows of long ones over several tasks."""
    return rows.join(stats, SERIES, how)


def trim_trailing(obs: DataFrame) -> DataFrame:
    """Cut each series after its last time that is not a sentinel; a null counts as seen.

    Only sentinels can lie beyond that time, so only they are joined to it. All other rows pass
    straight through.
    """
    sentinel = values.is_sentinel(F.col("value"))
    last = series_stats(obs, {"_last": F.max(F.when(~sentinel, F.col("time")))})
    inner_gaps = with_series_stats(obs.filter(sentinel), last, "inner").filter(F.col("time") <= F.col("_last"))
    return obs.filter(~sentinel).unionByName(inner_gaps.drop("_last"))


# rows of one series and hour of day; the location comes first, as it tells most rows apart when they are sorted.
# `_of` is (source, var): Spark takes a literal source out of some keys only, and would shuffle the rows again
HOUR_KEY = ["loc_id", "_hour", "_of"]


def _gap_bounds(rows: DataFrame) -> DataFrame:
    """Per series, repeated for each of its hours: its last time that is no sentinel, and its first sentinel.

    `rows` lie together by `HOUR_KEY`, so they are not moved for this, only one row per key is.
    """
    time, sentinel = F.col("time"), values.is_sentinel(F.col("value"))
    per_hour = rows.groupBy(*HOUR_KEY).agg(
        F.max(F.when(~sentinel, time)).alias("_last"), F.min(F.when(sentinel, time)).alias("_gap"))
    series = Window.partitionBy("loc_id", "_of")
    return per_hour.select(*HOUR_KEY, F.max("_last").over(series).alias("_last"), F.min("_gap").over(series).alias("_gap"))


def _filled(value: Column) -> Column:
    """Previous valid value at this hour, else the next one.

    Where none precedes, the next valid value is the first one of the series at that hour.
    """
    hour = Window.partitionBy(*HOUR_KEY)
    so_far = hour.orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    whole = hour.orderBy("time").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    good = F.when(values.is_valid(value), value)
    return F.coalesce(F.last(good, ignorenulls=True).over(so_far), F.first(good, ignorenulls=True).over(whole))


def fill_by_hour(obs: DataFrame, trim: bool = False) -> DataFrame:
    """Replace sentinels by the previous valid value at the same hour of day, else the next.

    Nulls are filled too, but only in a series that also holds a sentinel. A gap with no valid
    value at its hour becomes null. With `trim`, trailing sentinels are cut first.

    One shuffle and one sort of the rows, by (series, hour): one row a day of an hourly series. The bounds
    of whole series come from the same shuffle; the window's order is the one the join needs.
    """
    time = F.col("time")
    # an hour that cannot be null keeps the join from adding a filter to one of the two uses of the shuffle
    rows = obs.dropna(subset=[*SERIES, "time"]).withColumns({
        "value": values.nan_to_null(F.col("value")), "_hour": F.coalesce(F.hour(time), F.lit(0)), "_of": F.struct("source", "var")})
    rows = rows.drop("source", "var").repartition(*HOUR_KEY)
    joined = rows.withColumn("_filled", _filled(F.col("value"))).join(_gap_bounds(rows).hint("merge"), HOUR_KEY)
    if trim:
        joined = joined.filter(time <= F.col("_last"))
        has_gap = F.coalesce(F.col("_gap") <= F.col("_last"), F.lit(False))
    else:
        has_gap = F.col("_gap").isNotNull()
    filled = joined.select("*", "_of.*").withColumn("value", F.when(has_gap, F.col("_filled")).otherwise(F.col("value")))
    return filled.select(obs.columns)


def any_sentinel(obs: DataFrame) -> DataFrame:
    """Per series: does it hold a sentinel?"""
    return obs.groupBy(*SERIES).agg(F.bool_or(values.is_sentinel(F.col("value"))).alias("any_sentinel"))


def unique_violations(df: DataFrame, keys: list[str] = OBS_KEY) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def coverage(obs: DataFrame, catalogue: DataFrame, variables: list[str]) -> DataFrame:
    """Rows per (source, variable, location) of the catalogue; 0 where there are none."""
    expected = catalogue.select(
        "source", F.explode(F.array(*[F.lit(v) for v in variables])).alias("var"), "loc_id")
    counts = obs.groupBy(*SERIES).agg(F.count("*").alias("n"))
    return (expected.join(counts, SERIES, "left")
            .select(*SERIES, F.coalesce("n", F.lit(0)).alias("n")))


def series_mismatch(current: DataFrame, historic: DataFrame) -> DataFrame:
    """Series present in only one of the two tiers."""
    both = (current.select(*SERIES, F.lit(1).alias("c"), F.lit(0).alias("h"))
            .unionByName(historic.select(*SERIES, F.lit(0).alias("c"), F.lit(1).alias("h"))))
    seen = both.groupBy(*SERIES).agg(F.max("c").alias("c"), F.max("h").alias("h"))
    side = F.when(F.col("h") == 0, "current").otherwise("historic")
    return seen.filter("c <> h").select(*SERIES, side.alias("only_in"))
