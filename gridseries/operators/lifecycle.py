"""Resume times, cutoffs, backfill rows and landing manifests."""

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.functions import names, times
from gridseries.operators.quality import series_stats, with_series_stats
from gridseries.operators.series import union_priority
from gridseries.schema import DEFAULT_START, KEEP_MONTHS, OBS_KEY, OBS_SCHEMA, SERIES


def resume_times(obs: DataFrame, key: str, now) -> DataFrame:
    """Per source and key: the earliest of the latest times of its series, at most `now`."""
    latest = obs.groupBy(*SERIES).agg(F.max("time").alias("time"))
    return latest.groupBy("source", key).agg(F.least(F.min("time"), times.as_time(now)).alias("time"))


def months_kept(source: Column) -> Column:
    pairs = chain.from_iterable((F.lit(s), F.lit(m)) for s, m in KEEP_MONTHS.items())
    return F.create_map(*pairs)[source]


def cutoff(latest: Column, source: Column) -> Column:
    """Rows before this are settled."""
    return times.month_floor(latest, months_kept(source))


def mark_settled(current: DataFrame, force: bool = False) -> DataFrame:
    """Add `settled`: is the row older than the cutoff of its series?

    Sources without a cutoff rule never settle.
    """
    if force:
        return current.withColumn("settled", F.lit(True))
    out = with_series_stats(current, series_stats(current, {"_latest": F.max("time")}))
    settled = F.col("time") < cutoff(F.col("_latest"), F.col("source"))
    return out.withColumn("settled", F.coalesce(settled, F.lit(False))).drop("_latest")


def replaced(newer: DataFrame, older: DataFrame) -> DataFrame:
    """Rows of one tier after newer ones have replaced those they meet."""
    return union_priority(newer.select(OBS_SCHEMA.names), older.select(OBS_SCHEMA.names), OBS_KEY, ["loc_id", "time"])


def remaining_current(marked: DataFrame) -> DataFrame:
    return marked.filter(~F.col("settled")).drop("settled")


def resume_or_default(keys: DataFrame, resume: DataFrame, key: str, default: str = DEFAULT_START) -> DataFrame:
    """Every key with its resume time; a key without history starts at the default."""
    start = F.coalesce("time", times.as_time(default))
    return (keys.join(resume, ["source", key], "left")
            .select(*[F.col(c) for c in keys.columns], start.alias("resume")))


def backfill_months(keys: DataFrame, end) -> DataFrame:
    """One row per key and calendar month to fetch. `keys` has (source, <key>, resume)."""
    end = times.as_time(end).cast("date")
    first = times.month_floor(F.col("resume"), months_kept(F.col("source"))).cast("date")
    months = F.when(first <= end, F.sequence(first, end, F.expr("interval 1 month")))
    rows = keys.withColumn("_month", F.explode(months))
    return rows.withColumns({"year": F.year("_month"), "month": F.month("_month")}).drop("_month", "resume")


def by_month(plan: DataFrame) -> DataFrame:
    """Plan rows in the order they are fetched in."""
    return plan.orderBy("year", "month", "var")


def distinct_months(days: DataFrame, column: str) -> DataFrame:
    return days.select(F.year(column).alias("year"), F.month(column).alias("month")).distinct()


def backfill_years(keys: DataFrame, end) -> DataFrame:
    """One row per key and calendar year to fetch, clamped to the range, with date keys."""
    end = times.as_time(end).cast("date")
    first = times.month_floor(F.col("resume"), months_kept(F.col("source"))).cast("date")
    years = F.when(first <= end, F.sequence(F.year(first), F.year(end)))
    rows = keys.withColumns({"_first": first}).withColumn("year", F.explode(years))
    start = F.greatest(F.col("_first"), F.make_date("year", F.lit(1), F.lit(1)))
    stop = F.least(end, F.make_date("year", F.lit(12), F.lit(31)))
    return rows.withColumns({
        "start_date": times.date_key(start), "end_date": times.date_key(stop)}).drop("_first", "resume")


def active_stations(meta: DataFrame, owner: str, since: str) -> DataFrame:
    reporting = times.parse_station_time(F.col("to_date")) >= times.as_time(since)
    return meta.filter((F.col("owner") == owner) & reporting)


def not_landed(items: DataFrame, manifest: DataFrame, key: str | list[str]) -> DataFrame:
    return items.join(manifest, key, "left_anti")


def has_raw(items: DataFrame, manifest: DataFrame, key: str | list[str]) -> DataFrame:
    return items.join(manifest, key, "left_semi")


def grid_requests(months: DataFrame) -> DataFrame:
    """File name and variable of each month to fetch; `var` is the conformed name."""
    asked = names.request_name(F.col("var"))
    return months.withColumns({
        "request_name": asked, "file_name": names.grid_file(asked, F.col("year"), F.col("month")),
        "days": times.month_days(F.col("year"), F.col("month"))})
