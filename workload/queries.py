"""Check queries: each pairs a Spark query with the SQL that must give the same rows."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.functions import names, times, values
from gridseries.operators import lifecycle, quality, series, shape, space, validate
from gridseries.plans import backfill, batch, ingest, point, promote
from gridseries.schema import (
    KEEP_MONTHS, SERVED_SOURCES, VARIABLES, coordinate_fixes, served_variables, variables)
from gridseries.session import ensure_checkpoint_dir
from gridseries.sinks import writers
from gridseries.sources import raw, tables
from workload.views import oracle, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LAT, LON = -44.8, 170.9
POINT_VARS = ["temperature_2m", "relative_humidity_2m"]
NOW = "2024-04-10 05:00:00"


def check(sql: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = oracle(sql)
        return fn
    return register


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "requests").withColumn("vars", F.split("var_name", ",")).drop("var_name")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the session's checkpoint folder, for queries that write and read back."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


# ---- sources and projections -----------------------------------------------------------

@check("""select loc_id, time, value from series
          where var = 'temperature_2m' and tier = 'historic'
            and time between timestamp '2024-01-02 00:00:00' and timestamp '2024-01-02 23:00:00'""")
def scan_time_range(spark, sf):
    obs = view(spark, sf, "series").filter("var = 'temperature_2m' and tier = 'historic'")
    return series.time_range(obs, "2024-01-02 00:00:00", "2024-01-02 23:00:00").select("loc_id", "time", "value")


@check("select distinct time from series")
def scan_time_only(spark, sf):
    return view(spark, sf, "series").select("time").distinct()


@check("select loc_id, time, value from obs")
def drop_index_artifacts(spark, sf):
    foreign = view(spark, sf, "obs").withColumn("__index_level_0__", F.col("hr")).drop("hr", "k")
    return tables.drop_index_artifacts(foreign)


@check("""select loc_id, strftime(time, '%Y%m%d%H') as hour_key, time, value from obs""")
def parse_payload(spark, sf):
    stamped = view(spark, sf, "obs").withColumn("hour_key", F.date_format("time", "yyyyMMddHH"))
    by_hour = F.map_from_entries(F.collect_list(F.struct("hour_key", "value")))
    # one payload per location and day
    packed = (stamped.groupBy("loc_id", F.to_date("time").alias("day")).agg(by_hour.alias("T2M"))
              .select("loc_id", F.to_json(F.struct(F.struct(F.struct("T2M").alias("parameter"))
                                                   .alias("properties"))).alias("payload")))
    rows = raw.parse_point_payload(packed, "payload", ["loc_id"])
    return rows.select("loc_id", F.date_format("time", "yyyyMMddHH").alias("hour_key"), "time", "value")


@check("""select g.loc_id, 'temperature_2m' as var, valid_time as time, round(t2m - 273.15, 4) as value
          from grid_raw r join grid g
            on cast(round(cast(r.longitude as double) * 1000) as bigint) = cast(round(g.longitude * 1000) as bigint)
           and cast(round(cast(r.latitude as double) * 1000) as bigint) = cast(round(g.latitude * 1000) as bigint)
          where t2m is not null""")
def ingest_grid(spark, sf):
    catalogue = view(spark, sf, "grid").withColumn("source", F.lit("era5"))
    rows = ingest.ingest_grid(view(spark, sf, "grid_raw"), catalogue, "era5")
    return rounded(rows.select("loc_id", "var", "time", "value"), "value")


@check("""select file_name, split_part(file_name, '_!_', 1) as var,
                 split_part(split_part(file_name, '_!_', -1), '.', 1) as ref from station_files""")
def file_tokens(spark, sf):
    name = F.col("file_name")
    return view(spark, sf, "station_files").select(
        "file_name", names.station_var(name).alias("var"), names.station_ref(name).alias("ref"))


@check("""select event_id, file_name from station_files
          where starts_with(file_name, 'purchase') and ends_with(file_name, '.h5')""")
def match_files(spark, sf):
    return raw.match_files(view(spark, sf, "station_files"), prefix="purchase", extension="h5")


@check("""select l_orderkey, l_linenumber, l_suppkey as loc_id, l_shipdate as valid_at, l_quantity as runoff
          from lineitem""")
def value_column_by_position(spark, sf):
    item = spark.read.parquet(f"{sf}/lineitem.parquet")
    picked = item.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("loc_id"),
                         F.col("l_shipdate").alias("valid_at"), "l_quantity")
    return shape.name_value_column(picked, "runoff")


@check("select * exclude (k, hr) from obs")
def all_columns_but(spark, sf):
    return shape.all_but(view(spark, sf, "obs"), "k", "hr")


@check("""select loc_id, time, var, value from daily""")
def wide_to_long(spark, sf):
    return shape.wide_to_long(view(spark, sf, "daily_wide"), ["loc_id", "time"]).select(
        "loc_id", "time", "var", "value")


@check("""select tier, loc_id, time, max(case when var = 'temperature_2m' then value end) as temperature_2m,
                 max(case when var = 'relative_humidity_2m' then value end) as relative_humidity_2m
          from series group by tier, loc_id, time having count(distinct var) = 2""")
def long_to_wide(spark, sf):
    return shape.series_to_wide(view(spark, sf, "series"), ["tier", "loc_id", "time"], POINT_VARS)


@check("""select event_id, case when event_type = 'click' then 'temperature_2m'
                                when event_type = 'view' then 'precipitation' else event_type end as var,
                 round(case when event_type = 'click' then value - 273.15 else value end, 4) as value
          from events""")
def conform_names(spark, sf):
    short = names.literal_map({"click": "t2m", "view": "tp"})
    rows = spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", "value", F.lit("era5_land").alias("source"),
        F.coalesce(F.try_element_at(short, F.col("event_type")), F.col("event_type")).alias("raw_name"))
    return rounded(shape.conform_names(rows, variables(spark), convert=True), "value").select(
        "event_id", "var", "value")


@check("""select var, ref, case when ref = 'timaru_coastal_hv' and var = 'relative_humidity_2m'
                                then -44.30493 else latitude end as latitude,
                 case when ref = 'timaru_coastal_hv' and var = 'relative_humidity_2m'
                      then 171.22158 else longitude end as longitude, time, value
          from station_rows""")
def correct_coords(spark, sf):
    return shape.correct_coords(view(spark, sf, "station_rows"), coordinate_fixes(spark)).select(
        "var", "ref", "latitude", "longitude", "time", "value")


# ---- cleaning --------------------------------------------------------------------------

@check("select loc_id, time, value from obs where value is distinct from -999")
def drop_sentinel(spark, sf):
    return quality.drop_sentinel(view(spark, sf, "obs")).select("loc_id", "time", "value")


@check("select longitude, latitude, valid_time, t2m from grid_raw where t2m is not null")
def drop_null_rows(spark, sf):
    return quality.drop_null_rows(view(spark, sf, "grid_raw")).select(
        "longitude", "latitude", "valid_time", "t2m")


@check("""with marked as (
            select *, max(case when value is distinct from -999 then time end)
                      over (partition by source, var, loc_id) as last_seen from daily)
          select var, loc_id, time, value from marked where time <= last_seen""")
def trim_trailing(spark, sf):
    return quality.trim_trailing(view(spark, sf, "daily")).select("var", "loc_id", "time", "value")


FILL = """with marked as (
            select *, max(case when value is distinct from -999 then time end)
                      over (partition by source, var, loc_id) as last_seen from {table}),
          kept as (
            select source, var, loc_id, time, value, case when value <> -999 then value end as good,
                   max(case when value = -999 then 1 else 0 end) over (partition by source, var, loc_id) as gaps
            from marked where {trim}),
          filled as (
            select source, var, loc_id, time, case when gaps = 1 then coalesce(
                     last_value(good ignore nulls) over (partition by source, var, loc_id, hour(time) order by time
                       rows between unbounded preceding and current row),
                     first_value(good ignore nulls) over (partition by source, var, loc_id, hour(time) order by time
                       rows between current row and unbounded following)) else value end as value
            from kept)
          select var, loc_id, time, value from filled"""


@check(FILL.format(table="daily", trim="true"))
def fill_by_hour(spark, sf):
    return quality.fill_by_hour(view(spark, sf, "daily")).select("var", "loc_id", "time", "value")


@check(FILL.format(table="daily", trim="time <= last_seen") + " where value is distinct from -999")
def clean_point(spark, sf):
    return ingest.clean_point(view(spark, sf, "daily")).select("var", "loc_id", "time", "value")


@check("""select var, loc_id, bool_or(value is not distinct from -999) as any_sentinel
          from daily group by var, loc_id""")
def any_sentinel(spark, sf):
    return quality.any_sentinel(view(spark, sf, "daily")).select("var", "loc_id", "any_sentinel")


@check("""select l_suppkey as loc_id, l_shipdate as time, count(*) as n from lineitem
          group by 1, 2 having count(*) > 1""")
def unique_violations(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_suppkey").alias("loc_id"), F.col("l_shipdate").alias("time"))
    return quality.unique_violations(rows, ["loc_id", "time"])


@check("""with expected as (select 'era5' as source, loc_id, unnest(['runoff', 'snowfall', 'soil_type']) as var
                            from grid)
          select e.var, e.loc_id, count(c.time) as n
          from expected e left join daily_current c on c.var = e.var and c.loc_id = e.loc_id
          group by e.var, e.loc_id""")
def coverage(spark, sf):
    catalogue = view(spark, sf, "grid").withColumn("source", F.lit("era5"))
    return quality.coverage(view(spark, sf, "daily_current"), catalogue,
                            ["runoff", "snowfall", "soil_type"]).select("var", "loc_id", "n")


# ---- tiers -----------------------------------------------------------------------------

@check("""select source, tier, min(time) as min_time, max(time) as max_time, count(*) as n
          from series group by source, tier""")
def tier_bounds(spark, sf):
    return series.tier_bounds(view(spark, sf, "series"))


@check("""with b as (select max(case when tier = 'historic' then time end) as hist_max,
                            min(case when tier = 'current' then time end) as cur_min from series)
          select req_id, start_time <= hist_max as read_historic,
                 case when start_time <= hist_max then end_time >= cur_min else start_time >= cur_min end as read_current
          from requests, b""")
def route_tiers(spark, sf):
    bounds = series.tier_bounds(view(spark, sf, "series"))
    return series.route_tiers(requests(spark, sf), bounds).select("req_id", "read_historic", "read_current")


@check("""with ranked as (select *, row_number() over (partition by source, var, loc_id, time
                                                       order by case tier when 'historic' then 0 else 1 end) as rn
                          from series)
          select var, loc_id, time, tier, value from ranked where rn = 1""")
def union_keep_first(spark, sf):
    return series.serve_tiers(view(spark, sf, "series")).select("var", "loc_id", "time", "tier", "value")


# ---- space -----------------------------------------------------------------------------

NEAR = """with pairs as (
            select r.req_id, r.mode, g.loc_id,
                   sqrt((r.lat - g.latitude) * (r.lat - g.latitude)
                      + (r.lon - g.longitude) * (r.lon - g.longitude)) as d
            from requests r join grid g on true),
          near as (
            select *, row_number() over (partition by req_id order by d, loc_id) as rk from pairs where d < 1)"""


@check(NEAR + " select req_id, loc_id, round(d, 6) as d, rk as rank from near where rk <= 4")
def knn_idw(spark, sf):
    found = space.knn(requests(spark, sf), view(spark, sf, "grid"))
    return found.select("req_id", "loc_id", F.round("d", 6).alias("d"), "rank")


@check(NEAR + " select req_id, loc_id, round(d, 6) as d, rk as rank from near where rk <= 4")
def knn_by_descent(spark, sf):
    """Cells of at most four locations, so nearly all are split, some of them often."""
    found = space.knn(requests(spark, sf), view(spark, sf, "grid"), target=4)
    return found.select("req_id", "loc_id", F.round("d", 6).alias("d"), "rank")


@check(NEAR + " select req_id, loc_id, round(d, 6) as d from near where rk = 1")
def knn_snap(spark, sf):
    found = space.knn(requests(spark, sf), view(spark, sf, "grid"), k=1)
    return found.select("req_id", "loc_id", F.round("d", 6).alias("d"))


@check(NEAR + """, four as (select * from near where rk <= 4)
          select req_id, loc_id, round((1 / d) / sum(1 / d) over (partition by req_id), 6) as weight from four""")
def idw_weights(spark, sf):
    found = space.idw_weights(space.knn(requests(spark, sf), view(spark, sf, "grid")))
    return found.select("req_id", "loc_id", F.round("weight", 6).alias("weight"))


@check("""select g.loc_id, r.valid_time, r.t2m
          from grid_raw r join grid g
            on cast(round(cast(r.longitude as double) * 1000) as bigint) = cast(round(g.longitude * 1000) as bigint)
           and cast(round(cast(r.latitude as double) * 1000) as bigint) = cast(round(g.latitude * 1000) as bigint)""")
def locate_cells(spark, sf):
    grid_rows = view(spark, sf, "grid_raw").withColumn("source", F.lit("nasapower"))
    return space.locate_cells(grid_rows, view(spark, sf, "grid")).select("loc_id", "valid_time", "t2m")


@check("""select o.loc_id, s.var, s.ref, s.time, s.value from station_rows s join stations_old o
            on s.latitude = o.latitude and s.longitude = o.longitude""")
def locate_stations(spark, sf):
    return space.locate_stations(view(spark, sf, "station_rows"), view(spark, sf, "stations_old")).select(
        "loc_id", "var", "ref", "time", "value")


@check("""select distinct latitude, longitude from (
            select latitude, longitude from stations_old union all select latitude, longitude from stations_seen)""")
def distinct_coordinates(spark, sf):
    return space.distinct_coordinates(view(spark, sf, "stations_old"), view(spark, sf, "stations_seen"))


@check("""with added as (select s.latitude, s.longitude from stations_seen s left join stations_old o
                           on s.latitude = o.latitude and s.longitude = o.longitude where o.loc_id is null)
          select loc_id, latitude, longitude from stations_old
          union all
          select cast((select count(*) from stations_old) + row_number() over (order by latitude, longitude) - 1
                      as int), latitude, longitude from added""")
def extend_catalogue(spark, sf):
    return space.extend_catalogue(view(spark, sf, "stations_old"), view(spark, sf, "stations_seen"))


@check("""with spaced as (select cast(s_suppkey + case when s_acctbal < 0 then 3 else 0 end as int) as loc_id
                          from supplier),
          placed as (select loc_id, row_number() over (order by loc_id) - 1 as position from spaced)
          select * from placed where loc_id <> position""")
def check_dense_ids(spark, sf):
    shifted = spark.read.parquet(f"{sf}/supplier.parquet").selectExpr(
        "cast(s_suppkey + case when s_acctbal < 0 then 3 else 0 end as int) as loc_id")
    return space.check_dense_ids(shifted)


# ---- series at points ------------------------------------------------------------------

def at_point(k: int, wanted: list[str]) -> str:
    picks = ", ".join(f"max(case when var = '{v}' then value end) as {v}" for v in wanted)
    listed = ", ".join(f"'{v}'" for v in wanted)
    return f"""with near as (
            select loc_id, sqrt(({LAT} - latitude) * ({LAT} - latitude)
                              + ({LON} - longitude) * ({LON} - longitude)) as d from grid),
          kept as (select * from near where d < 1 order by d, loc_id limit {k}),
          weighted as (select loc_id, (1 / d) / sum(1 / d) over () as w from kept),
          summed as (
            select tier, var, time, case when count(value) = count(*) then sum(value * w) end as value
            from series join weighted using (loc_id)
            where value is distinct from -999 and var in ({listed})
              and time between timestamp '2024-01-01 06:00:00' and timestamp '2024-01-04 23:00:00'
            group by tier, var, time having count(*) = (select count(*) from kept)),
          served as (select *, row_number() over (partition by var, time
                                 order by case tier when 'historic' then 0 else 1 end) as rn from summed)
          select time, {picks} from (select time, var, round(value, 4) as value from served where rn = 1)
          group by time having count(*) = {len(wanted)}"""


def ask_point(spark, sf, wanted, mode):
    out = point.point_series(view(spark, sf, "series"), view(spark, sf, "grid"), "nasapower", LAT, LON, wanted,
                             "2024-01-01 06:00:00", "2024-01-04 23:00:00", mode)
    return rounded(out, *wanted)


@check(at_point(4, POINT_VARS[:1]))
def point_idw(spark, sf):
    return ask_point(spark, sf, POINT_VARS[:1], "IDW")


@check(at_point(1, POINT_VARS[:1]))
def point_snap(spark, sf):
    return ask_point(spark, sf, POINT_VARS[:1], "snap")


@check(at_point(4, POINT_VARS))
def multi_var(spark, sf):
    return ask_point(spark, sf, POINT_VARS, "idw")


# an answer per request: neighbours, per-tier sums, history first, all asked variables present
ANSWERS = """four as (select req_id, loc_id, d, count(*) over (partition by req_id) as k,
                             (1 / d) / sum(1 / d) over (partition by req_id) as w
                      from near where rk <= case mode when 'snap' then 1 else 4 end),
          asked as (select req_id, start_time, end_time, unnest(string_split(var_name, ',')) as var,
                           len(string_split(var_name, ',')) as n_vars from {requests}),
          summed as (
            select a.req_id, o.tier, o.var, o.time, any_value(a.n_vars) as n_vars,
                   case when count(o.value) = count(*) then sum(o.value * f.w) end as value
            from asked a join four f on a.req_id = f.req_id
              join series o on o.loc_id = f.loc_id and o.var = a.var
            where o.value is distinct from -999 and o.time between a.start_time and a.end_time
            group by a.req_id, o.tier, o.var, o.time having count(*) = any_value(f.k)),
          served as (select *, row_number() over (partition by req_id, var, time
                                 order by case tier when 'historic' then 0 else 1 end) as rn from summed),
          whole as (select req_id, time, var, value, n_vars, count(*) over (partition by req_id, time) as n
                    from served where rn = 1)"""
WIDE_ANSWERS = """select req_id, time, max(case when var = 'temperature_2m' then round(value, 4) end) as temperature_2m,
                 max(case when var = 'relative_humidity_2m' then round(value, 4) end) as relative_humidity_2m
          from whole where n = n_vars group by req_id, time"""


@check(f"{NEAR}, {ANSWERS.format(requests='requests')} {WIDE_ANSWERS}")
def extract_points(spark, sf):
    out = batch.extract_points(requests(spark, sf), view(spark, sf, "series"), view(spark, sf, "grid"), POINT_VARS)
    return rounded(out, *POINT_VARS)


@check(f"{NEAR}, {ANSWERS.format(requests='requests')} "
       "select req_id, time, var, round(value, 4) as value from whole where n = n_vars")
def extract_series(spark, sf):
    out = batch.extract_series(requests(spark, sf), view(spark, sf, "series"), view(spark, sf, "grid"))
    return rounded(out, "value").select("req_id", "time", "var", "value")


@check(NEAR + """, four as (select req_id, loc_id, count(*) over (partition by req_id) as k,
                             (1 / d) / sum(1 / d) over (partition by req_id) as w from near where rk <= 4)
          select f.req_id, o.tier, o.var, o.time,
                 round(case when count(o.value) = count(*) then sum(o.value * f.w) end, 4) as value
          from series o join four f on o.loc_id = f.loc_id
          where o.value is distinct from -999
          group by f.req_id, o.tier, o.var, o.time having count(*) = any_value(f.k)""")
def interpolate_snapshot(spark, sf):
    near = space.idw_weights(space.knn(requests(spark, sf), view(spark, sf, "grid")))
    return rounded(series.interpolate(quality.drop_sentinel(view(spark, sf, "series")), near), "value")


# ---- requests --------------------------------------------------------------------------

def known(source: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in served_variables(source)) + "]"


CHECKED = f"""with parsed as (
            select req_id, lower(data_source) as source, lat as lat_text, lon as lon_text,
                   try_cast(lat as double) as lat, try_cast(lon as double) as lon,
                   var_name, string_split(var_name, ',') as asked,
                   try_strptime(start_date, '%Y-%m-%d') as start_time,
                   try_strptime(end_date, '%Y-%m-%d') + interval 23 hour as end_time,
                   case when lower(interp_mode) = 'snap' then 'snap' else 'idw' end as mode,
                   case lower(data_source) {" ".join(f"when '{s}' then {known(s)}" for s in SERVED_SOURCES)} end as allowed
            from requests_raw),
          tested as (
            select *, list_filter(asked, lambda v: not list_contains(allowed, v)) as unknown from parsed),
          checked as (
            select *, case when source is null then 'data_source is missing'
              when source not in ('nasapower', 'era5', 'era5_land') then 'data_source is unknown'
              when lat_text is null or lon_text is null then 'lat or lon is missing'
              when lat is null or lon is null or not isfinite(lat) or not isfinite(lon)
                then 'lat and lon must be finite numbers'
              when var_name is null then 'var_name is missing'
              when len(unknown) > 0 then 'unknown var_name: ' || array_to_string(unknown, ', ')
              when start_time is null or end_time is null then 'dates must exist and be written YYYY-MM-DD'
              end as error from tested)"""


@check(CHECKED + """ select req_id, error, case when error is null then source end as source,
                 case when error is null then start_time end as start_time,
                 case when error is null then end_time end as end_time, mode from checked""")
def validate_requests(spark, sf):
    done = validate.checked_requests(view(spark, sf, "requests_raw"))
    good = F.col("error").isNull()
    return done.select("req_id", "error", *[F.when(good, F.col(c)).alias(c)
                                            for c in ("source", "start_time", "end_time")], "mode")


RAW_NEAR = NEAR[5:].replace("from requests r join grid g on true", "from accepted r join grid g on true")
RAW_RUN = f"""{CHECKED}, accepted as (select * from checked where error is null),
          {RAW_NEAR}, {ANSWERS.format(requests='accepted')}"""


@check(f"{RAW_RUN} {WIDE_ANSWERS}")
def run_requests(spark, sf):
    results, _ = batch.run_requests(view(spark, sf, "requests_raw"), view(spark, sf, "series"), view(spark, sf, "grid"),
                                    scratch(spark, "results"))
    return rounded(results, *POINT_VARS).select("req_id", "time", *POINT_VARS)


@check(f"""{RAW_RUN}, answered as (select distinct req_id from whole where n = n_vars)
          select req_id, error from checked where error is not null
          union all
          select req_id, 'no values near the point in the date range' from accepted
          where req_id not in (select req_id from answered)""")
def rejected_requests(spark, sf):
    _, rejected = batch.run_requests(view(spark, sf, "requests_raw"), view(spark, sf, "series"), view(spark, sf, "grid"),
                                     scratch(spark, "results"))
    return rejected


@check("""with wide as (select tier, loc_id, time, max(case when var = 'temperature_2m' then value end) as temperature_2m,
                        max(case when var = 'relative_humidity_2m' then value end) as relative_humidity_2m
                      from series group by tier, loc_id, time having count(distinct var) = 2)
          select tier, loc_id, cast(json_object('time', strftime(time, '%Y-%m-%d %H:%M:%S'), 'temperature_2m', temperature_2m,
                                          'relative_humidity_2m', relative_humidity_2m) as varchar) as record
          from wide""")
def records_json(spark, sf):
    wide = shape.series_to_wide(view(spark, sf, "series"), ["tier", "loc_id", "time"], POINT_VARS)
    return writers.to_records(wide, "tier", "loc_id")


@check("""select req_id, format('{} series at {},{} for {} from {} to {}, mode {}', source,
                 cast(round(lat * 256) / 256 as varchar), cast(round(lon * 256) / 256 as varchar),
                 array_to_string(string_split(var_name, ','), ', '),
                 strftime(start_time, '%Y-%m-%d %H:%M:%S'), strftime(end_time, '%Y-%m-%d %H:%M:%S'), mode) as message
          from requests""")
def response_messages(spark, sf):
    lat, lon = (F.round(F.col(c) * 256) / 256 for c in ("lat", "lon"))
    text = writers.response_message(F.col("source"), lat, lon, F.col("vars"),
                                    F.col("start_time"), F.col("end_time"), F.col("mode"))
    return requests(spark, sf).select("req_id", text.alias("message"))


# ---- lifecycle -------------------------------------------------------------------------

SETTLED = f"""with latest as (select source, var, loc_id, max(time) as t from daily_current group by all),
          marked as (select c.*, c.time < cast(date_trunc('month', l.t - interval {KEEP_MONTHS['era5']} month)
                                               as timestamp) as settled
                     from daily_current c join latest l using (source, var, loc_id))"""


@check(SETTLED + """, merged as (
            select source, var, loc_id, time, value, 0 as prio from marked where settled
            union all select source, var, loc_id, time, value, 1 from daily_historic),
          ranked as (select *, row_number() over (partition by source, var, loc_id, time order by prio) as rn from merged)
          select var, loc_id, time, value from ranked where rn = 1""")
def promote_hist(spark, sf):
    new_history, _ = promote.promoted(view(spark, sf, "daily_current"), view(spark, sf, "daily_historic"))
    return new_history.select("var", "loc_id", "time", "value")


@check(SETTLED + " select var, loc_id, time, value from marked where not settled")
def promote_cur(spark, sf):
    _, left = promote.promoted(view(spark, sf, "daily_current"), view(spark, sf, "daily_historic"))
    return left.select("var", "loc_id", "time", "value")


@check("""(select distinct var, loc_id, 'current' as only_in from daily_current
           except select distinct var, loc_id, 'current' from daily_historic)
          union all
          (select distinct var, loc_id, 'historic' from daily_historic
           except select distinct var, loc_id, 'historic' from daily_current)""")
def series_mismatch(spark, sf):
    found = quality.series_mismatch(view(spark, sf, "daily_current"), view(spark, sf, "daily_historic"))
    return found.select("var", "loc_id", "only_in")


RESUME = """latest as (select source, var, loc_id, max(time) as t from {table} group by all),
          resumed as (select source, {key}, least(min(t), timestamp '{now}') as time from latest group by all)"""


@check("with " + RESUME.format(table="daily_historic", key="var", now="2000-12-31 00:00:00") +
       " select source, var, time from resumed")
def resume_times(spark, sf):
    return lifecycle.resume_times(view(spark, sf, "daily_historic"), "var", "2000-12-31 00:00:00")


@check("with " + RESUME.format(table="daily_historic", key="var", now=NOW) + f""",
          keys as (select unnest(['runoff', 'snowfall', 'temperature_2m']) as var),
          started as (select k.var, cast(date_trunc('month', coalesce(r.time, timestamp '2001-01-01 00:00:00')
                                         - interval {KEEP_MONTHS['era5']} month) as date) as first
                      from keys k left join resumed r on r.var = k.var),
          months as (select var, unnest(generate_series(first, cast('{NOW}' as date), interval 1 month)) as m from started)
          select var, cast(year(m) as int) as year, cast(month(m) as int) as month,
                 case var when 'temperature_2m' then '2m_temperature' else var end || '_' || year(m) || '_' || month(m)
                   || '.nc' as file_name,
                 cast(day(last_day(m)) as int) as n_days
          from months""")
def backfill_months(spark, sf):
    keys = spark.createDataFrame([("era5", v) for v in ("runoff", "snowfall", "temperature_2m")],
                                 "source string, var string")
    planned = backfill.plan_grid(view(spark, sf, "daily_historic"), keys, NOW)
    return planned.select("var", "year", "month", "file_name", F.size("days").alias("n_days"))


@check("with " + RESUME.format(table="series", key="loc_id", now=NOW) + f""",
          started as (select g.loc_id, cast(date_trunc('month', coalesce(r.time, timestamp '2001-01-01 00:00:00')
                                            - interval {KEEP_MONTHS['nasapower']} month) as date) as first
                      from grid g left join resumed r on r.loc_id = g.loc_id),
          years as (select loc_id, first, unnest(range(year(first), year(cast('{NOW}' as date)) + 1)) as y from started)
          select loc_id, cast(y as int) as year,
                 cast(strftime(greatest(first, make_date(y, 1, 1)), '%Y%m%d') as int) as start_date,
                 cast(strftime(least(cast('{NOW}' as date), make_date(y, 12, 31)), '%Y%m%d') as int) as end_date
          from years""")
def backfill_years(spark, sf):
    planned = backfill.plan_point(view(spark, sf, "series"), view(spark, sf, "grid"), NOW)
    return planned.select("loc_id", "year", "start_date", "end_date")


@check("select distinct cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month from orders")
def distinct_months(spark, sf):
    return lifecycle.distinct_months(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderdate")


# ---- stations --------------------------------------------------------------------------

@check("""select station_id from station_meta where owner = 'OWNER_A'
            and strptime(to_date, '%Y-%m-%dT%H:%M:%S') >= timestamp '2024-06-01 00:00:00'""")
def active_stations(spark, sf):
    return lifecycle.active_stations(view(spark, sf, "station_meta"), "OWNER_A", "2024-06-01").select("station_id")


NAMED = "case concat(feature, '_', parameter) " + " ".join(
    f"when '{raw_name}' then '{var}'" for raw_name, var in VARIABLES["stations"].items()) + " end"


@check(f"""with named as (select station_id, ref, {NAMED} as var from station_meta where owner = 'OWNER_A'
                            and strptime(to_date, '%Y-%m-%dT%H:%M:%S') >= timestamp '2024-06-01 00:00:00')
          select station_id, var, concat(var, '_!_', ref, '.h5') as file_name from named
          where var is not null and not exists (
            select 1 from manifest m where m.file_name = concat(var, '_!_', ref, '.h5'))""")
def not_landed(spark, sf):
    wanted, _ = backfill.select_stations(view(spark, sf, "station_meta"), view(spark, sf, "manifest"),
                                         "OWNER_A", "2024-06-01")
    return wanted.select("station_id", "var", "file_name")


@check("""select station_id, file_name from (
            select station_id, concat('temperature_2m_!_', ref, '.h5') as file_name from station_meta) s
          where exists (select 1 from manifest m where m.file_name = s.file_name)""")
def has_raw(spark, sf):
    meta = view(spark, sf, "station_meta")
    files = meta.select("station_id", names.station_file(F.lit("temperature_2m"), F.col("ref")).alias("file_name"))
    return lifecycle.has_raw(files, view(spark, sf, "manifest"), "file_name")


STATION_RUN = """with fixed as (
            select var, time, value,
                   case when ref = 'timaru_coastal_hv' and var = 'relative_humidity_2m' then -44.30493 else latitude end as latitude,
                   case when ref = 'timaru_coastal_hv' and var = 'relative_humidity_2m' then 171.22158 else longitude end as longitude
            from station_rows),
          added as (select distinct f.latitude, f.longitude from fixed f left join stations_old o
                      on f.latitude = o.latitude and f.longitude = o.longitude where o.loc_id is null),
          catalogue as (
            select loc_id, latitude, longitude from stations_old
            union all
            select cast((select count(*) from stations_old) + row_number() over (order by latitude, longitude) - 1
                        as int), latitude, longitude from added)"""


@check(STATION_RUN + """ select c.loc_id, f.var, f.time, f.value
          from fixed f join catalogue c on c.latitude = f.latitude and c.longitude = f.longitude""")
def ingest_stations(spark, sf):
    obs, _, _ = ingest.ingest_stations(view(spark, sf, "station_rows"), view(spark, sf, "stations_old"))
    return obs.select("loc_id", "var", "time", "value")


# ---- scalar functions ------------------------------------------------------------------

@check("""select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as int) as day_key,
                 cast(date_trunc('month', o_orderdate - interval 5 month) as timestamp) as five_back,
                 lpad(cast(o_orderkey % 24 as varchar), 2, '0') || ':00' as label,
                 cast(day(last_day(o_orderdate)) as int) as n_days,
                 cast(o_orderdate as timestamp) + interval 7 minute as recorded from orders""")
def calendar_functions(spark, sf):
    t = F.col("o_orderdate")
    text = F.concat(F.date_format(t, "yyyy-MM-dd"), F.lit(" 00:07:00"))
    return spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey", times.date_key(t).alias("day_key"), times.month_floor(t, 5).alias("five_back"),
        times.hour_label(F.col("o_orderkey") % 24).alias("label"), F.size(times.month_days(F.year(t), F.month(t))).alias("n_days"),
        times.parse_record_time(text).alias("recorded"))


@check("""select loc_id, latitude between -47.24 and -33.3 and longitude between 164.64 and 179.53 as inside,
                 cast(round(latitude * 1000) as bigint) as lat_k, cast(round(longitude * 1000) as bigint) as lon_k
          from grid""")
def coordinate_functions(spark, sf):
    lat, lon = F.col("latitude"), F.col("longitude")
    return view(spark, sf, "grid").select(
        "loc_id", values.in_area(lat, lon).alias("inside"), values.milli_degrees(lat).alias("lat_k"),
        values.milli_degrees(lon).alias("lon_k"))


# the queries that write and read back register themselves here
from workload import stored  # noqa: E402, F401
