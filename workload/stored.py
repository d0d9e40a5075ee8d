"""Check queries of everything that is written and read back; each writes below the checkpoint folder."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.functions import times
from gridseries.operators import lifecycle, quality, shape, space
from gridseries.operators.numbering import in_order, with_position
from gridseries.plans import answers, backfill, batch, ingest, point, promote, stations, update
from gridseries.schema import CURRENT, HISTORIC, OBS_SCHEMA
from gridseries.sinks import files, writers
from gridseries.sources import raw, tables
from gridseries.streaming.upsert import stream_ingest
from workload.queries import (
    ANSWERS, FILL, LAT, LON, NEAR, NOW, POINT_VARS, RAW_RUN, RESUME, WIDE_ANSWERS, at_point, check, requests, rounded, scratch)
from workload.views import view


def stored(spark: SparkSession, obs: DataFrame) -> str:
    path = scratch(spark, "obs")
    writers.write_obs(obs, path)
    return path


def placed(df: DataFrame) -> DataFrame:
    """Rows with their place, from 1, in the order they come in."""
    return in_order(df).withColumn("place", (F.col("position") + 1).cast("int")).drop("position")


# ---- catalogues and tables -------------------------------------------------------------

@check("select loc_id, latitude, longitude from grid")
def catalogue_file(spark, sf):
    path = scratch(spark, "catalogue")
    writers.write_catalogue(view(spark, sf, "grid"), path)
    return tables.read_catalogue(spark, path, "nasapower").select("loc_id", "latitude", "longitude")


@check("""select tier, var, loc_id, time, value from series
          where tier = 'historic' and var = 'relative_humidity_2m' and loc_id in (select loc_id from grid where latitude > -45)
            and time between timestamp '2024-01-02 00:00:00' and timestamp '2024-01-03 12:00:00'""")
def scan_stored(spark, sf):
    path = stored(spark, view(spark, sf, "series"))
    found = tables.scan_obs(spark, path, "nasapower", [HISTORIC], ["relative_humidity_2m"], None, "2024-01-02", "2024-01-03 12:00:00")
    north = view(spark, sf, "grid").filter("latitude > -45").select("loc_id")
    return found.join(north, "loc_id", "left_semi").select("tier", "var", "loc_id", "time", "value")


@check("""select tier, var, cast(year(time) as int) as year, count(*) as n, count(distinct loc_id) as n_locations
          from (select * from daily_historic union all select * from daily_current) group by all""")
def stored_partitions(spark, sf):
    path = stored(spark, view(spark, sf, "daily_historic").unionByName(view(spark, sf, "daily_current")))
    return spark.read.parquet(path).groupBy("tier", "var", "year").agg(
        F.count("*").alias("n"), F.count_distinct("loc_id").alias("n_locations"))


@check("select event_id, event_type, value from events")
def raw_landing(spark, sf):
    path = scratch(spark, "raw")
    writers.write_raw(spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type", "value"), path)
    return spark.read.parquet(path)


@check("select tier, loc_id, time, value from series where var = 'temperature_2m'")
def records_file(spark, sf):
    path, rows = scratch(spark, "records"), view(spark, sf, "series").filter("var = 'temperature_2m'").select("tier", "loc_id", "time", "value")
    writers.write_records(rows, path)
    return spark.read.schema(rows.schema).options(**writers.RECORD_OPTIONS).json(path)


@check("""select loc_id, time, var, tier, value from series where var = 'temperature_2m' and loc_id = 3""")
def preview_series(spark, sf):
    path = stored(spark, view(spark, sf, "series"))
    return point.preview(tables.scan_obs(spark, path), "nasapower", "temperature_2m", 3).select("loc_id", "time", "var", "tier", "value")


@check(at_point(4, POINT_VARS))
def point_from_table(spark, sf):
    path = stored(spark, view(spark, sf, "series"))
    found = point.point_stored(spark, path, view(spark, sf, "grid"), "nasapower", LAT, LON, POINT_VARS, "2024-01-01 06:00:00",
                               "2024-01-04 23:00:00")
    return rounded(found, *POINT_VARS).select("time", *POINT_VARS)


@check(f"with answer as ({at_point(4, POINT_VARS)}) select *, cast(row_number() over (order by time) as int) as place from answer")
def point_in_order(spark, sf):
    found = point.point_series(view(spark, sf, "series"), view(spark, sf, "grid"), "nasapower", LAT, LON, POINT_VARS, "2024-01-01 06:00:00",
                               "2024-01-04 23:00:00")
    return placed(rounded(found, *POINT_VARS))


@check(at_point(4, POINT_VARS))
def answer_or_empty(spark, sf):
    found = point.point_series(view(spark, sf, "series"), view(spark, sf, "grid"), "nasapower", LAT, LON, POINT_VARS, "2024-01-01 06:00:00",
                               "2024-01-04 23:00:00")
    nowhere = point.point_series(view(spark, sf, "series"), view(spark, sf, "grid"), "nasapower", 10.0, 10.0, POINT_VARS, "2024-01-01",
                                 "2024-01-04 23:00:00")
    return rounded(tables.empty_result(spark, POINT_VARS).unionByName(found).unionByName(nowhere), *POINT_VARS)


@check("""select loc_id, latitude, cast(row_number() over (order by loc_id nulls last) as int) as place
          from (select case when loc_id <> 4 then loc_id end as loc_id, latitude from grid)""")
def locations_by_id(spark, sf):
    catalogue = view(spark, sf, "grid").withColumn("loc_id", F.when(F.col("loc_id") != 4, F.col("loc_id")))
    return placed(space.by_id(catalogue.select("loc_id", "latitude")))


@check(f"{NEAR}, {ANSWERS.format(requests='requests')} {WIDE_ANSWERS}")
def extract_points_split(spark, sf):
    """Stencils of more than two requests are split into groups; the answers are the same."""
    out = batch.extract_points(requests(spark, sf), view(spark, sf, "series"), view(spark, sf, "grid"), POINT_VARS, group_limit=2)
    return rounded(out, *POINT_VARS)


@check(f"{NEAR}, {ANSWERS.format(requests='requests')} {WIDE_ANSWERS}")
def extract_from_table(spark, sf):
    path = stored(spark, view(spark, sf, "series"))
    return rounded(batch.extract_stored(spark, path, requests(spark, sf), view(spark, sf, "grid")), *POINT_VARS).select(
        "req_id", "time", *POINT_VARS)


def envelope_sql(requests: str) -> str:
    """The answers of a table of requests: `sent`, after `whole`."""
    stamps = "strftime(start_time, '%Y-%m-%d %H:%M:%S'), strftime(end_time, '%Y-%m-%d %H:%M:%S')"
    return f"""wide as ({WIDE_ANSWERS}),
          records as (
            select w.req_id, time, strftime(time, '%Y-%m-%d %H:%M:%S') as t, r.var_name, temperature_2m, relative_humidity_2m
            from wide w join {requests} r on w.req_id = r.req_id),
          texts as (
            select req_id, time, cast(case var_name when 'temperature_2m' then json_object('time', t, 'temperature_2m', temperature_2m)
                                                    when 'relative_humidity_2m' then json_object('time', t, 'relative_humidity_2m', relative_humidity_2m)
                                                    else json_object('time', t, 'temperature_2m', temperature_2m, 'relative_humidity_2m', relative_humidity_2m) end as varchar) as record
            from records),
          arrays as (select req_id, count(*) as n, '[' || string_agg(record, ',' order by time) || ']' as data from texts group by req_id),
          sent as (
            select a.req_id, a.n, cast(json_object('message', format('{{}} series at {{}},{{}} for {{}} from {{}} to {{}}, mode {{}}', source,
                     cast(round(lat * 256) / 256 as varchar), cast(round(lon * 256) / 256 as varchar), array_to_string(string_split(var_name, ','), ', '),
                     {stamps}, mode), 'Data', data) as varchar) as answer
            from arrays a join {requests} r on a.req_id = r.req_id)"""


@check(f"{NEAR}, {ANSWERS.format(requests='requests')}, {envelope_sql('requests')} select * from sent")
def answer_envelopes(spark, sf):
    """Every request's answer as it is sent, put together from chunks of ten hours."""
    asked = requests(spark, sf)
    found = batch.extract_answers(asked, view(spark, sf, "series"), view(spark, sf, "grid"))
    shown = asked.withColumns({c: F.round(F.col(c) * 256) / 256 for c in ("lat", "lon")})
    return answers.envelopes(shown, answers.answer_chunks(answers.with_records(found, 4), 10))


@check(f"""{RAW_RUN}, {envelope_sql('accepted')}
          select req_id, 200 as status, answer from sent
          union all select req_id, 400, cast(json_object('error', error) as varchar) from checked where error is not null
          union all select req_id, 400, cast(json_object('error', 'no values near the point in the date range') as varchar) from accepted
            where req_id not in (select req_id from sent)""")
def responses(spark, sf):
    """What the service would send for every text request: its answer, or what is wrong with it."""
    return answers.respond(view(spark, sf, "requests_raw"), view(spark, sf, "series"), view(spark, sf, "grid"), scratch(spark, "answers"), 4)


@check("""with doubled as (select req_id, count(*) as n from (
            select req_id from requests_raw union all select req_id from requests_raw where req_id % 7 = 0) group by req_id)
          select req_id, 'req_id is not unique' as error, n from doubled where n > 1""")
def repeated_request_ids(spark, sf):
    asked = view(spark, sf, "requests_raw")
    _, rejected = batch.validate_requests(asked.unionByName(asked.filter("req_id % 7 = 0")))
    return rejected.filter("error = 'req_id is not unique'").groupBy("req_id", "error").agg(F.count("*").alias("n"))


# ---- raw landings ----------------------------------------------------------------------

def file_rows(obs: str) -> str:
    return f"""select o.loc_id, o.time, o.k, o.value + 273.15 as t2m, g.longitude, g.latitude, o.loc_id % 4 as part
               from {obs} o join grid g on o.loc_id = g.loc_id"""


def land_grid_files(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Four extracts of a variable: both names of the time, nulls, and in two of them a column the others lack."""
    obs = view(spark, sf, "obs").join(view(spark, sf, "grid").select("loc_id", "longitude", "latitude"), "loc_id").select(
        F.col("longitude").cast("float"), F.col("latitude").cast("float"), "time", (F.col("value") + 273.15).alias("t2m"), "k", "loc_id")
    names = []
    for part in range(4):
        rows = obs.filter(F.col("loc_id") % 4 == part).drop("loc_id")
        rows = rows.withColumnRenamed("time", "valid_time") if part % 2 else rows
        rows = rows.withColumn("number", F.when(F.col("k") % 5 != 0, F.col("k"))) if part > 1 else rows
        names.append(f"2m_temperature_2024_{part + 1}.parquet")
        writers.write_raw(rows.drop("k"), f"{folder}/{names[-1]}")
    return spark.createDataFrame([(n,) for n in [*names, "2m_dewpoint_temperature_2024_1.parquet"]], "file_name string")


GRID_FILES = f"""select loc_id, 'temperature_2m' as var, time, round(t2m - 273.15, 4) as value from ({file_rows('obs')})
                 where t2m is not null and (part < 2 or k % 5 <> 0)"""


@check(GRID_FILES)
def ingest_grid_files(spark, sf):
    folder = scratch(spark, "grid-files")
    manifest = land_grid_files(spark, sf, folder)
    catalogue = view(spark, sf, "grid").withColumn("source", F.lit("era5"))
    rows = ingest.ingest_grid_files(spark, manifest, folder, "temperature_2m", catalogue, "era5", extensions=["parquet"])
    return rounded(rows.select("loc_id", "var", "time", "value"), "value")


def payloads(spark: SparkSession, sf: str) -> DataFrame:
    """One payload per location and month: temperatures with sentinels and nulls, humidities that lack hours."""
    obs = view(spark, sf, "obs").withColumn("hour_key", F.date_format("time", "yyyyMMddHH"))
    humid = F.when(F.col("k") >= 5, F.struct("hour_key", F.col("k").cast("double").alias("value")))
    packed = obs.groupBy("loc_id", F.date_format("time", "yyyyMM").alias("month")).agg(
        F.map_from_entries(F.collect_list(F.struct("hour_key", "value"))).alias("T2M"), F.map_from_entries(F.collect_list(humid)).alias("RH2M"))
    return packed.select("loc_id", F.to_json(F.struct(F.struct(F.struct("T2M", "RH2M").alias("parameter")).alias("properties"))).alias("payload"))


POINT_ROWS = """point_rows as (
            select 'nasapower' as source, 'temperature_2m' as var, loc_id, time, value from obs
            union all select 'nasapower', 'relative_humidity_2m', loc_id, time, case when k >= 5 then cast(k as double) end from obs)"""
POINT_FILL = f"with {POINT_ROWS}, {FILL.format(table='point_rows', trim='time <= last_seen')[5:]} where value is distinct from -999"


@check(POINT_FILL)
def ingest_point_payloads(spark, sf):
    return ingest.ingest_point(payloads(spark, sf)).select("var", "loc_id", "time", "value")


@check("""select loc_id, 'no readable parameters' as reason from grid where loc_id % 3 = 0
          union all select loc_id, 'bad hour key: 2024-01-01' from grid where loc_id % 3 = 1""")
def point_payload_rejects(spark, sf):
    good = '{"properties": {"parameter": {"T2M": {"2024010100": 1.0}}}}'
    text = F.when(F.col("loc_id") % 3 == 0, good[:40]).when(F.col("loc_id") % 3 == 1, good.replace("2024010100", "2024-01-01")).otherwise(good)
    return ingest.point_rejects(view(spark, sf, "grid").select("loc_id", text.alias("payload")))


@check("""select var, concat('n', ref) as ref, latitude, longitude, time, value from (
            select case when l_linenumber < 4 then 'relative_humidity_2m' else 'temperature_2m' end as var,
                   cast(s_nationkey as varchar) as ref, cast(s_suppkey as double) as latitude, cast(s_nationkey as double) as longitude,
                   l_shipdate as time, l_quantity as value
            from lineitem join supplier on l_suppkey = s_suppkey)""")
def station_files(spark, sf):
    """Files named after variable and station; the value is each file's own last column, whatever its name."""
    folder = scratch(spark, "station-files")
    land_station_files(spark, sf, folder)
    return raw.read_station_raw(spark, folder)


def land_station_files(spark: SparkSession, sf: str, folder: str) -> None:
    """Humidities and temperatures of each nation's suppliers; their files differ in columns, order and types."""
    item, supplier = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("lineitem", "supplier"))
    var = F.when(F.col("l_linenumber") < 4, "relative_humidity_2m").otherwise("temperature_2m")
    rows = item.join(supplier, item.l_suppkey == supplier.s_suppkey).select(
        F.concat(var, F.lit("_!_n"), F.col("s_nationkey").cast("string")).alias("file"), F.col("l_shipdate").alias("time"),
        F.col("s_suppkey").cast("double").alias("lat"), F.col("s_nationkey").cast("double").alias("lon"),
        F.lit("p").alias("geometry"), F.lit("i").alias("ref"), F.col("l_quantity").alias("humidity"))
    humid = F.col("file").startswith("relative")
    warm = rows.filter(~humid).select("file", "lon", "lat", "time", "ref", F.col("humidity").cast("float").alias("air_temperature"))
    for kind in (rows.filter(humid), warm):
        split = scratch(spark, "station-parts")
        kind.repartition("file").write.partitionBy("file").parquet(split)
        for part in files.folders(spark, split):
            files.move_files(spark, f"{split}/{part}", folder, part.removeprefix("file="), ".parquet")


STATION_FILES = """select case when l_linenumber < 4 then 'relative_humidity_2m' else 'temperature_2m' end as var,
                          cast(s_suppkey as double) as latitude, cast(s_nationkey as double) as longitude, l_shipdate, l_quantity
                   from lineitem join supplier on l_suppkey = s_suppkey"""


@check(f"""with rows_of as ({STATION_FILES}), merged as (
            select var, latitude, longitude, cast(l_shipdate as timestamp) as time, l_quantity as value, count(*) as n from rows_of group by all),
          places as (select distinct latitude, longitude from rows_of),
          old as (select cast(s_suppkey as int) as loc_id, cast(s_suppkey as double) as latitude, cast(s_nationkey as double) as longitude
                  from supplier where s_suppkey < (select count(*) from supplier) / 2),
          added as (select latitude, longitude, cast(row_number() over (order by latitude, longitude) - 1 + (select count(*) from old) as int) as loc_id
                    from places p where not exists (select 1 from old o where o.latitude = p.latitude and o.longitude = p.longitude)),
          ids as (select loc_id, latitude, longitude from old union all select loc_id, latitude, longitude from added)
          select var, loc_id, time, value, n from merged join ids using (latitude, longitude)""")
def land_stations(spark, sf):
    """Station files into the stored table, with the catalogue that is extended by their places."""
    folder, path = scratch(spark, "station-files"), scratch(spark, "obs")
    land_station_files(spark, sf, folder)
    supplier = spark.read.parquet(f"{sf}/supplier.parquet")
    old = supplier.filter(F.col("s_suppkey") < supplier.count() / 2).select(
        F.col("s_suppkey").cast("int").alias("loc_id"), F.col("s_suppkey").cast("double").alias("latitude"), F.col("s_nationkey").cast("double").alias("longitude"))
    stations.land_stations(spark, folder, old, path, scratch(spark, "catalogue"), scratch(spark, "rejects"))
    return tables.scan_obs(spark, path, "stations", [CURRENT]).groupBy("var", "loc_id", "time", "value").agg(F.count("*").alias("n"))


@check(f"{GRID_FILES.replace('select loc_id', 'select loc_id', 1)} union all select loc_id, var, time, round(value, 4) from ({POINT_FILL})")
def rebuild_from_raw(spark, sf):
    landing, path = scratch(spark, "landing"), scratch(spark, "obs")
    writers.write_raw(payloads(spark, sf), f"{landing}/nasapower")
    manifest = land_grid_files(spark, sf, f"{landing}/era5").withColumn("source", F.lit("era5"))
    grid = view(spark, sf, "grid")
    ingest.rebuild_from_raw(spark, landing, manifest, grid.unionByName(grid.withColumn("source", F.lit("era5"))), path,
                            extensions=["parquet"], variables={"era5": ["temperature_2m"]})
    return rounded(tables.scan_obs(spark, path, tiers=[HISTORIC]).select("loc_id", "var", "time", "value"), "value")


# ---- lifecycle -------------------------------------------------------------------------

@check("""with merged as (
            select source, var, loc_id, time, value, 0 as prio from daily_current
            union all select source, var, loc_id, time, value, 1 from daily_historic),
          ranked as (select *, row_number() over (partition by source, var, loc_id, time order by prio) as rn from merged)
          select var, loc_id, time, value from ranked where rn = 1""")
def promote_table(spark, sf):
    path = stored(spark, view(spark, sf, "daily_historic").unionByName(view(spark, sf, "daily_current")))
    promote.promote(spark, path, "era5", force=True)
    return tables.scan_obs(spark, path).filter(F.col("tier") == HISTORIC).select("var", "loc_id", "time", "value")


@check("""with shared as (select distinct var, loc_id from daily_current intersect select distinct var, loc_id from daily_historic),
          cur as (select c.* from daily_current c join shared using (var, loc_id)),
          latest as (select var, loc_id, max(time) as t from cur group by all),
          marked as (select c.*, c.time < cast(date_trunc('month', t - interval 5 month) as timestamp) as settled from cur c join latest using (var, loc_id)),
          merged as (select var, loc_id, time, value, 0 as prio from marked where settled
                     union all select h.var, h.loc_id, h.time, h.value, 1 from daily_historic h join shared using (var, loc_id)),
          ranked as (select *, row_number() over (partition by var, loc_id, time order by prio) as rn from merged)
          select 'historic' as kind, var, loc_id, time, value from ranked where rn = 1
          union all select 'current', var, loc_id, time, value from marked where not settled
          union all (select distinct 'only in current', var, loc_id, null::timestamp, null::double from daily_current anti join shared using (var, loc_id))
          union all (select distinct 'only in historic', var, loc_id, null::timestamp, null::double from daily_historic anti join shared using (var, loc_id))""")
def promote_stored(spark, sf):
    """Unforced: blocked by series in one tier, which are reported; then for the others, each up to its own cutoff."""
    current, historic = view(spark, sf, "daily_current"), view(spark, sf, "daily_historic")
    blocked, path = stored(spark, historic.unionByName(current)), scratch(spark, "obs")
    try:
        promote.promote(spark, blocked, "era5")
    except promote.SeriesMismatch as error:
        report = spark.read.parquet(error.report)
    kept = tables.scan_obs(spark, blocked).join(report.select("var", "loc_id"), ["var", "loc_id"], "left_anti")
    writers.write_obs(kept, path)
    promote.promote(spark, path, "era5")
    missing = report.select(F.concat(F.lit("only in "), "only_in").alias("kind"), "var", "loc_id", F.lit(None).cast("timestamp_ntz").alias("time"), F.lit(None).cast("double").alias("value"))
    return tables.scan_obs(spark, path).select(F.col("tier").alias("kind"), "var", "loc_id", "time", "value").unionByName(missing)


@check("with " + RESUME.format(table="daily_historic", key="var", now=NOW) + """,
          started as (select k.var, cast(date_trunc('month', coalesce(r.time, timestamp '2001-01-01 00:00:00') - interval 5 month) as date) as first
                      from (select unnest(['runoff', 'temperature_2m']) as var) k left join resumed r on r.var = k.var),
          months as (select var, unnest(generate_series(first, cast('2024-04-10' as date), interval 1 month)) as m from started)
          select var, cast(year(m) as int) as year, cast(month(m) as int) as month,
                 cast(row_number() over (order by year(m), month(m), var) as int) as place from months""")
def months_in_order(spark, sf):
    keys = spark.createDataFrame([("era5", "runoff"), ("era5", "temperature_2m")], "source string, var string")
    plan = lifecycle.by_month(backfill.plan_grid(view(spark, sf, "daily_historic"), keys, NOW))
    return placed(plan.select("var", "year", "month"))


@check("""select distinct cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
                 cast(lpad(cast(day(last_day(o_orderdate)) as varchar), 2, '0') as varchar) as last_day, '01' as first_day,
                 lpad(cast(month(o_orderdate) as varchar), 2, '0') || ':00' as label from orders""")
def month_parameters(spark, sf):
    months = lifecycle.distinct_months(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderdate")
    days = times.month_days(F.col("year"), F.col("month"))
    return months.select("year", "month", F.element_at(days, -1).alias("last_day"), F.element_at(days, 1).alias("first_day"),
                         times.hour_label(F.col("month")).alias("label"))


@check(f"""with {POINT_ROWS}, stored_rows as (
            select loc_id, var, time, value from series where tier = 'current' and source = 'nasapower'),
          filled as ({POINT_FILL.replace('with ' + POINT_ROWS + ', ', 'with ')})
          select loc_id, var, time, round(value, 4) as value from filled
          union all select loc_id, var, time, round(value, 4) from stored_rows s
            where not exists (select 1 from filled f where f.loc_id = s.loc_id and f.var = s.var and f.time = s.time)""")
def update_round(spark, sf):
    """Landed payloads replace stored current rows with the same keys; history stays."""
    path = stored(spark, view(spark, sf, "series"))
    update.update_all(spark, {"nasapower": payloads(spark, sf)}, view(spark, sf, "grid"), path)
    return rounded(tables.scan_obs(spark, path, tiers=[CURRENT]).select("loc_id", "var", "time", "value"), "value")


@check("with " + RESUME.format(table="series", key="loc_id", now=NOW) + """,
          started as (select g.loc_id, cast(date_trunc('month', coalesce(r.time, timestamp '2001-01-01 00:00:00') - interval 1 month) as date) as first
                      from grid g left join resumed r on r.loc_id = g.loc_id)
          select 'nasapower' as source, loc_id, cast(null as varchar) as var,
                 cast(unnest(range(year(first), 2025)) as int) as year, cast(null as int) as month from started
          union all
          select 'era5', null, v.var, cast(year(m) as int), cast(month(m) as int)
          from (select unnest(['temperature_2m', 'soil_temperature_level_1']) as var) v,
               (select unnest(generate_series(date '2000-08-01', date '2024-04-10', interval 1 month)) as m)""")
def update_plan(spark, sf):
    path = stored(spark, view(spark, sf, "series"))
    grid = view(spark, sf, "grid")
    return update.plan_update(spark, path, grid.unionByName(grid.withColumn("source", F.lit("era5"))), NOW).select(
        "source", "loc_id", "var", "year", "month")


@check("""with fresh as (select loc_id, time, value + 100 as value from obs where hr between 60 and 80 and value <> -999)
          select loc_id, time, value, false as late from fresh
          union all select loc_id, time, value, false from series s where var = 'temperature_2m' and tier = 'current'
            and not exists (select 1 from fresh f where f.loc_id = s.loc_id and f.time = s.time)
          union all select loc_id, time - interval 60 day, value + 7, true from obs where hr < 5 and value <> -999""")
def stream_upsert(spark, sf):
    """Arrivals in four batches: a revision, a newer one, one that is older but comes later, and late rows."""
    path = stored(spark, view(spark, sf, "series"))
    obs = view(spark, sf, "obs").filter("value <> -999")

    def arrivals(rows: DataFrame, value: str, time: str, arrival: str) -> DataFrame:
        return rows.selectExpr("'nasapower' source", "'temperature_2m' var", "loc_id", f"{time} time", f"{value} value",
                               f"timestamp_ntz'{arrival}' arrival")

    fresh = obs.filter("hr between 60 and 80")
    incoming, rejects = scratch(spark, "incoming"), scratch(spark, "rejects")
    for landed in (arrivals(fresh, "value + 50", "time", "2024-03-01 00:00:00"), arrivals(fresh, "value + 100", "time", "2024-03-02 00:00:00"),
                   arrivals(fresh, "value + 10", "time", "2024-02-01 00:00:00"),
                   arrivals(obs.filter("hr < 5"), "value + 7", "time - interval 60 days", "2024-03-01 00:00:00")):
        # one file is one batch; the rows are made in many tasks, and one writes them
        writers.write_raw(landed.repartition(1), incoming, mode="append")
    stream_ingest(spark, incoming, path, rejects, scratch(spark, "stream"), files_per_batch=1).awaitTermination()
    kept = tables.scan_obs(spark, path, tiers=[CURRENT], variables=["temperature_2m"]).withColumn("late", F.lit(False))
    late = spark.read.schema(OBS_SCHEMA).option("recursiveFileLookup", "true").parquet(rejects).withColumn("late", F.lit(True))
    return kept.unionByName(late).select("loc_id", "time", "value", "late")


@check("""with merged as (select var, loc_id, time, value, tier from series where var = 'temperature_2m')
          select loc_id, tier, count(*) as n, min(time) as first, max(time) as last from merged group by all""")
def wide_table_file(spark, sf):
    """A wide foreign file with raw names, conformed and taken apart."""
    path = scratch(spark, "wide")
    wide = view(spark, sf, "series").filter("var = 'temperature_2m'").select("loc_id", "tier", "time", F.col("value").alias("T2M"))
    writers.write_raw(wide, path)
    named = shape.conform_columns(spark.read.parquet(path), "nasapower")
    long = shape.wide_to_long(named, ["loc_id", "tier", "time"])
    return long.filter("var = 'temperature_2m'").groupBy("loc_id", "tier").agg(
        F.count("*").alias("n"), F.min("time").alias("first"), F.max("time").alias("last"))


@check("select cast(null as bigint) as loc_id, cast(null as bigint) as position from supplier where s_acctbal < 0")
def null_ids(spark, sf):
    """Locations without an id among others whose ids are dense: only they are reported."""
    supplier = spark.read.parquet(f"{sf}/supplier.parquet")
    dense = with_position(supplier.filter("s_acctbal >= 0").select("s_suppkey"), ["s_suppkey"]).select(F.col("position").cast("int").alias("loc_id"))
    nulls = supplier.filter("s_acctbal < 0").select(F.lit(None).cast("int").alias("loc_id"))
    return space.check_dense_ids(dense.unionByName(nulls)).select(F.col("loc_id").cast("bigint").alias("loc_id"), "position")


@check("select var, loc_id, time, value from daily_historic where value is distinct from -999")
def stored_without_sentinels(spark, sf):
    path = stored(spark, view(spark, sf, "daily_historic"))
    return quality.drop_sentinel(tables.scan_obs(spark, path)).select("var", "loc_id", "time", "value")
