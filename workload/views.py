"""Weather-shaped views over the generated tables, as SQL text for both engines.

Locations come from suppliers, hourly series from events, long daily series from line items
and requests from customers, so every view grows with the tables.
"""

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Dialect:
    """The few expressions in which the engines differ."""
    plus_hours: str
    props_k: str
    tables: str
    n_locations: str

    def table(self, name: str) -> str:
        return self.tables.format(name=name)


SPARK = Dialect("({t} + make_dt_interval(0, cast({h} as int)))", "cast(trim(both '{\"k: }' from props) as int)",
                "parquet.`{{folder}}/{name}.parquet`", "{n_locations}L")
DUCKDB = Dialect("({t} + to_hours(cast({h} as int)))", "cast(json_extract_string(props, '$.k') as int)", "{name}",
                 "(select count(*) from supplier)")


def ratio(a: str, b: int) -> str:
    return f"(cast({a} as double) / cast({b} as double))"


def view_texts(d: Dialect) -> dict[str, str]:
    t, n = d.table, d.n_locations

    def base_plus(hours: str) -> str:
        stamp = "timestamp_ntz'2024-01-01 00:00:00'" if d is SPARK else "timestamp '2024-01-01 00:00:00'"
        return d.plus_hours.format(t=stamp, h=hours)

    sentinel = "cast(-999.0 as double)"
    station_lat = f"cast(-47 as double) + {ratio('(s_suppkey * 37) % 1009', 256)}"
    station_lon = f"cast(168 as double) + {ratio('(s_suppkey * 53) % 1013', 200)}"
    return {
        # one location per supplier, scattered over about 4 x 5 degrees
        "grid": f"""
            select 'nasapower' as source, cast(s_suppkey as int) as loc_id,
                   {station_lat} as latitude, {station_lon} as longitude
            from {t('supplier')}""",
        # one observation per event: suppliers take turns, one round per hour
        "numbered": f"""
            select event_id, event_id % {n} as loc, floor(event_id / {n}) as hr,
                   {d.props_k} as k, value
            from {t('events')}""",
        "obs": f"""
            select cast(loc as int) as loc_id, cast(hr as int) as hr, {base_plus('hr')} as time, k,
                   case when k < 10 then {sentinel} when k = 96 then null else value end as value
            from numbered where k < 97""",
        # two variables in two overlapping tiers; current is a revision of history
        "series": f"""
            select 'nasapower' as source, 'historic' as tier, 'temperature_2m' as var, loc_id, time, value
            from obs where hr < 70
            union all
            select 'nasapower', 'current', 'temperature_2m', loc_id, time,
                   case when value = {sentinel} then value else value + cast(0.25 as double) end
            from obs where hr >= 55
            union all
            select 'nasapower', 'historic', 'relative_humidity_2m', loc_id, time, cast(k as double)
            from obs where k >= 5 and hr < 70
            union all
            select 'nasapower', 'current', 'relative_humidity_2m', loc_id, time, cast(k as double)
            from obs where k >= 5 and hr >= 55""",
        "requests": f"""
            select cast(c_custkey as int) as req_id, 'nasapower' as source,
                   cast(-46.9 as double) + {ratio('(c_custkey * 41) % 977', 260)} as lat,
                   cast(168.03 as double) + {ratio('(c_custkey * 59) % 983', 200)} as lon,
                   case c_custkey % 4 when 0 then 'relative_humidity_2m' when 1 then 'temperature_2m'
                        else 'temperature_2m,relative_humidity_2m' end as var_name,
                   {base_plus('(c_custkey % 80)')} as start_time,
                   {base_plus('(c_custkey % 80 + 35)')} as end_time,
                   case when c_custkey % 3 = 0 then 'snap' else 'idw' end as mode
            from {t('customer')}""",
        # text requests, one kind of mistake per residue
        "requests_raw": f"""
            select cast(c_custkey as int) as req_id,
                   case c_custkey % 12 when 1 then null when 2 then 'other' else 'NASAPOWER' end as data_source,
                   case c_custkey % 12 when 3 then null when 4 then 'abc' when 9 then 'nan'
                        else cast(-46 + (c_custkey % 3) as varchar(9)) || '.3125' end as lat,
                   cast(168 + (c_custkey % 5) as varchar(9)) || '.65625' as lon,
                   case c_custkey % 12 when 5 then null when 6 then 'temperature_2m,bogus,bogus'
                        else 'temperature_2m,relative_humidity_2m' end as var_name,
                   case c_custkey % 12 when 7 then '2024-02-31' when 8 then null else '2024-01-02' end as start_date,
                   '2024-01-03' as end_date,
                   case c_custkey % 5 when 0 then 'SNAP' when 1 then null else 'nearest' end as interp_mode
            from {t('customer')}""",
        # daily series of seven years, four variables; repeated keys are merged
        "daily_wide": f"""
            select cast(l_suppkey as int) as loc_id, {d.plus_hours.format(t='l_shipdate', h='l_linenumber')} as time,
                   max(case when l_tax = 0 then {sentinel} else l_quantity end) as runoff,
                   max(l_extendedprice) as surface_pressure, max(l_discount) as total_cloud_cover,
                   max(case when l_tax = 0 then null else l_tax end) as snowfall
            from {t('lineitem')}
            group by 1, 2""",
        "daily": """
            select 'era5' as source, 'runoff' as var, loc_id, time, runoff as value from daily_wide
            union all select 'era5', 'surface_pressure', loc_id, time, surface_pressure from daily_wide
            union all select 'era5', 'total_cloud_cover', loc_id, time, total_cloud_cover from daily_wide
            union all select 'era5', 'snowfall', loc_id, time, snowfall from daily_wide""",
        "daily_historic": """
            select source, 'historic' as tier, var, loc_id, time, value from daily
            where time < timestamp '2001-01-01 00:00:00' and not (var = 'snowfall' and loc_id % 7 = 3)""",
        "daily_current": """
            select source, 'current' as tier, var, loc_id, time, value + cast(1 as double) as value from daily
            where time >= timestamp '2000-09-01 00:00:00' and not (var = 'runoff' and loc_id % 5 = 2)""",
        # float32 coordinates, kelvin, masked cells, cells outside the catalogue
        "grid_raw": f"""
            select cast(longitude + case when o.loc_id % 9 = 5 then 30 else 0 end as float) as longitude,
                   cast(latitude as float) as latitude, time as valid_time,
                   case when k % 17 = 0 then null else value + cast(273.15 as double) end as t2m
            from obs o join grid g on o.loc_id = g.loc_id""",
        # half of the locations have ids 0..n-1 already, most of all locations are seen
        "stations_old": f"""
            select cast(s_suppkey as int) as loc_id, {station_lat} as latitude, {station_lon} as longitude
            from {t('supplier')} where s_suppkey < {n} / 2""",
        "stations_seen": f"""
            select distinct {station_lat} as latitude, {station_lon} as longitude
            from {t('lineitem')} join {t('supplier')} on l_suppkey = s_suppkey
            where s_acctbal > 1000""",
        "station_rows": f"""
            select case when l_linenumber < 4 then 'relative_humidity_2m' else 'temperature_2m' end as var,
                   case when s_nationkey < 5 then 'timaru_coastal_hv' else s_name end as ref,
                   {station_lat} as latitude, {station_lon} as longitude, l_shipdate as time, l_quantity as value
            from {t('lineitem')} join {t('supplier')} on l_suppkey = s_suppkey""",
        "station_files": f"""
            select event_id, concat(event_type, '_!_station_', cast(user_id as varchar(20)), '.h5') as file_name
            from {t('events')}""",
        "station_meta": f"""
            select cast(c_custkey as int) as station_id, concat('s', cast(c_custkey as varchar(20))) as ref,
                   case when c_mktsegment < 'G' then 'OWNER_A' else 'OWNER_B' end as owner,
                   case when c_nationkey < 4 then 'pedosphere' else 'atmosphere' end as feature,
                   case c_nationkey % 3 when 0 then 'temperature' when 1 then 'wind_speed' else 'unknown' end as parameter,
                   concat('2024-0', cast(4 + c_custkey % 5 as varchar(2)), '-01T00:00:00') as to_date
            from {t('customer')}""",
        "manifest": f"""
            select distinct concat('temperature_2m_!_s', cast(o_custkey as varchar(20)), '.h5') as file_name
            from {t('orders')} where o_orderstatus = 'F'""",
    }


def spark_texts() -> dict[str, str]:
    """Unions of the same rows under several names are one pass here."""
    texts = view_texts(SPARK)
    rows = [
        ("historic", "temperature_2m", "value", "hr < 70"),
        ("current", "temperature_2m", "if(value = -999D, value, value + 0.25D)", "hr >= 55"),
        ("historic", "relative_humidity_2m", "cast(k as double)", "k >= 5 and hr < 70"),
        ("current", "relative_humidity_2m", "cast(k as double)", "k >= 5 and hr >= 55"),
    ]
    structs = ", ".join(
        f"named_struct('tier', '{tier}', 'var', '{var}', 'value', {value}, 'keep', {keep})"
        for tier, var, value, keep in rows)
    texts["series"] = f"""
        select 'nasapower' as source, row.tier, row.var, loc_id, time, row.value from (
          select loc_id, time, explode(array({structs})) as row from obs)
        where row.keep"""
    texts["daily"] = """
        select 'era5' as source, var, loc_id, time, value from (
          select loc_id, time, stack(4, 'runoff', runoff, 'surface_pressure', surface_pressure,
                 'total_cloud_cover', total_cloud_cover, 'snowfall', snowfall) as (var, value) from daily_wide)"""
    return texts


def with_views(query: str, texts: dict[str, str]) -> str:
    """Prefix the query with the views it needs, in order of dependence."""
    needed: list[str] = []

    def need(sql: str) -> None:
        for name in texts:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", sql):
                need(texts[name])
                if name not in needed:
                    needed.append(name)

    need(query)
    if not needed:
        return query
    body = ",\n".join(f"{name} as ({texts[name]})" for name in needed)
    if query.lstrip().lower().startswith("with "):
        return f"with {body},\n{query.lstrip()[5:]}"
    return f"with {body}\n{query}"


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    text = with_views(f"select * from {name}", spark_texts()).replace("{folder}", folder)
    if "{n_locations}" in text:
        text = text.replace("{n_locations}", str(spark.read.parquet(f"{folder}/supplier.parquet").count()))
    return spark.sql(text)


def oracle(query: str) -> str:
    return with_views(query, view_texts(DUCKDB))
