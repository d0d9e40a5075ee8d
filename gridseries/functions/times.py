"""Time parsing and calendar arithmetic on TIMESTAMP_NTZ.

`date_trunc` on NTZ goes through the session time zone, so months are floored as dates.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_time(x) -> Column:
    """Column, text or naive datetime as TIMESTAMP_NTZ.

    Datetimes go through text: as literals they would be read in the driver's time zone.
    """
    return x if isinstance(x, Column) else F.lit(str(x)).cast("timestamp_ntz")


def parse_hour_key(text: Column) -> Column:
    """`2024010123` -> 2024-01-01 23:00; null for anything else."""
    digits = F.when(text.rlike("^[0-9]{10}$"), text)
    return F.try_to_timestamp(digits, F.lit("yyyyMMddHH")).cast("timestamp_ntz")


def parse_station_time(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd'T'HH:mm:ss"))


def parse_record_time(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def iso_date(text: Column) -> Column:
    """Calendar date or null; dates that do not exist give null."""
    return F.try_to_date(text, "yyyy-M-d")


def day_start(date: Column) -> Column:
    return date.cast("timestamp_ntz")


def day_end(date: Column) -> Column:
    """Last hourly step of the day, 23:00."""
    return date.cast("timestamp_ntz") + F.expr("interval 23 hours")


def month_floor(time: Column, months_back: Column | int = 0) -> Column:
    """First instant of the month that lies `months_back` months earlier."""
    back = F.lit(months_back) if isinstance(months_back, int) else months_back
    return F.trunc(F.add_months(time.cast("date"), -back), "month").cast("timestamp_ntz")


def month_index(time: Column) -> Column:
    """Calendar month as a running number; long series are split by it."""
    return F.year(time) * 12 + F.month(time)


def quarter_index(time: Column) -> Column:
    return F.year(time) * 4 + F.quarter(time)


def date_key(date: Column) -> Column:
    """2024-01-31 -> 20240131."""
    return F.date_format(date, "yyyyMMdd").cast("int")


def hour_label(hour: Column) -> Column:
    """3 -> `03:00`."""
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def month_days(year: Column, month: Column) -> Column:
    """Zero-padded day numbers of a month, as request parameters."""
    last = F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))
    return F.transform(F.sequence(F.lit(1), last), lambda d: F.lpad(d.cast("string"), 2, "0"))
