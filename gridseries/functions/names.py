"""File-name tokens and dictionary lookups."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridseries.schema import REQUEST_NAMES, VARIABLES

STATION_SEPARATOR = "_!_"


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def station_var(file_name: Column) -> Column:
    return F.split_part(file_name, F.lit(STATION_SEPARATOR), F.lit(1))


def station_ref(file_name: Column) -> Column:
    """Text after the last separator, up to the first dot."""
    last = F.split_part(file_name, F.lit(STATION_SEPARATOR), F.lit(-1))
    return F.split_part(last, F.lit("."), F.lit(1))


def station_file(var: Column, ref: Column, extension: str = "h5") -> Column:
    return F.format_string(f"%s{STATION_SEPARATOR}%s.{extension}", var, ref)


def grid_file(request_name: Column, year: Column, month: Column) -> Column:
    return F.format_string("%s_%d_%d.nc", request_name, year, month)


def grid_file_variable(file_name: Column) -> Column:
    """Grid files are `<request name>_<year>_<month>.<extension>`."""
    tokens = F.split(file_name, "_")
    return F.array_join(F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 2, F.lit(0))), "_")


def request_name(var: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(REQUEST_NAMES), var), var)


def station_variable(feature: Column, parameter: Column) -> Column:
    """Conformed name, or null when the network's name is unknown."""
    return F.try_element_at(literal_map(VARIABLES["stations"]), F.concat_ws("_", feature, parameter))


def matches_file(file_name: Column, prefix=None, suffix=None, extension=None) -> Column:
    tests = []
    if prefix is not None:
        tests.append(file_name.startswith(prefix))
    if suffix is not None:
        tests.append(file_name.endswith(suffix))
    if extension is not None:
        wanted = [extension] if isinstance(extension, str) else extension
        tests.append(reduce(lambda a, b: a | b, [file_name.endswith("." + e) for e in wanted]))
    return reduce(lambda a, b: a & b, tests, F.lit(True))
