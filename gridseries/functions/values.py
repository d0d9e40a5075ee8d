"""Values, units and distances."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridseries.schema import AREA, KELVIN_OFFSET, SENTINEL


def is_sentinel(value: Column) -> Column:
    """Null-safe: a null or NaN is not a sentinel."""
    return value.eqNullSafe(F.lit(SENTINEL))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def is_valid(value: Column) -> Column:
    """A number: neither missing, NaN nor sentinel. Never null."""
    return value.isNotNull() & ~F.isnan(value) & ~is_sentinel(value)


def celsius(value: Column, kelvin: Column) -> Column:
    return F.when(kelvin, value - F.lit(KELVIN_OFFSET)).otherwise(value)


def milli_degrees(coordinate: Column) -> Column:
    """Integer join key that absorbs float32 noise in grid coordinates."""
    return F.round(coordinate.cast("double") * 1000).cast("bigint")


def degree_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Plain Euclidean distance in degrees, without longitude wrap."""
    dlat, dlon = lat1 - lat2, lon1 - lon2
    return F.sqrt(dlat * dlat + dlon * dlon)


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def strict_double(text: Column) -> Column:
    """Number or null. Java's type suffixes (`12d`, `12f`) are not numbers here."""
    return F.when(~text.rlike(r"(?i)^\s*[+-]?[0-9.][0-9.e+-]*[df]\s*$"), text.try_cast("double"))


def in_area(lat: Column, lon: Column) -> Column:
    north, west, south, east = AREA
    return lat.between(south, north) & lon.between(west, east)


def square(lat: Column, lon: Column) -> Column:
    """(row, column) of a place among one-degree squares; null if it is no finite number.

    Places beyond the poles or the date line share the squares at the edges.
    """
    def place(x: Column, most: int) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(most), F.floor(x))).cast("int")

    return F.when(is_finite(lat) & is_finite(lon), F.struct(place(lat + 90, 179).alias("row"), place(lon + 180, 359).alias("column")))


def curve_cell(lat: Column, lon: Column) -> Column:
    """Number of a place's square on a curve over the map: the bits of row and column in turn.

    Squares that lie together mostly have numbers that lie together.
    """
    own = square(lat, lon)
    code = F.lit(0)
    for i in range(9):
        code = code + F.shiftleft(F.shiftright(own["column"], i).bitwiseAND(F.lit(1)), 2 * i)
        code = code + F.shiftleft(F.shiftright(own["row"], i).bitwiseAND(F.lit(1)), 2 * i + 1)
    return code


def curve_place(lat: Column, lon: Column) -> Column:
    """Number of a place on a curve like that of `curve_cell`, by squares of 2 to the -22 degrees."""
    def every_other_bit(x: Column, most: int) -> Column:
        bits = F.greatest(F.lit(0), F.least(F.lit((most << 22) - 1), F.floor(x * (1 << 22))))
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                            (2, 0x3333333333333333), (1, 0x5555555555555555)):
            bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask))
        return bits

    return F.shiftleft(every_other_bit(lat + 90, 180), 1).bitwiseOR(every_other_bit(lon + 180, 360))
