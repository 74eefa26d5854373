"""Location keys, geohash cells, boxes and distances as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isodose.functions.numeric import fixed_decimals

# --- fixed value: the geohash alphabet ---
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
NO_LOCATION = "00000000"
EARTH_RADIUS_KM = 6371.0088


def sensor_key(lat: Column, lon: Column) -> Column:
    """First eight hex digits of the MD5 of the six-decimal coordinates, upper case."""
    text = F.concat(fixed_decimals(lat, 6), F.lit("_"), fixed_decimals(lon, 6))
    return F.coalesce(F.upper(F.substring(F.md5(text), 1, 8)), F.lit(NO_LOCATION))


def _grid_index(value: Column, low: float, span: float, bits: int) -> Column:
    """Index of the half-open interval (low edge, high edge] that holds ``value``.

    A value on an edge belongs to the interval below it; the outermost edges are
    clamped.  Widths are powers of two of the span, so edges are exact doubles.
    """
    width = span / 2**bits
    guess = F.floor((value - F.lit(low)) / F.lit(width))
    edge = guess * F.lit(width) + F.lit(low)
    index = guess - (value <= edge).cast("bigint") + (value > edge + F.lit(width)).cast("bigint")
    return F.greatest(F.lit(0), F.least(F.lit(2**bits - 1), index)).cast("bigint")


def geohash_bits(precision: int) -> tuple[int, int]:
    """(longitude bits, latitude bits) of a geohash with ``precision`` characters."""
    total = 5 * precision
    return (total + 1) // 2, total // 2


def with_geohash(
    df: DataFrame,
    precision: int = 5,
    lat: str = "latitude",
    lon: str = "longitude",
    names: tuple[str, str, str] = ("geohash", "cell_lat", "cell_lon"),
) -> DataFrame:
    """Add the cell name and the cell centre of each point.

    Two projections: the grid indices are computed once and then reused for the
    characters and the centre.
    """
    lon_bits, lat_bits = geohash_bits(precision)
    lat_width, lon_width = 180.0 / 2**lat_bits, 360.0 / 2**lon_bits
    indexed = df.select(
        "*",
        _grid_index(F.col(lat), -90.0, 180.0, lat_bits).alias("_row"),
        _grid_index(F.col(lon), -180.0, 360.0, lon_bits).alias("_column"),
    )

    def bit(position: int) -> Column:
        # Bits alternate longitude, latitude, longitude, ... from the most significant one.
        index, left = ("_column", lon_bits) if position % 2 == 0 else ("_row", lat_bits)
        return F.shiftright(F.col(index), left - 1 - position // 2).bitwiseAND(F.lit(1))

    characters = []
    for start in range(0, 5 * precision, 5):
        code = F.lit(0)
        for position in range(start, start + 5):
            code = code * 2 + bit(position)
        characters.append(F.substr(F.lit(GEOHASH_ALPHABET), (code + 1).cast("int"), F.lit(1)))
    geohash, cell_lat, cell_lon = names
    return indexed.select(
        *df.columns,
        F.concat(*characters).alias(geohash),
        ((F.col("_row") + 0.5) * lat_width - 90.0).alias(cell_lat),
        ((F.col("_column") + 0.5) * lon_width - 180.0).alias(cell_lon),
    )


def in_box(lat: Column, lon: Column, s, w, n, e) -> Column:
    """Inside the box, edges included."""
    return lat.between(s, n) & lon.between(w, e)


def parse_bbox(text: str) -> tuple[float, float, float, float]:
    """``"w,s,e,n"`` as (s, w, n, e)."""
    try:
        west, south, east, north = (float(part) for part in text.split(","))
    except ValueError:
        raise ValueError("bbox must be 'min_lon,min_lat,max_lon,max_lat'") from None
    return south, west, north, east


def unit_sphere(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Cartesian coordinates on the unit sphere; chords order points like great circles do."""
    phi, lam = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def chord_to_km(chord_squared: Column) -> Column:
    """Great-circle length of a chord on the unit sphere."""
    half = F.least(F.lit(1.0), F.sqrt(chord_squared) / 2)
    return F.asin(half) * (2 * EARTH_RADIUS_KM)
