"""Scalar functions on hand-made edge rows."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from isodose.functions import geo, levels, numeric, parse, text
from isodose.operators import quality


def one(spark, column, **values):
    """Value of a column expression over one row of Python values."""
    kinds = {str: "string", float: "double", int: "long"}
    ddl = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], ddl).select(column).first()[0]


TIMES = {
    "2024-01-05 03:04:05": 1704423845000,
    " 2024-01-05 03:04:05.5 ": 1704423845500,
    "2024-1-5 3:4:5": 1704423845000,
    "2024-01-05 03:04:05.123456": 1704423845123,
    "2024-13-05 03:04:05": None,
    "2024-02-30 03:04:05": None,
    "2024-01-05 03:04:60": None,
    "2024-01-05": None,
    "2024-01-05T03:04:05": None,
    "2024-01-05 03:04:05.1234567": None,
    "2024-01-05 03:04:05+01:00": None,
    "": None,
    "NaT": None,
    "none": None,
}


def test_times(spark):
    df = spark.createDataFrame([(t,) for t in TIMES], "t string")
    got = df.select("t", parse.epoch_ms(parse.utc_time(F.col("t"))).alias("ms")).collect()
    assert {r.t: r.ms for r in got} == TIMES
    blank = df.filter(parse.is_blank_time(F.col("t"))).collect()
    assert {r.t for r in blank} == {"", "NaT", "none"}


NUMBERS = {
    "7": 7.0, " 7 ": 7.0, "-1.5e3": -1500.0, ".5": 0.5, "5.": 5.0, "+2": 2.0, "1_000": 1000.0,
    "inf": math.inf, "-Infinity": -math.inf,
    "nan": None, "1.5f": None, "2d": None, "": None, "abc": None, "0x10": None, "1__0": None, "_1": None, "1 2": None,
}


def test_numbers(spark):
    df = spark.createDataFrame([(t,) for t in NUMBERS], "t string")
    got = df.select("t", parse.number(F.col("t")).alias("v")).collect()
    assert {r.t: r.v for r in got} == NUMBERS


def test_json_records(spark):
    good = (
        '{"captured_time": "2024-01-05 03:04:05", "uploaded_time": "u", "latitude": "1.5", '
        '"longitude": 2, "value": "nan", "unit": " CPM ", "height": "9"}'
    )
    lines = [good, "[1]", '"x"', "junk", "{'captured_time': '2024-01-05 03:04:05'}", "{}", ""]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i long, value string")
    rows = {r.i: r for r in parse.parse_json(df, keep=("i",)).collect()}
    assert tuple(rows[0])[1:] == (1704423845000, "u", 1.5, 2.0, None, "cpm")
    assert all(rows[i].captured_at is None and rows[i].latitude is None for i in range(1, 7))


def parsed(spark, rows):
    ddl = "captured_at long, uploaded_at string, latitude double, longitude double, cpm double, unit string"
    return spark.createDataFrame(rows, ddl)


def test_clean_bounds_and_reasons(spark):
    low, high = 1_293_840_000_000, 1_798_761_600_000
    ok = (low, "", 10.0, 20.0, 5.0, "cpm")

    def but(**changes):
        names = ["captured_at", "uploaded_at", "latitude", "longitude", "cpm", "unit"]
        return tuple(changes.get(name, value) for name, value in zip(names, ok))

    cases = [
        (ok, None),
        (but(captured_at=high), None),
        (but(latitude=90.0, longitude=-180.0), None),
        (but(latitude=0.0, longitude=5.0), None),
        (but(cpm=9999.99), None),
        (but(captured_at=None), "no_time"),
        (but(captured_at=low - 1), "time_out_of_range"),
        (but(captured_at=high + 1), "time_out_of_range"),
        (but(unit="usv"), "wrong_unit"),
        (but(unit=None), "wrong_unit"),
        (but(cpm=None), "no_value"),
        (but(cpm=0.0), "value_out_of_range"),
        (but(cpm=10000.0), "value_out_of_range"),
        (but(cpm=math.inf), "value_out_of_range"),
        (but(latitude=None), "no_position"),
        (but(latitude=90.1), "position_out_of_range"),
        (but(longitude=-180.5), "position_out_of_range"),
        (but(latitude=0.0, longitude=0.0), "null_island"),
    ]
    df = parsed(spark, [case for case, _ in cases])
    reasons = [r.reason for r in df.select(quality.reject_reason().alias("reason")).collect()]
    assert reasons == [reason for _, reason in cases]
    clean, rejects = quality.split_rejects(df)
    assert (clean.count(), rejects.count()) == (5, 13)
    assert quality.clean_readings(df).count() == 5
    assert tuple(quality.raw_clean_dropped(df).first()) == (18, 5, 13)


def test_exact_decimals(spark):
    rng = random.Random(2)
    values = [35.0000005, 0.0000005, 0.0000015, -0.0000001, -0.0, 0.0, 0.125, 2.5, -2.675, 1.005]
    values += [round(rng.uniform(-180, 180), 7) for _ in range(3000)]
    values += [rng.randrange(-(10**6), 10**6) / 2**14 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    v = F.col("v")
    got = df.select(
        "v", numeric.fixed_decimals(v, 6), numeric.fixed_decimals(v, 4),
        numeric.round_exact(v, 2), numeric.round_exact(v, 5),
    ).collect()
    for value, six, four, two, five in got:
        assert (six, four) == (f"{value:.6f}", f"{value:.4f}")
        assert (two, five) == (round(value, 2), round(value, 5))


def test_sensor_key(spark):
    for lat, lon in [(35.0000005, 139.7), (-0.0000001, 0.0), (90.0, -180.0)]:
        want = hashlib.md5(b"%.6f_%.6f" % (lat, lon)).hexdigest()[:8].upper()
        assert one(spark, geo.sensor_key(F.col("a"), F.col("b")), a=lat, b=lon) == want
    assert one(spark, geo.sensor_key(F.lit(None).cast("double"), F.col("b")), b=1.0) == "00000000"


def bisect_cell(lat, lon, precision):
    """Halve the ranges one bit at a time; a value on the middle goes to the lower half."""
    low, high = [-180.0, -90.0], [180.0, 90.0]
    bits = []
    for i in range(5 * precision):
        axis, value = i % 2, (lon, lat)[i % 2]
        middle = (low[axis] + high[axis]) / 2
        upper = value > middle
        bits.append(int(upper))
        (low if upper else high)[axis] = middle
    codes = [int("".join(map(str, bits[i:i + 5])), 2) for i in range(0, len(bits), 5)]
    name = "".join(geo.GEOHASH_ALPHABET[c] for c in codes)
    return name, (low[1] + high[1]) / 2, (low[0] + high[0]) / 2


@pytest.mark.parametrize("precision", [1, 2, 5, 6, 8])
def test_geohash(spark, precision):
    rng = random.Random(precision)
    points = [(0.0, 0.0), (90.0, 180.0), (-90.0, -180.0), (5e-324, -5e-324), (45.0, 90.0), (-45.0, 135.0)]
    points += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(1000)]
    points += [(rng.randrange(-90 * 64, 90 * 64) / 64, rng.randrange(-180 * 64, 180 * 64) / 64) for _ in range(500)]
    df = geo.with_geohash(spark.createDataFrame(points, "latitude double, longitude double"), precision)
    for lat, lon, *cell in df.collect():
        assert tuple(cell) == bisect_cell(lat, lon, precision)


def test_levels(spark):
    for cpm, want in [(99.9, "safe"), (100.0, "warning"), (199.9, "warning"), (200.0, "elevated"), (300.0, "high")]:
        assert one(spark, levels.level_of(F.col("c"), 100), c=cpm) == want
    assert one(spark, levels.level_of(F.col("c"), 0), c=0.1) == "high"
    for cpm, want in [(49.9, "safe"), (50.0, "warning"), (100.0, "elevated"), (300.0, "high")]:
        assert one(spark, levels.level_band(F.col("c")), c=cpm) == want
    assert one(spark, levels.heat_intensity(F.col("l")), l="odd") == 0.15
    assert one(spark, levels.level_name(levels.level_rank(F.col("l"))), l="elevated") == "elevated"
    assert one(spark, levels.marker_radius(F.col("c")), c=6000.0) == 12.0


def test_names(spark):
    def name(city, country):
        return one(
            spark, text.display_name(F.col("a"), F.col("b"), F.col("x"), F.col("y")),
            a=city, b=country, x=1.23456, y=-2.0,
        )

    assert name("Koriyama", "Japan") == "Koriyama, Japan"
    assert name("", "Japan") == "Japan"
    assert name("Koriyama", "") == "Koriyama"
    assert name("", "") == "1.2346, -2.0000"
    label = text.sensor_label(F.col("a"), F.col("b"), F.lit("KEY"))
    assert one(spark, label, a="", b="") == "KEY"
    assert one(spark, text.alert_text(F.col("l"), F.lit("X")), l="high") == "Dangerous radiation detected in X"
    assert one(spark, text.alert_text(F.col("l"), F.lit("X")), l="odd") == "Radiation detected in X"


def test_bbox_text():
    assert geo.parse_bbox("1,2,3,4") == (2.0, 1.0, 4.0, 3.0)
    for bad in ("1,2,3", "a,b,c,d", "1,2,3,4,5"):
        with pytest.raises(ValueError):
            geo.parse_bbox(bad)
