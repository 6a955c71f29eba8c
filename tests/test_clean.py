"""Cleaning rules, one case per oddity of the sources."""

import datetime

from pyspark.sql import functions as F

from wastelake.functions import clean, geo


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_waste_name_tells_null_absent_and_unlisted_apart(spark):
    rows = [('{"waste_type": 1}',), ('{"waste_type": null}',), ("{}",), ('{"waste_type": 23}',),
            ('{"waste_type": -1}',), ('{"waste_type": 99}',), ('{"waste_type": 31}',)]
    assert values(spark, rows, "j string", clean.waste_name("j")) == [
        "Rest", "Unknown", "Unkown", "Unknown", "Unkown", "Unkown", "KCA"]


def test_bad_dates_go_before_the_cast(spark):
    rows = [("0000-01-01",), ("-0001-11-30",), ("-1001-01-01",), ("2018-10-01",), (None,)]
    assert values(spark, rows, "d string", clean.drop_bad_date("d")) == [None, None, None, "2018-10-01", None]


def test_weights(spark):
    rows = [("1070", "835", "235"), ("249", "835", "235"), ("250", "250", "0"), ("x", "835", "235"),
            ("1070", "", "235"), ("1070", "835", ""), ("1070", "835", "-1"), ("1070", " 835 ", "235")]
    w = clean.weights("f", "s", "n")
    got = spark.createDataFrame(rows, "f string, s string, n string").select(
        w["first_weight"], w["second_weight"], w["net_weight"], w["valid"]).collect()
    assert [r[3] for r in got] == [True, False, True, True, False, False, False, True]
    assert got[3][0] is None and got[4][1] is None and got[7][1] == 835


def test_numbers(spark):
    rows = [(" 12 ",), ("12.5",), ("nan",), ("",), (None,)]
    assert values(spark, rows, "t string", clean.safe_int("t")) == [12, None, None, None, None]
    assert values(spark, rows, "t string", clean.safe_float("t")) == [12.0, 12.5, None, None, None]


def test_fractions(spark):
    rows = [("",), ("1",), ("Kunststof",), ("Gft",), ("Pmd",), ("Glas",)]
    assert values(spark, rows, "t string", clean.canonical_fraction("t")) == [
        "Rest", "Rest", "Plastic", "GFT", "PMD", "Glas"]


def test_date_and_time(spark):
    rows = [("2018-10-01", "09:17:54"), ("", "09:17:54"), ("2018-10-01", ""), (None, "09:17:54")]
    assert values(spark, rows, "d string, t string", clean.combine_date_time("d", "t")) == [
        datetime.datetime(2018, 10, 1, 9, 17, 54), None, None, None]


def test_snake_names():
    assert clean.snake_name("CommunicationDateTime") == "communication_date_time"
    assert clean.snake_name("NrPressStrokesToGo") == "nr_press_strokes_to_go"


def test_new_year_week_keeps_the_calendar_year(spark):
    p = clean.period_parts("t")
    got = spark.createDataFrame([("2017-01-01",)], "t string").select(F.col("t").cast("timestamp").alias("t")).select(
        p["week"], p["year"], clean.period_parts("t", iso_year=True)["year"]).first()
    assert tuple(got) == (52, 2017, 2016)


def test_press_weights(spark):
    rows = [(0, 2000, 2000, "Rest", "N", False), (0, 2000, 2000, "Rest", "A", False), (0, 841, 841, "Papier", "N", False),
            (0, 840, 840, "Papier", "N", False), (0, 2000, 2000, "Plastic", "N", False), (5, 2000, 2000, "Rest", "N", True)]
    c = clean.corrected_press_weights("f", "s", "n", "frac", "d", "v")
    got = spark.createDataFrame(rows, "f int, s int, n int, frac string, d string, v boolean").select(
        c["net_weight"], c["valid"]).collect()
    assert [tuple(r) for r in got] == [(480, True), (2000, False), (-9, True), (840, False), (2000, False), (2000, True)]


def test_site_key_rounds_and_skips_missing_codes(spark):
    rows = [(10.5, 11.5, "A", None), (10.4, 11.6, "A", "04a")]
    assert values(spark, rows, "x double, y double, d string, b string", clean.site_key("x", "y", "d", "b")) == [
        "10-12-A", "10-12-A04a"]


def test_rd_control_values(spark):
    df = spark.createDataFrame([(4.8357449, 52.3698168, 121700.0, 491833.0)], "lon double, lat double, x double, y double")
    rd, deg = geo.wgs84_to_rd("lon", "lat"), geo.rd_to_wgs84("x", "y")
    x, y, lon, lat = df.select(rd["x_rd"], rd["y_rd"], deg["lon"], deg["lat"]).first()
    assert abs(x - 117443.04) < 0.01 and abs(y - 487024.50) < 0.01
    assert abs(lon - 4.897772) < 1e-6 and abs(lat - 52.413307) < 1e-6


def test_polygon_with_hole(spark):
    text = "POLYGON((0 0,10 0,10 10,0 10,0 0),(2 2,2 4,4 4,4 2,2 2))"
    df = spark.range(1).select(geo.rings_from_wkt(F.lit(text)).alias("r"))
    got = df.select(
        geo.contains("r", "1D", "1D"), geo.contains("r", "3D", "3D"), geo.contains("r", "0D", "5D"),
        geo.covers("r", "0D", "5D"), geo.covers("r", "2D", "3D"), geo.point_polygon_distance("3D", "3D", "r"),
        geo.point_polygon_distance("13D", "14D", "r"), geo.rings_to_wkt("r")).first()
    assert tuple(got) == (True, False, False, True, True, 1.0, 5.0, text)
