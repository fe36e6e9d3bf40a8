"""Scalar functions on hand-written edge rows."""

import math

import pytest
from pyspark.sql import functions as F

from catalog_engine import functions as X
from tests.conftest import one


def ev(spark, fn, value, dtype="string"):
    return one(spark, fn(F.col("x")), value, dtype)


@pytest.mark.parametrize("avg,n,expected", [
    (5.0, 1, 3.1818181818181817),   # the scored release of the leaderboard page
    (4.5, 10, 3.75),                # the README record
    (4.0, 0, 3.0),                  # no votes -> C
])
def test_bayesian_rating(spark, avg, n, expected):
    df = spark.createDataFrame([(avg, n)], "a double, n long")
    got = df.select(X.bayesian_rating("a", "n").alias("r")).first()["r"]
    assert got == pytest.approx(expected, rel=1e-15)


@pytest.mark.parametrize("have,want,expected", [
    (3, 3, 0.75), (5, 15, 2.5), (0, 0, 0.0), (-1, 5, 5.0), (-3, -2, 0.0),
])
def test_demand(spark, have, want, expected):
    df = spark.createDataFrame([(have, want)], "h long, w long")
    assert df.select(X.demand("h", "w").alias("d")).first()["d"] == pytest.approx(expected)


def test_gem_value(spark):
    df = spark.createDataFrame([(3.1818181818181817, 0.75)], "r double, d double")
    assert df.select(X.gem_value("r", "d").alias("g")).first()["g"] == pytest.approx(2.3863636363636362, rel=1e-15)


@pytest.mark.parametrize("value,expected", [
    ("1e3", 1000.0), (" 5 ", 5.0), ("nan", 0.0), ("1,000", 0.0), ("", 0.0), (None, 0.0),
    ("12.5", 12.5), ("-2", -2.0),
])
def test_num_or_zero(spark, value, expected):
    assert ev(spark, X.num_or_zero, value) == expected


def test_num_or_zero_inf(spark):
    assert math.isinf(ev(spark, X.num_or_zero, "inf"))


@pytest.mark.parametrize("year,released,expected", [
    ("1999", "2001-01-01", 1999), ("0", None, 0), ("Unknown", "1998-03-01", None),
    ("", "1998-03-01", None), (None, "1998-03-01", 1998), (None, None, None), ("1999.5", None, None),
    ("1999.0", None, 1999),
])
def test_release_year(spark, year, released, expected):
    df = spark.createDataFrame([(year, released)], "y string, r string")
    assert df.select(X.release_year("y", "r").alias("o")).first()["o"] == expected


@pytest.mark.parametrize("value,expected", [
    ("https://a", "https://a"), ("a,b", "a"), ("a b", "a"), ("a;b", "a"), (",a", ""),
    (None, None), ("", None), (" a , b", "a"), ("x y,z", "x y"), ("x;y z", "x;y"),
])
def test_first_link(spark, value, expected):
    assert ev(spark, X.first_link, value) == expected


@pytest.mark.parametrize("title,artist,expected", [
    ("Song", "Artist", "Artist - Song"),
    ("ARTIST - Song", "artist", "ARTIST - Song"),
    ("Song", "", "Song"),
    ("Song", None, "Song"),
    (" Song ", " A ", "A - Song"),
    (None, "A", None),
])
def test_clean_title(spark, title, artist, expected):
    df = spark.createDataFrame([(title, artist)], "t string, a string")
    assert df.select(X.clean_title("t", "a").alias("o")).first()["o"] == expected


@pytest.mark.parametrize("title,expected", [
    ("India (2) - India - Stay With Me (Special Remix) Disco-Tec Sencillo = Quédate Conmigo", "India (2)"),
    ("No separator", "Unknown Artist"), (" - X", ""), (None, "Unknown Artist"), ("  A  - B", "A"),
])
def test_artist_from_title(spark, title, expected):
    assert ev(spark, X.artist_from_title, title) == expected


@pytest.mark.parametrize("url,expected", [
    ("https://www.youtube.com/watch?v=96XKde8YHk8", "96XKde8YHk8"),
    ("https://youtu.be/96XKde8YHk8", "96XKde8YHk8"),
    ("https://www.youtube.com/embed/abcdefghijk?rel=0", "abcdefghijk"),
    ("https://example.org/video", None),
    ("https://www.youtube.com/watch?v=short", None),
])
def test_youtube_id(spark, url, expected):
    assert ev(spark, X.youtube_id, url) == expected


@pytest.mark.parametrize("value,expected", [(None, "Unknown Label"), ("", "Unknown Label"), ("X, Y", "X, Y")])
def test_label_key(spark, value, expected):
    assert ev(spark, X.label_key, value) == expected


@pytest.mark.parametrize("value,expected", [(" A ", "A"), ("", "Unknown"), ("\t ", "Unknown"), (None, None)])
def test_artist_key(spark, value, expected):
    assert ev(spark, X.artist_key, value) == expected


@pytest.mark.parametrize("value,expected", [("1999", 1999), (" 42abc", 42), ("abc", 0), (None, 0), ("-5", -5)])
def test_parse_int(spark, value, expected):
    assert ev(spark, X.parse_int, value) == expected


@pytest.mark.parametrize("value,expected", [("3.5x", 3.5), (".5", 0.5), ("abc", 0.0), ("1e3", 1000.0),
                                            (None, 0.0), ("-2.25", -2.25)])
def test_parse_float(spark, value, expected):
    assert ev(spark, X.parse_float, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("[]", 0), ('[{"duration":"1:00"}]', 1), ("bad", 0), (None, 0), ('{"a":1}', 0), ("null", 0),
    ('[1, "x", {"a": 2}]', 3),
])
def test_num_tracks(spark, value, expected):
    assert ev(spark, X.num_tracks, value) == expected


@pytest.mark.parametrize("value,expected", [
    ('[{"duration":"5:30"}]', 5.5),
    ('[{"duration":""}]', 0.0),
    ('[{"duration":"1:02:03"}]', 0.0),
    ('[{}]', 0.0),
    ('[{"duration":"a:b"}]', 0.0),
    ('[{"duration":"5:30"},{"duration":"1:30"}]', 7.0),
    ('[{"duration":" 2 : 30 "}]', 2.5),
    ('[{"duration":"5:30"}, "junk", {"duration":"0:30"}]', 6.0),
    ("bad", 0.0), (None, 0.0),
])
def test_total_duration_min(spark, value, expected):
    assert ev(spark, X.total_duration_min, value) == pytest.approx(expected)


@pytest.mark.parametrize("value,expected", [
    ("Folk, World, & Country", ["Folk", "World", "& Country"]), ("", []), (None, []), ("a,,b , ", ["a", "b"]),
])
def test_csv_tokens(spark, value, expected):
    assert ev(spark, X.csv_tokens, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("Folk, World, & Country", ["Folk", "World", "& Country"]), ("", [""]), ("a, ", ["a", ""]),
])
def test_list_tokens(spark, value, expected):
    assert ev(spark, X.list_tokens, value) == expected


@pytest.mark.parametrize("json_text,lenient,strict", [
    ("12.5", 12.5, 12.5), ('{"value": 3}', 3.0, 3.0), ("null", 0.0, 0.0), ('"7"', 7.0, 0.0),
    ('{"currency": "EUR"}', 0.0, 0.0), ('"abc"', 0.0, 0.0),
])
def test_lowest_price(spark, json_text, lenient, strict):
    df = spark.createDataFrame([(json_text,)], "t string").select(F.parse_json("t").alias("v"))
    out = df.select(X.lowest_price("v").alias("a"), X.lowest_price("v", strict=True).alias("b")).first()
    assert (out["a"], out["b"]) == (lenient, strict)


def test_lowest_price_missing(spark):
    df = spark.createDataFrame([(None,)], "t string").select(F.parse_json("t").alias("v"))
    assert df.select(X.lowest_price("v").alias("a")).first()["a"] == 0.0


def test_payload_lists(spark):
    df = spark.createDataFrame(
        [(["Rock", "Pop"], [{"name": "Vinyl"}, {"name": ""}, {"name": None}, {"name": "LP"}],
          [{"name": "L1", "catno": "c"}, {"name": None, "catno": None}],
          [{"uri": "https://www.YouTube.com/watch?v=abcdefghijk"}, {"uri": "https://vimeo.com/1"}, {"uri": None}])],
        "g array<string>, f array<struct<name:string>>, l array<struct<name:string,catno:string>>, "
        "v array<struct<uri:string>>").withColumn("l", F.parse_json(F.to_json("l", {"ignoreNullFields": "false"})))
    r = df.select(X.join_list("g").alias("g"), X.format_names("f").alias("f"), X.label_names("l").alias("l"),
                  X.youtube_links("v").alias("v"), X.join_list(F.lit(None).cast("array<string>")).alias("n"),
                  X.as_json("l").alias("j")).first()
    assert r["g"] == "Rock, Pop"
    assert r["f"] == "Vinyl, LP"
    assert r["l"] == "L1, "
    assert r["v"] == "https://www.YouTube.com/watch?v=abcdefghijk"
    assert r["n"] == ""
    import json
    assert json.loads(r["j"]) == [{"name": "L1", "catno": "c"}, {"name": None, "catno": None}]


def test_number_text_as_python_writes_it(spark):
    from catalog_engine.sources.files import number_text
    values = [0.0005, 12345678.0, 5e-05, 1e16, 3.0, 0.0, -0.0, 1.5, -2.25, 1e22, 1.2345e-7, 123456789012345.6,
              9999999999999998.0, 1e-4, 0.00012345, 1e100, -1e-300, 12345678.9, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(number_text("v"))
    assert [r[0] for r in df.collect()] == [None if v is None else str(v) for v in values]


def test_fixed2_uses_the_exact_value(spark):
    from decimal import ROUND_HALF_UP, Decimal
    import random
    r = random.Random(1)
    values = [2.675, 0.125, 1.005, 0.015, 0.005, 0.375, 8.345, 1234567.895, 0.995, 99.995] + [
        r.randrange(1, 10 ** 6) / 1000 for _ in range(500)] + [r.random() * 100 for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(X.fixed2("v"))
    want = [str(Decimal(v).quantize(Decimal("0.01"), ROUND_HALF_UP)) for v in values]
    assert [x[0] for x in df.collect()] == want


def test_display_values(spark):
    df = spark.createDataFrame([(3.1818181818181817, 1, 0.75, None, "https://www.youtube.com/watch?v=96XKde8YHk8, x"),
                                (None, None, 0.125, 2.3863636363636362, ""),
                                (1.0, 3, 0.0, 0.0, "https://example.org/x")],
                               "r double, n long, d double, g double, y string")
    got = [tuple(x) for x in df.select(X.rating_display("r", "n"), X.fixed2("d"), X.fixed2("g"),
                                       X.preview("y")).collect()]
    assert got == [("3.18 (1)", "0.75", "0.00", "96XKde8YHk8"),
                   ("0.00 (0)", "0.13", "2.39", "No links"),
                   ("1.00 (3)", "0.00", "0.00", "Invalid link")]
