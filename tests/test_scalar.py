"""Scalar functions: the reference's fixed cases plus edge cases."""
import datetime as dt

from pyspark.sql import functions as F

from tidewatch.functions import scalar as S


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_safe_int(spark):
    df = spark.createDataFrame([(None,), ("12345",), ("99999999999",), ("12.5",), (" 12 ",), ("abc",)], "v string")
    assert [r[0] for r in df.select(S.safe_int("v")).collect()] == [None, 12345, 99999999999, None, 12, None]


def test_safe_bool(spark):
    df = spark.createDataFrame([("true",), ("false",), (None,), ("garbage",)], "v string")
    assert [r[0] for r in df.select(S.safe_bool("v")).collect()] == [True, False, None, None]
    b = spark.createDataFrame([(True,), (False,), (None,)], "v boolean")
    assert [r[0] for r in b.select(S.safe_bool("v")).collect()] == [True, False, None]


def test_iso_durations(spark):
    cases = {"PT4M13S": 253, "PT1H2M30S": 3750, "P1DT2H": 93600, None: None, "P": None, "PT": None,
             "P1Y": None, "P2W": 1209600, "P0D": 0, "PT1.9S": 1, "-PT5S": -5, "garbage": None, "PT10M30S": 630}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r["v"]: r["s"] for r in df.select("v", S.iso8601_duration_seconds("v").alias("s")).collect()}
    assert got == cases


def test_parse_ts_and_ids(spark):
    assert _one(spark, S.parse_ts("v"), "2024-06-01T12:30:00Z") == dt.datetime(2024, 6, 1, 12, 30)
    assert _one(spark, S.parse_ts("v"), "not a time") is None
    assert _one(spark, S.valid_channel_id("v"), "UC" + "a" * 22) is True
    assert _one(spark, S.valid_channel_id("v"), "UC" + "a" * 21 + "!") is False
    assert _one(spark, S.valid_channel_id("v"), None) is False


def test_key_absent(spark):
    df = spark.createDataFrame([({"viewCount": "1"},), ({"commentCount": None},), (None,)], "m map<string,string>")
    assert [r[0] for r in df.select(S.key_absent("m", "commentCount")).collect()] == [True, False, True]


def test_whole_days_floor_not_calendar(spark):
    ref = dt.datetime(2024, 6, 15)
    df = spark.createDataFrame([(dt.datetime(2024, 6, 13, 12),)], "t timestamp")
    # 1.5 days elapsed -> 1 whole day (calendar difference would be 2)
    assert df.select(S.whole_days_between(ref, "t")).first()[0] == 1


def test_engagement_and_vpd(spark):
    ref = dt.datetime(2024, 6, 15)
    df = spark.createDataFrame([(100, 5, None, dt.datetime(2024, 6, 15)), (0, 5, 1, dt.datetime(2024, 6, 1)),
                                (10, 50, 0, None)], "v long, l long, c long, t timestamp")
    r = df.select(S.engagement_rate("l", "c", "v").alias("e"), S.views_per_day("v", "t", ref).alias("p")).collect()
    assert r[0]["e"] == 0.05 and r[0]["p"] == 100.0          # same day: divide by 1
    assert r[1]["e"] is None and r[1]["p"] == 0.0            # zero views: no engagement
    assert r[2]["e"] == 1.0 and r[2]["p"] is None            # clipped to 1; NULL time
    assert df.select(S.cast_numeric(F.lit("NaN"))).first()[0] is None


def test_cast_numeric_takes_decimal_notation_only(spark):
    texts = ["100", " 7 ", "-1.5", "+.5", "1e3", "2E-2", "3.", "inf", "-Infinity", "12d", "7f", "0x1p3", "1L", "nan", "", ".", "1e", "bad", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["v"] for r in df.select("i", S.cast_numeric("t").alias("v")).orderBy("i").collect()]
    assert got == [100.0, 7.0, -1.5, 0.5, 1000.0, 0.02, 3.0, float("inf"), float("-inf")] + [None] * 10


def test_parse_ts_fractions_and_offsets(spark):
    base = "2024-06-15T10:20:30"
    texts = [base, base + "Z", base + ".1234567Z", base + ".123456789", base + "+0000", base + "+00:00", base + ".5+0200",
             "2024-06-15 10:20:30.123456+0000", "2024-06-15", "2024-06-15T25:00:00", "x", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["v"] for r in df.select("i", S.parse_ts("t").cast("string").alias("v")).orderBy("i").collect()]
    t = "2024-06-15 10:20:30"
    assert got == [t, t, t + ".123456", t + ".123456", t, t, "2024-06-15 08:20:30.5", t + ".123456", "2024-06-15 00:00:00", None, None, None]


def test_duration_matches_few_patterns(spark):
    """A duration's text is taken apart once, not once for every number and use."""
    df = spark.createDataFrame([("PT1H2M3S",), ("-P1W2DT3H4M5,9S",), ("+pt7.9s ",), ("PT",), ("P1DT",), ("x;y",), ("",), (None,)], "d string")
    out = df.select(S.iso8601_duration_seconds("d").alias("s"))
    assert [r["s"] for r in out.collect()] == [3723, -788645, 7, None, None, None, None, None]
    assert str(out._jdf.queryExecution().analyzed()).count("(?:T(?:") <= 2


def test_api_times_are_cast(spark):
    """The API's form of a time is cast without trying patterns; what is no time of that form stays null."""
    texts = ["2000-02-29T23:59:59Z", "2000-02-30T00:00:00Z", "2001-01-01T24:00:00Z", "2001-01-01T00:00:00Z\n", " 2001-01-01T00:00:00Z "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string").select("i", S.parse_ts("d").cast("string").alias("t"))
    assert [str(r["t"]) for r in df.orderBy("i").collect()] == ["2000-02-29 23:59:59", "None", "None", "None", "2001-01-01 00:00:00"]
    assert "substring(trim(d" in df._jdf.queryExecution().analyzed().toString()


def test_api_durations_need_no_groups(spark):
    """The API's form of a duration is read without its groups; what looks like it takes the other way."""
    texts = {"PT0S": 0, "PT59M": 3540, "PT1H2S": 3602, " PT100M5S ": 6005, "PT999999999H": 3599999996400, "PT1000000000S": 1000000000,
             "PT1S2M": None, "PTHM": None, "PT5M\n": 300, "pt5m": 300, "PT1.9S": 1, "-PT1H": -3600}
    df = spark.createDataFrame([(t,) for t in texts], "d string").select("d", S.iso8601_duration_seconds("d").alias("s"))
    assert {r["d"]: r["s"] for r in df.collect()} == texts
    assert "substring_index(substring(trim(d" in df._jdf.queryExecution().analyzed().toString()
