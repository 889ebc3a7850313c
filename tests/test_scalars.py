from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.functions import initcap_delims, local_datetime, platform_label, typed_cast


def test_initcap_breaks_words_at_punctuation(spark):
    df = spark.createDataFrame(
        [("foo_bar-baz qux",), ("AUDIENCE_NETWORK",), ("a.b/c(d)e",), ("",), (None,),
         ("2nd_place",), ("customer#000000001",)], "s string")
    got = dict((r.s, r.o) for r in df.select("s", initcap_delims("s").alias("o")).collect())
    assert got["foo_bar-baz qux"] == "Foo_Bar-Baz Qux"
    assert got["AUDIENCE_NETWORK"] == "Audience_Network"
    assert got["a.b/c(d)e"] == "A.B/C(D)E"
    assert got[""] == ""
    assert got[None] is None
    assert got["2nd_place"] == "2nd_Place"
    assert got["customer#000000001"] == "Customer#000000001"


def test_platform_labels(spark):
    raw = ["facebook", "instagram", "messenger", "audience_network", "unknown", "threads_app",
           None, "Facebook"]
    df = spark.createDataFrame([(r,) for r in raw], "p string")
    got = [r.o for r in df.select(platform_label("p").alias("o")).collect()]
    assert got == ["Facebook", "Instagram", "Messenger", "Audience Network", "Unknown",
                   "Threads_App", None, "Facebook"]


def test_float_to_int64_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (1.5,), (-2.5,), (0.49,), (None,)], "x double")
    col = typed_cast(F.col("x"), T.LongType(), T.DoubleType())
    assert [r.o for r in df.select(col.alias("o")).collect()] == [3, 2, -3, 0, None]
    # integral sources are cast as they are; decimals round too
    d = spark.createDataFrame([(7,)], "x bigint").select(
        typed_cast(F.col("x"), T.LongType(), T.LongType()).alias("o"))
    assert d.first().o == 7
    e = spark.sql("SELECT CAST(2.5 AS DECIMAL(10,2)) AS x")
    assert e.select(typed_cast(F.col("x"), T.LongType(), T.DecimalType(10, 2)).alias("o")).first().o == 3


def test_local_datetime_from_instant_and_from_utc_wall_clock(spark):
    # 03:00 UTC is 22:00 of the previous day in New York (local date differs from UTC date)
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:00:00' AS ntz, "
                   "CAST('2024-01-02 03:00:00' AS TIMESTAMP) AS ts")
    r = df.select(local_datetime("ntz", "America/New_York", T.TimestampNTZType()).alias("a"),
                  local_datetime("ts", "America/New_York", T.TimestampType()).alias("b")).first()
    assert str(r.a) == "2024-01-01 22:00:00"
    assert str(r.b) == "2024-01-01 22:00:00"
    # summer time: UTC-4
    r = spark.sql("SELECT TIMESTAMP_NTZ '2024-07-01 03:00:00' AS ntz").select(
        local_datetime("ntz", "America/New_York", T.TimestampNTZType()).alias("a")).first()
    assert str(r.a) == "2024-06-30 23:00:00"


def test_utc_date_ignores_the_session_zone(spark):
    from spendlens.functions import utc_date
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        df = spark.sql("SELECT CAST('2024-01-01 23:30:00' AS TIMESTAMP) AS ts, "
                       "TIMESTAMP_NTZ '2024-01-01 23:30:00' AS ntz")  # instant made under UTC
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")   # 08:30 next day there
        r = df.select(utc_date("ts", T.TimestampType()).alias("a"),
                      utc_date("ntz", T.TimestampNTZType()).alias("b"),
                      F.to_date("ts").alias("naive")).first()
        assert str(r.a) == "2024-01-01" and str(r.b) == "2024-01-01"
        assert str(r.naive) == "2024-01-02"   # what plain to_date would have given
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_repeated_hour_of_a_clock_change_is_kept(spark):
    """2024-11-03 05:30Z and 06:30Z are both 01:30 in New York."""
    from spendlens.functions.scalars import utc_date
    old = spark.conf.get("spark.sql.session.timeZone")
    df = spark.range(1).select(F.timestamp_micros(F.lit(1730611800 * 1_000_000)).alias("a"),
                               F.timestamp_micros(F.lit(1730615400 * 1_000_000)).alias("b"))
    try:
        for zone in ("America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = df.select(*[local_datetime(c, z, T.TimestampType()).cast("string")
                            for c in "ab" for z in ("UTC", "America/New_York")],
                          utc_date("b", T.TimestampType()).cast("string")).first()
            assert list(r) == ["2024-11-03 05:30:00", "2024-11-03 01:30:00",
                               "2024-11-03 06:30:00", "2024-11-03 01:30:00", "2024-11-03"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
