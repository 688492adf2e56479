import datetime as dt

import pytest

from revlens.functions import timefeat as tf

ROWS = [
    (0, "06 3, 2014", None), (1, "6 3, 2014", 0), (2, "13 40, 2014", None), (3, "soon", 86400 + 3600), (4, None, None),
    (5, None, -1), (6, "02 29, 2015", None), (7, "12 31, 1999", 5),
]
SCHEMA = "id int, reviewTime string, unixReviewTime bigint"


def test_row_fallback(spark):
    out = tf.review_time_features(spark.createDataFrame(ROWS, SCHEMA)).orderBy("id").collect()
    day = dt.datetime(2014, 6, 3)
    assert [r["review_date"] for r in out] == [
        day, day, None, dt.datetime(1970, 1, 2, 1), None, dt.datetime(1969, 12, 31, 23, 59, 59), None,
        dt.datetime(1999, 12, 31),
    ]
    assert [r["review_hour"] for r in out] == [0, 0, 0, 1, 0, 23, 0, 0]
    assert [r["review_dayofweek"] for r in out] == [1, 1, 0, 4, 0, 2, 0, 4]
    assert [r["review_year"] for r in out] == [2014, 2014, 0, 1970, 0, 1969, 0, 1999]


def test_all_or_nothing(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    some = tf.review_time_features(df, missing=-1, fallback="all").orderBy("id").collect()
    assert [r["review_hour"] for r in some] == [0, 0, -1, -1, -1, -1, -1, 0]
    none = tf.review_time_features(df.where("id IN (2, 3, 5)"), missing=-1, fallback="all").orderBy("id").collect()
    assert [r["review_hour"] for r in none] == [-1, 1, 23]


@pytest.mark.parametrize(
    "stamp, days", [("2020-01-01 00:00:00", 1), ("2020-01-01 12:00:01", 0), ("2020-01-02 12:00:00", 0), ("2020-01-03 00:00:00", -1)]
)
def test_days_since_rounds_down(spark, stamp, days):
    df = spark.createDataFrame([(stamp,)], "reviewTime string")
    out = tf.review_time_features(df, missing=-9, fallback="none", asof="2020-01-02 12:00:00", formats=("yyyy-MM-dd HH:mm:ss",))
    expected = (dt.datetime(2020, 1, 2, 12) - dt.datetime.fromisoformat(stamp)).days
    assert out.first()["review_days_since"] == expected == days


def test_session_zone_does_not_matter(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    before = tf.review_time_features(df, asof="2021-03-04").orderBy("id").collect()
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert tf.review_time_features(df, asof="2021-03-04").orderBy("id").collect() == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_no_time_columns(spark):
    out = tf.review_time_features(spark.range(1), missing=-1)
    assert out.first()["review_year"] == -1


def test_lenient(spark):
    df = spark.createDataFrame([("2014-06-03",), ("06/03/2014",), ("Jun 3, 2014",), ("x",)], "t string")
    got = [r[0] for r in df.select(tf.parse_lenient("t")).collect()]
    assert got == [dt.datetime(2014, 6, 3)] * 3 + [None]
