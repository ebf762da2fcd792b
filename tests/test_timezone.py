"""Results must not depend on the session time zone (daylight-saving gaps)."""

import datetime as dt

import pytest

from bizlens.functions.dates import seconds_between, short_date_text, week_start
from bizlens.plans import cleaning


@pytest.fixture
def new_york(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


def test_dst_gap_wall_clock_kept(new_york):
    spark = new_york
    raw = spark.createDataFrame([(1, 1, "1998-04-05 02:14:47", "5km", "10", None)],
                                "order_id long, runner_id int, pickup_time string, distance string, "
                                "duration string, cancellation string")
    got = cleaning.clean_deliveries(raw).collect()[0].pickup_time
    assert got == dt.datetime(1998, 4, 5, 2, 14, 47)
    df = spark.sql("SELECT timestamp_ntz'1998-04-05 01:47:00' AS a, timestamp_ntz'1998-04-05 02:14:47' AS b, "
                   "DATE'1998-06-18' AS d")
    r = df.select(seconds_between("a", "b").alias("s"), week_start("d").alias("w"),
                  short_date_text("d").alias("t")).collect()[0]
    assert (float(r.s), r.w, r.t) == (1667.0, dt.date(1998, 6, 15), "18/6/98")
