from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cutline.functions.calendar import Offset, cutoff_schedule, last_cutoff

MONTH, NONE = Offset(1), Offset(0, "days")


@pytest.mark.parametrize("newest,day,given,mode,expected", [
    ("2001-08-01", 1, None, "train", "2001-07-01"),
    ("2001-08-01", 15, None, "train", "2001-06-15"),
    ("2001-08-01", 1, "2001-05-20", "train", "2001-05-01"),
    ("2001-08-01", 1, "2001-07-20", "train", "2001-07-01"),
    ("2001-08-01", 1, "2001-05-20", "retrain", "2001-07-01"),
    ("2001-08-01", 1, None, "predict", "2001-08-01"),
    ("2001-08-01", 1, "2002-01-01", "predict", "2001-08-01"),
    ("2001-03-28", 31, None, "train", "2001-01-31"),
    ("2001-08-01 17:30:00", 1, None, "train", "2001-07-01"),
])
def test_last_cutoff(newest, day, given, mode, expected):
    got = last_cutoff(datetime.fromisoformat(newest), NONE, MONTH, day, given, mode)
    assert got == datetime.fromisoformat(expected)


def test_time_of_day_is_kept_on_request():
    got = last_cutoff(datetime(2001, 8, 1, 17, 30), NONE, MONTH, 1, truncate=False)
    assert got == datetime(2001, 7, 1, 17, 30)


def test_schedule_clamps_step_by_step():
    got = cutoff_schedule(datetime(2024, 3, 31), 3)
    assert got == [datetime(2024, 3, 31), datetime(2024, 2, 29), datetime(2024, 1, 29)]
    assert cutoff_schedule(datetime(2024, 3, 31), None) == [datetime(2024, 3, 31)]


def test_month_steps_clamp_like_spark(spark):
    start = datetime(2007, 3, 30, 10, 15)
    df = spark.createDataFrame([(start,)], "t timestamp_ntz")
    for offset in (Offset(1), Offset(13), Offset(1, "years"), Offset(2, "weeks"), Offset(5, "hours")):
        row = df.select((F.col("t") + offset.interval()).alias("a"), (F.col("t") - offset.interval()).alias("b")).first()
        assert (row.a, row.b) == (offset.after(start), offset.before(start))


def test_unknown_unit_and_mode():
    with pytest.raises(ValueError):
        Offset(1, "fortnights")
    with pytest.raises(ValueError):
        last_cutoff(datetime(2001, 1, 1), NONE, MONTH, mode="replay")
