import datetime as dt

from urbanlake.functions import calendar as cal

D = dt.date


def test_week_start_sunday_and_iso_monday(spark):
    # Sunday stays, Monday goes back to Sunday, Saturday back six days
    df = spark.createDataFrame([(D(2024, 12, 29),), (D(2024, 1, 1),), (D(2022, 1, 1),)], "d date")
    got = df.select(cal.week_start("d").alias("ws"), cal.week_start_iso("d").alias("iso")).collect()
    assert [r.ws for r in got] == [D(2024, 12, 29), D(2023, 12, 31), D(2021, 12, 26)]
    assert [r.iso for r in got] == [D(2024, 12, 30), D(2024, 1, 1), D(2021, 12, 27)]


def test_week_label_not_injective(spark):
    # S3: Mondays 1 Jan and 30 Dec 2024 both give 1-2024; 27 Dec 2021 gives 52-2021
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 12, 30),), (D(2021, 12, 27),)], "m date")
    assert [r[0] for r in df.select(cal.week_label("m")).collect()] == ["1-2024", "1-2024", "52-2021"]


def test_sunday_belongs_to_following_week(spark):
    df = spark.createDataFrame([(D(2024, 1, 7),), (D(2024, 1, 8),)], "d date")  # Sunday, Monday
    labels = [r[0] for r in df.select(cal.week_label(cal.week_start_iso("d"))).collect()]
    assert labels == ["2-2024", "2-2024"]


def test_month_label_unpadded(spark):
    # S4
    df = spark.createDataFrame([(D(2024, 5, 7),)], "d date")
    assert df.select(cal.month_label("d")).first()[0] == "5-2024"


def test_null_label_stays_null(spark):
    # S10: 'WEEK-' || NULL is NULL
    df = spark.createDataFrame([(None,), ("3-2020",)], "l string")
    assert [r[0] for r in df.select(cal.prefix_label("l")).collect()] == [None, "WEEK-3-2020"]


def test_label_parts(spark):
    df = spark.createDataFrame([("12-2020",), (None,)], "l string")
    got = df.select(cal.label_part("l", 1), cal.label_part("l", 2)).collect()
    assert [tuple(r) for r in got] == [(12, 2020), (None, None)]


def test_calendar_matches_python_on_random_dates(spark):
    import random

    rnd = random.Random(31)
    start = D(1990, 1, 1)
    days = [start + dt.timedelta(days=rnd.randrange(365 * 45)) for _ in range(3000)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d",
        cal.week_start("d").alias("ws"),
        cal.week_label(cal.week_start_iso("d")).alias("wl"),
        cal.month_label("d").alias("ml"),
    )
    for r in df.collect():
        sunday = r.d - dt.timedelta(days=(r.d.weekday() + 1) % 7)  # weekday(): Monday = 0
        monday = sunday + dt.timedelta(days=1)
        assert r.ws == sunday
        assert r.wl == f"{monday.isocalendar()[1]}-{monday.year}"
        assert r.ml == f"{r.d.month}-{r.d.year}"
