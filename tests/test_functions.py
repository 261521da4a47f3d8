import datetime as dt

from pyspark.sql import functions as F

from starloom.functions import calendar_year_boundaries, date_key, join_names
from starloom.plans.calendar import calendar_dimension
from starloom.plans.dimensions import age_band


def test_calendar_matches_python_datetime(spark):
    start, end = dt.date(2022, 1, 1), dt.date(2024, 12, 31)
    rows = calendar_dimension(spark, start, end).orderBy("full_date").collect()
    assert len(rows) == 1096
    d = start
    for r in rows:
        q = (d.month - 1) // 3 + 1
        expected = (
            int(d.strftime("%Y%m%d")), d, d.isoweekday(), d.strftime("%A"), d.day,
            d.timetuple().tm_yday, int(d.strftime("%W")), d.month, d.strftime("%B"),
            d.strftime("%b"), q, f"Q{q}", d.year, 1 if d.isoweekday() >= 6 else 0, 0, d.year,
            q, d.month)
        assert tuple(r) == expected, (r, expected)
        d += dt.timedelta(days=1)


def test_week_zero_before_first_monday(spark):
    row = calendar_dimension(spark, dt.date(2022, 1, 1), dt.date(2022, 1, 3)).orderBy(
        "full_date").select("week_of_year").collect()
    assert [r[0] for r in row] == [0, 0, 1]


def test_year_boundaries_not_completed_years(spark):
    df = spark.createDataFrame([(dt.date(1990, 12, 31), dt.date(1991, 1, 1)),
                                (dt.date(1990, 7, 22), dt.date(2024, 1, 1))], "a date, b date")
    got = [r[0] for r in df.select(calendar_year_boundaries("a", "b")).collect()]
    assert got == [1, 34]


def test_age_band_edges_and_null(spark):
    as_of = dt.date(2024, 6, 30)
    births = [(None,)] + [(dt.date(2024 - age, 12, 31),) for age in
                          (10, 17, 24, 25, 34, 35, 44, 45, 54, 55, 80)]
    df = spark.createDataFrame(births, "dob date")
    got = [r[0] for r in df.select(age_band(F.col("dob"), as_of)).collect()]
    assert got == ["55+", "18-24", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44",
                   "45-54", "45-54", "55+", "55+"]


def test_date_key_and_null(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (None,)], "d date")
    assert [r[0] for r in df.select(date_key("d")).collect()] == [20240229, None]


def test_join_names_treats_null_as_empty(spark):
    df = spark.createDataFrame([("Ada", "Lane"), (None, "Ng"), ("Cy", None)], "f string, l string")
    assert [r[0] for r in df.select(join_names("f", "l")).collect()] == ["Ada Lane", " Ng", "Cy "]


def test_calendar_covering_whole_years_and_empty(spark):
    from starloom.plans.calendar import calendar_covering

    df = spark.createDataFrame([(dt.date(2023, 5, 2),), (dt.date(2024, 2, 29),), (None,)],
                               "d date")
    cal = calendar_covering(F.col("d"), source=df)
    assert cal.count() == 365 + 366
    empty = calendar_covering(F.col("d"), source=df.where("d IS NULL"))
    assert empty.count() == 0 and len(empty.columns) == 18
