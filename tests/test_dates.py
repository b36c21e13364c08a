import datetime as dt

from pyspark.sql import functions as F

from markbook.functions.dates import beginning_of_year, previous_weekday
from markbook.functions.dates import beginning_of_year_of, previous_weekday_of


def test_previous_weekday_and_year_anchor_agree_with_driver_twin(spark):
    days = [dt.date(2023, 12, 1) + dt.timedelta(days=i) for i in range(430)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r["d"]: (r["y"], r["b"]) for r in
           df.select("d", previous_weekday("d").alias("y"), beginning_of_year("d").alias("b")).collect()}
    for d in days:
        assert got[d] == (previous_weekday_of(d), beginning_of_year_of(d)), d
    assert got[dt.date(2024, 1, 29)][0] == dt.date(2024, 1, 26)   # Monday -> Friday
    assert got[dt.date(2024, 1, 28)][0] == dt.date(2024, 1, 26)   # Sunday -> Friday
    assert got[dt.date(2024, 1, 27)][0] == dt.date(2024, 1, 26)   # Saturday -> Friday
    assert got[dt.date(2024, 1, 30)][0] == dt.date(2024, 1, 29)
