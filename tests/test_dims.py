import datetime as dt

from basketry.plans.dims import dim_dates


def test_dim_dates_2019(spark):
    d = dim_dates(spark)
    rows = {r.full_date: r for r in d.collect()}
    assert len(rows) == 364                                # end date exclusive
    last = rows[dt.date(2019, 12, 30)]
    assert (last.date_key, last.week_of_year, last.day_name, last.month_name) == (20191230, 1, "Monday", "December")
    first = rows[dt.date(2019, 1, 1)]
    assert (first.day_of_week_number, first.is_weekend, first.quarter_name, first.season,
            first.day_short_name, first.month_short_name) == (2, False, "Q1", "Winter", "Tue", "Jan")
    assert rows[dt.date(2019, 1, 5)].is_weekend and rows[dt.date(2019, 1, 6)].day_of_week_number == 0
    assert dim_dates(spark, inclusive_end=True).count() == 365
