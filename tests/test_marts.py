import datetime as dt
from decimal import Decimal as D

from harvestline.operators import marts
from tests.conftest import rows


def _unified(spark, data):
    return spark.createDataFrame(
        data,
        "price_date date, market_name string, commodity_name string, unit_name string, category string, price_ngn decimal(12,2), source string",
    )


def test_daily_half_up_and_source_count(spark):
    d = dt.date(2024, 1, 1)
    u = _unified(
        spark,
        [
            (d, "Kano", "Rice", "KG", "Cereals", D("1.00"), "WFP"),
            (d, "Kano", "Rice", "KG", "Cereals", D("1.01"), "WorldBank"),  # avg 1.005 -> 1.01
            (d, "Kano", "Rice", "BAG", "Cereals", D("1.00"), "WFP"),  # second WFP row counts too
            (d, "Kano", "Rice", "KG", "Cereals", D("1.01"), "WFP"),
        ],
    )
    out = marts.daily_fact(u)
    (r,) = out.collect()
    assert r.price_ngn == D("1.01") and r.source_count == 4 and r.unit_name == "KG"
    assert r.price_min_ngn == D("1.00") and r.price_max_ngn == D("1.01")
    assert len(r.price_id) == 32


def test_week_starts_on_monday_across_year_end(spark):
    u = _unified(
        spark,
        [
            (dt.date(2024, 12, 29), "Kano", "Rice", "KG", "C", D("1.00"), "WFP"),  # Sunday
            (dt.date(2024, 12, 30), "Kano", "Rice", "KG", "C", D("3.00"), "WFP"),  # Monday, ISO week 1 of 2025
            (dt.date(2025, 1, 1), "Kano", "Rice", "KG", "C", D("4.00"), "WFP"),
        ],
    )
    w = marts.weekly_fact(marts.daily_fact(u))
    got = rows(w, "week_start", "avg_price_ngn", "observation_count")
    assert got == [(dt.date(2024, 12, 23), D("1.00"), 1), (dt.date(2024, 12, 30), D("3.50"), 2)]
    m = marts.monthly_fact(marts.daily_fact(u))
    assert rows(m, "month_start", "price_range_ngn") == [
        (dt.date(2024, 12, 1), D("2.00")),
        (dt.date(2025, 1, 1), D("0.00")),
    ]


def test_dims_left_join_and_flags(spark):
    d = dt.date(2024, 1, 1)
    u = _unified(
        spark,
        [(d, "Kano", "rice (LOCAL)", "KG", "C", D("1"), "WFP"), (d, "Nowhere", "Chicken", "KG", "C", D("1"), "WFP")],
    )
    mseed = spark.createDataFrame(
        [(1, "Kano", "Kano", "North-West", 12.0, 8.5)],
        "market_id int, market_name string, state string, geopolitical_zone string, latitude double, longitude double",
    )
    cseed = spark.createDataFrame(
        [(1, "Rice (local)", "Cereals", "KG", True)],
        "commodity_id int, commodity_name string, category string, standard_unit string, is_staple boolean",
    )
    assert rows(marts.dim_markets(u, mseed), "market_name", "has_coordinates") == [("Kano", True), ("Nowhere", False)]
    assert rows(marts.dim_commodities(u, cseed), "commodity_name", "is_staple", "in_seed_list") == [
        ("Chicken", False, False),
        ("rice (LOCAL)", True, True),
    ]
