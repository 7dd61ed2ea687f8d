import datetime as dt
import json
from decimal import Decimal as D

from harvestline.sources import readers, report_text, semistructured
from tests.conftest import rows

ZONAL_PAGE = "\n".join(
    [
        "APPENDIX 1: AVERAGE PRICES BY ZONE",
        "Item Label NORTH CENTRAL NORTH EAST NORTH WEST SOUTH EAST SOUTH SOUTH SOUTH WEST",
        "Beans Brown 2,580.80 2,434.87 1,836.71 2,999.59 2,690.45 2,382.22",
        "Rice local 1,000.00 1,100.00 1,200.00 1,300.00 1,400.00",  # only 5 numbers
        "12345 1,000.00 1,100.00 1,200.00 1,300.00 1,400.00 1,500.00",  # numeric-only name
        "short 1.00 2.00",
    ]
)
NATIONAL_PAGE = "\n".join(
    [
        "Selected food prices: MoM and YoY changes for Beans, Garri and Rice across the federation",
        "Item Label Previous Current MoM YoY",
        "Garri white 1,234.56 1,300.10 5.31 20.00 Lagos",
        "Salt iodised 12.00 45.00 30.00 40.00",  # nothing in [50, 50000]
        "Rice imported 10.00 60,000.00 70.00 2.00 9.99",  # 70.00 is the last in range of first 4
    ]
)


def _pages(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_classify_pages(spark):
    two_zones = "NORTH EAST NORTH WEST Item Label " + "x" * 100
    pages = _pages(spark, [ZONAL_PAGE, NATIONAL_PAGE, "tiny page", two_zones])
    got = rows(report_text.classify_pages(pages), "doc_id", "zone_headers", "is_zonal", "is_national")
    assert got == [(0, 6, True, False), (1, 0, False, True), (3, 2, False, False)]


def test_zonal_lines(spark):
    out = report_text.parse_zonal_lines(_pages(spark, [ZONAL_PAGE]))
    got = rows(out, "commodity_name", "zone", "price")
    assert len(got) == 6 and {g[0] for g in got} == {"Beans Brown"}
    assert ("Beans Brown", "North Central", 2580.80) in got and ("Beans Brown", "South West", 2382.22) in got


def test_national_lines(spark):
    out = report_text.parse_national_lines(_pages(spark, [NATIONAL_PAGE]))
    assert rows(out, "commodity_name", "zone", "price") == [
        ("Garri white", "National", 1300.10),
        ("Rice imported", "National", 70.0),
    ]
    both = report_text.extract_prices(_pages(spark, [ZONAL_PAGE, NATIONAL_PAGE]))
    assert both.count() == 8


def test_links_and_month_discovery(spark):
    html = (
        '<a href="/catalog/162/download/1150/FoodPrices_Dec24.pdf">x</a>'
        '<a href="/catalog/162/download/1300/SelectedFood_Mar25.pdf">y</a>'
        '<a href="/catalog/162/download/1301/other.pdf">no month</a>'
        '<a href="/catalog/162/download/1302/again_Mar25.pdf">dup</a>'
    )
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    links = report_text.extract_links(pages)
    assert links.count() == 4
    known = spark.createDataFrame([("2024-12",)], "month_key string")
    got = rows(report_text.discover_reports(links, known), "month_key", "resource_id")
    assert got == [("2025-03", "1300")]


def test_json_items_rate_map_snapshot_arrays(spark):
    page = json.dumps(
        {
            "items": [
                {"marketName": "Kano", "commodityName": "Rice", "currencyName": "NGN", "unitName": "KG",
                 "commodityPrice": "1,000", "commodityPriceDate": "2024-01-05T00:00:00"},
                {"marketName": "Kano", "commodityName": "Beans", "currencyName": "NGN", "unitName": "KG",
                 "commodityPrice": "850.5", "commodityPriceDate": "2024-01-05T00:00:00"},
            ],
            "totalPages": 3,
        }
    )
    docs = spark.createDataFrame([(page,)], "doc string")
    items = semistructured.explode_items(docs, "doc")
    assert items.count() == 2 and items.first().total_pages == 3
    obs = readers.api_observations(items)
    assert rows(obs, "commodity_name", "price") == [("Beans", D("850.50"))]  # '1,000' is not a number

    rates = spark.createDataFrame([('{"rates": {"2024-01-02": {"NGN": 1000.0}, "2024-01-03": {"EUR": 1.0}}}',)], "doc string")
    r = semistructured.explode_rate_map(rates, "doc").collect()
    assert len(r) == 1 and r[0].rate_date == dt.date(2024, 1, 2) and r[0].buying_rate == 990.0

    snap = semistructured.rate_snapshot(spark.createDataFrame([('{"rates": {"NGN": 1500.0}}',)], "doc string"), "doc", dt.date(2024, 2, 1))
    s = snap.first()
    assert s.rate_date == dt.date(2024, 2, 1) and s.selling_rate == 1515.0

    wx = json.dumps({"daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [31.5, 32.0],
                               "temperature_2m_min": [20.0, 21.0], "precipitation_sum": [0.0, 1.5]}})
    w = semistructured.explode_parallel_arrays(spark.createDataFrame([("Kano", wx)], "market_name string, doc string"), "doc", keep=["market_name"])
    got = rows(w, "market_name", "weather_date", "temperature_max", "precipitation_mm", "humidity_pct")
    assert got == [("Kano", dt.date(2024, 1, 1), 31.5, 0.0, None), ("Kano", dt.date(2024, 1, 2), 32.0, 1.5, None)]


def test_hdx_csv_tolerant_parse(spark, tmp_path):
    p = tmp_path / "hdx.csv"
    p.write_text(
        "date,admin1,admin2,market,latitude,longitude,category,commodity,unit,priceflag,pricetype,currency,price,usdprice\n"
        '2024-01-15,Kano,Kano,Kano,12.0,8.5,cereals,"Rice, local",KG,actual,Retail,NGN,800,0.5\n'
        "2024-01-15,Kano,Kano,Kano,12.0,8.5,cereals,Beans,KG,actual,Retail,NGN,abc,0.5\n"
        "2024-01-15,Kano,Kano,Kano,12.0,8.5,cereals,Maize,KG,actual,Retail,NGN,,0.5\n"
        "2023-12-01,Kano,Kano,Kano,12.0,8.5,cereals,Millet,KG,actual,Retail,NGN,500,0.5\n"
        "\n"
    )
    obs = readers.hdx_observations(spark, str(p), start=dt.date(2024, 1, 1))
    assert rows(obs, "commodity_name", "price", "state") == [("Rice, local", D("800.00"), "Kano")]


def test_malformed_dates_become_null(spark):
    from harvestline.operators import reshape

    df = spark.createDataFrame([("2024-01-05", "2024-01"), ("bad", "13/2024"), ("2024-01-05T10:00:00", None)], "a string, b string")
    out = reshape.parse_dates(reshape.parse_dates(df, ["a"]), ["b"], fmt="yyyy-MM")
    assert rows(out, "a", "b") == [
        (dt.date(2024, 1, 5), dt.date(2024, 1, 1)),
        (dt.date(2024, 1, 5), None),
        (None, None),
    ]
