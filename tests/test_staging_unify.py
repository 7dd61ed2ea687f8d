import datetime as dt
from decimal import Decimal as D

from harvestline import schemas
from harvestline.operators import staging, unify
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1, 6)


def wfp(spark, data):
    return spark.createDataFrame(data, schemas.RAW_WFP)


def test_latest_per_key_keeps_newest_and_breaks_ties_deterministically(spark):
    d = dt.date(2024, 3, 1)
    raw = wfp(
        spark,
        [
            ("NG", "Kano", "Rice", "NGN", "KG", D("10.00"), d, "WFP", T0),
            ("NG", "Kano", "Rice", "NGN", "KG", D("12.00"), d, "WFP", T0 + dt.timedelta(days=1)),  # reload
            ("NG", "Abuja", "Rice", "NGN", "KG", D("5.00"), d, "WFP", T0),  # same stamp, two rows
            ("NG", "Abuja", "Rice", "NGN", "KG", D("7.00"), d, "WFP", T0),
            ("NG", "Abuja", "Rice", "NGN", "KG", D("0.00"), d, "WFP", T0 + dt.timedelta(days=9)),  # price 0
            ("NG", None, "Rice", "NGN", "KG", D("3.00"), d, "WFP", T0),
        ],
    )
    got = rows(staging.stage_wfp(raw), "market_name", "price_ngn")
    # price > 0 filter runs before the dedupe; ties go to the greater row
    assert got == [("Abuja", D("7.00")), ("Kano", D("12.00"))]


def test_nbs_staging_renames(spark):
    raw = spark.createDataFrame(
        [("Beans", "KG", D("900.00"), dt.date(2024, 11, 1), "National", "NBS", T0)], schemas.RAW_NBS
    )
    out = staging.stage_nbs(raw)
    assert out.columns == ["market_name", "commodity_name", "unit_name", "price_ngn", "price_date", "source"]
    assert rows(out, "market_name", "price_date") == [("National", dt.date(2024, 11, 1))]


def test_fx_dedupe_one_row_per_date(spark):
    raw = spark.createDataFrame(
        [
            (dt.date(2024, 1, 2), "USD", D("1.0"), D("900.0"), D("2.0"), "CBN", T0),
            (dt.date(2024, 1, 2), "USD", D("1.0"), D("950.0"), D("2.0"), "CBN", T0 + dt.timedelta(hours=1)),
            (dt.date(2024, 1, 3), "USD", D("1.0"), D("0.0"), D("2.0"), "CBN", T0),
        ],
        schemas.RAW_FX,
    )
    assert rows(staging.stage_fx(raw), "rate_date", "central_rate") == [(dt.date(2024, 1, 2), D("950.0000"))]


def _obs(spark, data):
    return spark.createDataFrame(
        data, "price_date date, market_name string, commodity_name string, unit_name string, price_ngn decimal(12,2), source string"
    )


def test_noise_filters_and_mapping(spark):
    d = dt.date(2024, 1, 1)
    obs = _obs(
        spark,
        [
            (d, "Kano", "Yam", "KG", D("10"), "WFP"),  # mapped -> 'Yam tuber'
            (d, "Kano", "Mackerel : frozen", "KG", D("10"), "WFP"),  # duplicated raw name in mapping
            (d, "Kano", "Tea", "KG", D("10"), "WFP"),  # length 3 -> dropped
            (d, "Kano", "Teas", "KG", D("10"), "WFP"),  # length 4 -> kept, unmapped
            (d, "Kano", "SoLd LoOsE", "KG", D("10"), "WFP"),  # junk, any case
            (d, None, "Teas", "KG", D("10"), "WFP"),  # NULL market dropped
            (d, "National", "Teas", "KG", D("10"), "NBS"),  # aggregate label
            (d, "Kano", "Teas", "KG", D("0"), "WFP"),  # price 0
            (d, "Kano", "Teas", "KG", D("-1"), "WFP"),  # negative
            (d, "Kano", "mackerel : frozen", "KG", D("10"), "WFP"),  # case differs: unmapped
        ],
    )
    mapping = spark.createDataFrame(
        [
            ("Yam", "Yam tuber", "Tubers", "KG"),
            ("Mackerel : frozen", "Mackerel", "Fish", "KG"),
            ("Mackerel : frozen", "Mackerel (frozen)", "Fish", "KG"),
        ],
        schemas.SEED_MAPPING,
    )
    out = unify.drop_noise(unify.harmonise(obs, mapping))
    got = rows(out, "commodity_name", "category")
    assert got == [("Mackerel", "Fish"), ("Teas", "Other"), ("Yam tuber", "Tubers"), ("mackerel : frozen", "Other")]


def test_iqr_fence_inclusive_bounds_and_single_row(spark):
    d = dt.date(2024, 1, 1)
    # values 1..5 cents-wise: q1 = 2, q3 = 4, IQR 2, k=1 -> fence [0, 6]
    data = [(d, "M", "A", "KG", D(v), "WFP") for v in ("2", "3", "4", "5", "6", "0.01")]
    data += [(d, "M", "B", "KG", D("99.99"), "WFP")]  # single row: IQR 0, kept
    obs = _obs(spark, data)
    b = rows(unify.iqr_bounds(obs, "commodity_name", "price_ngn", 1.0), "commodity_name", "q1", "q3")
    assert b[0][0] == "A" and b[1] == ("B", 99.99, 99.99)
    kept = rows(unify.iqr_fence(obs, "commodity_name", "price_ngn", k=1.0), "commodity_name", "price_ngn")
    q1, q3 = b[0][1], b[0][2]
    lo, hi = q1 - (q3 - q1), q3 + (q3 - q1)
    expect = sorted(
        [("A", D(v)) for v in ("2", "3", "4", "5", "6", "0.01") if lo <= float(v) <= hi] + [("B", D("99.99"))]
    )
    assert kept == expect
