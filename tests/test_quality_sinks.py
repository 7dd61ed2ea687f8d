import datetime as dt
import time
from decimal import Decimal as D

import pytest

from pyspark.sql import functions as F

from harvestline import schemas, sinks
from harvestline.operators import quality
from harvestline.streaming import ingest
from tests.conftest import rows

C = quality.Check


def _prices(spark, vals):
    return spark.createDataFrame([(v,) for v in vals], "price double")


def test_between_mostly_exact_boundary_and_nulls(spark):
    vals = [10.0] * 19 + [99.0] + [None] * 5  # 19/20 = 95 % in range, nulls ignored
    res = quality.run_checks(_prices(spark, vals), "t", [C("b", "between", "price", lo=0, hi=50, mostly=0.95)])
    (r,) = res.collect()
    assert r.passed and r.observed == 0.95
    res = quality.run_checks(_prices(spark, vals), "t", [C("b", "between", "price", lo=0, hi=50, mostly=0.96)])
    assert not res.first().passed


def test_empty_table_short_circuit_and_freshness(spark):
    empty = spark.createDataFrame([], "price double, price_date date")
    checks = [
        C("row_count", "row_count", lo=1),
        C("not_null_price", "not_null", "price"),
        C("freshness", "freshness", "price_date", hi=90),
    ]
    got = rows(quality.run_checks(empty, "t", checks, dt.date(2024, 1, 1)), "check_name", "passed")
    assert got == [("row_count", False)]
    one = spark.createDataFrame([(None, None)], "price double, price_date date")
    f = quality.run_checks(one, "t", checks, dt.date(2024, 1, 1)).where("check_name = 'freshness'").first()
    assert f.observed == 999.0 and not f.passed


def test_range_unique_in_set_schema_and_gate(spark):
    df = spark.createDataFrame([(1, "WorldBank", 10.0), (1, "WFP", 60000.0)], "id int, source string, price double")
    checks = [
        C("price_range", "price_range", "price", lo=0, hi=50000),
        C("unique_id", "unique", "id"),
        C("source_in_set", "in_set", "source", values=("WorldBank",)),
    ]
    res = quality.run_checks(df, "t", checks)
    assert [r.passed for r in res.orderBy("check_order").collect()] == [False, False, False]
    s = quality.report_summary(res).first()
    assert (s.passed, s.failed) == (0, 3)
    with pytest.raises(quality.QualityGateError):
        quality.gate(res)
    sc = quality.check_schema(spark, df, "t", ["id", "missing"], numeric=["price", "source"])
    assert rows(sc, "check_name", "passed") == [
        ("column_exists_id", True), ("column_exists_missing", False), ("numeric_price", True), ("numeric_source", False)
    ]
    log = quality.to_log_row(res, "suite", dt.datetime(2024, 1, 1)).first()
    assert log.success is False and '"unsuccessful_expectations":3' in log.statistics


def test_append_overwrite_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("Kano", "Rice", D("10.00"))], "market_name string, commodity_name string, price decimal(12,2)")
    path = str(tmp_path / "raw")
    ts = dt.datetime(2024, 1, 1, 12)
    sinks.append_raw(df, {"source": "WFP", "country_name": "Nigeria"}, ts, path=path)
    sinks.append_raw(df, {"source": "WFP", "country_name": "Nigeria"}, ts + dt.timedelta(days=1), path=path)
    back = spark.read.parquet(path)
    assert back.count() == 2 and {r.ingested_at for r in back.collect()} == {ts, ts + dt.timedelta(days=1)}
    out = str(tmp_path / "feat")
    sinks.write_features(back.withColumnRenamed("price", "price_ngn"), out)
    assert (tmp_path / "feat" / "commodity_name=Rice").exists()
    doc = sinks.to_feature_document(back, ["market_name"], ["price", "source"]).first()
    assert doc.features == '{"price":10.00,"source":"WFP"}'
    sinks.backup_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1


def test_incremental_ingest_loads_each_file_once(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    header = "date,admin1,admin2,market,latitude,longitude,category,commodity,unit,priceflag,pricetype,currency,price,usdprice\n"
    (src / "a.csv").write_text(header + "2024-01-15,Kano,Kano,Kano,1,1,c,Rice,KG,a,R,NGN,800,0.5\n")
    target, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    ts = dt.datetime(2024, 3, 1)
    q = ingest.ingest_files(spark, str(src), schemas.HDX_CSV, target, ckpt, {"source": "WFP"}, "wfp-1", ts)
    q.awaitTermination(120)
    assert spark.read.parquet(target).count() == 1
    (src / "b.csv").write_text(header + "2024-02-15,Kano,Kano,Kano,1,1,c,Beans,KG,a,R,NGN,900,0.6\n")
    q = ingest.ingest_files(spark, str(src), schemas.HDX_CSV, target, ckpt, {"source": "WFP"}, "wfp-1", ts)
    q.awaitTermination(120)
    back = spark.read.parquet(target)
    assert back.count() == 2 and back.select("load_id").distinct().count() == 2
    assert {r.ingested_at for r in back.select("ingested_at").collect()} == {ts}
    # a second stream, whose batch ids start at 0 again, keeps the first one's loads
    q = ingest.ingest_files(spark, str(src), schemas.HDX_CSV, target, ckpt + "2", {"source": "WFP"}, "wfp-2", ts)
    q.awaitTermination(120)
    assert spark.read.parquet(target).count() == 4


def test_build_all_writes_every_table(spark, tmp_path):
    from harvestline.plans import build
    from harvestline.plans import marts as pm
    from harvestline.sources.testdata import AS_OF

    feeds = pm.testdata_feeds(spark, "/root/testdata/sf0.001")
    feeds.wfp = feeds.wfp.unionByName(feeds.wfp)  # a reload: staging must absorb it
    # proxy prices exceed the World Bank / NBS bounds: the gate stops the run
    with pytest.raises(quality.QualityGateError):
        build.build_all(spark, feeds, str(tmp_path / "stop"), AS_OF, dt.datetime(2024, 1, 1))
    assert not (tmp_path / "stop" / "unified").exists()
    log = spark.read.parquet(str(tmp_path / "stop" / "data_quality_log")).first()
    assert log.success is False and log.suite_name == "post_ingestion_validation"
    assert log.results_summary.startswith("SQL: 15 passed, 2 failed | GX: ")
    assert '"sql_failed":2' in log.statistics
    paths = build.build_all(spark, feeds, str(tmp_path / "w"), AS_OF, dt.datetime(2024, 1, 1), enforce=False)
    daily = spark.read.parquet(paths["fct_daily_prices"])
    assert daily.count() == pm.daily(pm.testdata_feeds(spark, "/root/testdata/sf0.001")).count()
    assert spark.read.parquet(paths["features"]).count() > 0


def test_daily_sources_array(spark):
    from harvestline.operators import marts

    u = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "K", "Rice", "KG", "C", D("1.00"), s) for s in ("WFP", "NBS", "WFP")],
        "price_date date, market_name string, commodity_name string, unit_name string, category string, price_ngn decimal(12,2), source string",
    )
    assert marts.daily_fact(u, with_sources=True).first().sources == ["NBS", "WFP"]


def test_seed_read_select_locations_predictions_materialize(spark, tmp_path):
    from harvestline.sources import readers, semistructured

    seed = tmp_path / "mapping.csv"
    seed.write_text('raw_name,clean_name,category,unit\n"Rice, local",Rice (local),Cereals,KG\n\n"Yam ""big""",Yam tuber,Tubers,KG\n')
    m = readers.read_seed(spark, str(seed), schemas.SEED_MAPPING, "raw_name")
    assert rows(m, "raw_name") == [("Rice, local",), ('Yam "big"',)]
    picked = readers.select_where(m, ["raw_name", "unit"], F.col("category") == "Tubers", order=["raw_name"])
    assert picked.columns == ["raw_name", "unit"] and picked.count() == 1

    locs = readers.literal_locations(spark, [("Kano", 12.0, 8.5)])
    obs = spark.createDataFrame([("Kano", 1.0), ("Lagos", 2.0)], "market_name string, v double")
    got = rows(semistructured.stamp_locations(obs, locs), "market_name", "latitude")
    assert got == [("Kano", 12.0), ("Lagos", None)]

    fc = spark.createDataFrame(
        [("Rice", "Kano", dt.date(2024, 1, 8), 7, 101.234, 90.0, 110.0, "7d", "NGN/kg", "ok"),
         ("Rice", "Zaria", None, 7, None, None, None, None, "NGN/kg", "no_data")],
        "commodity string, market string, forecast_date date, forecast_horizon_days int, predicted_price_ngn double, "
        "lower_bound_ngn double, upper_bound_ngn double, model_version string, unit string, status string",
    )
    pred = sinks.predictions_table(fc, dt.datetime(2024, 1, 1))
    assert [f.name for f in pred.schema.fields] == [f.name for f in schemas.PREDICTIONS.fields]
    assert pred.count() == 1 and pred.first().predicted_price == D("101.23")

    view = sinks.materialize(obs, "obs_view", as_table=False, spark=spark)
    assert view.count() == 2
    table = sinks.materialize(obs, "obs_table", as_table=True, spark=spark, path=str(tmp_path / "t"))
    assert table.count() == 2


def test_json_suite_schema_checks_on_raw_feeds(spark):
    from harvestline.plans import marts as pm

    f = pm.testdata_feeds(spark, "/root/testdata/sf0.001")
    tables = {"wfp_prices": f.wfp, "worldbank_prices": f.worldbank, "nbs_prices": f.nbs}
    for name, (cols, numeric) in quality.JSON_SCHEMA_CHECKS.items():
        res = quality.check_schema(spark, tables[name], name, cols, numeric)
        assert all(r.passed for r in res.collect()), name
