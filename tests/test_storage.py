"""Landed files, stored layouts, whole replacements and checks in passing."""

import datetime as dt
import gzip
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from harvestline import schemas, sinks
from harvestline.operators import quality, reports
from harvestline.session import checkpoint_dir
from harvestline.sinks import versioned
from harvestline.sources import report_text, wide_files

SF = "/root/testdata/sf0.001"


@pytest.fixture
def folder(spark, tmp_path):
    return str(tmp_path)


# wide files


def write(path, text, opener=open):
    path.parent.mkdir(parents=True, exist_ok=True)
    with opener(path, "wt", encoding="utf-8") as f:
        f.write(text)


def test_wide_files_of_different_columns(spark, tmp_path):
    write(tmp_path / "a.csv", "﻿DATES,mkt_name,rice,c_rice,maize\n2020-01-01,Kano,10.5,0.8,n/a\n2020-01-02,\"Jos, N\",,0.9,7\n")
    write(tmp_path / "sub" / "b.csv", "maize,mkt_name,beans,DATES\n3,Kano,4,2020-01-03\n")
    write(tmp_path / "c.csv.gz", "beans,DATES,mkt_name,beans\n5,2020-01-04T00:00:00,Kano,99\n", gzip.open)
    write(tmp_path / "empty.csv", "")
    write(tmp_path / "other.csv", "DATES,mkt_name,price\n2020-01-01,Kano,1\n")
    write(tmp_path / "_hidden.csv", "DATES,mkt_name,rice\n2020-01-01,Kano,1\n")
    rows = wide_files.read_wide(spark, str(tmp_path))
    got = sorted((str(r.price_date), r.market_name, r.commodity_name, r.price, r.confidence_score) for r in rows.collect())
    assert got == [
        ("2020-01-01", "Kano", "Rice", 10.5, 0.8),
        ("2020-01-02", "Jos, N", "Maize", 7.0, None),
        ("2020-01-03", "Kano", "Beans", 4.0, None),
        ("2020-01-03", "Kano", "Maize", 3.0, None),
        ("2020-01-04", "Kano", "Beans", 5.0, None),
    ]
    late = wide_files.read_wide(spark, str(tmp_path), start=dt.date(2020, 1, 3), end=dt.date(2020, 1, 3))
    assert late.count() == 2 and {r.unit_name for r in late.collect()} == {"KG"}


def test_wide_files_without_prices(spark, tmp_path):
    write(tmp_path / "other.csv", "DATES,mkt_name,price\n2020-01-01,Kano,1\n")
    rows = wide_files.read_wide(spark, str(tmp_path))
    assert rows.count() == 0 and "confidence_score" in rows.columns


# report files


def test_report_files_give_months_and_pages(spark, tmp_path):
    page = "APPENDIX Item Label NORTH CENTRAL NORTH EAST NORTH WEST\n" + "Yam tuber, one kg 1.00 2.00 3.00 4.00 5.00 6.00 7.00\n"
    write(tmp_path / "2021-03" / "prices_2021-04.txt", "cover\f" + page * 2)
    write(tmp_path / "undated.txt", page * 2)
    write(tmp_path / "2021-13.txt", page * 2)
    pages = report_text.read_report_files(spark, str(tmp_path))
    assert {(str(r.report_month), r.page) for r in pages.collect()} == {("2021-04-01", 0), ("2021-04-01", 1)}
    rows = report_text.report_rows(pages)
    assert rows.count() == 12 and {r.state for r in rows.collect()} == set(report_text.ZONES)


# replaced tables


def test_a_reader_sees_the_old_table_until_the_pointer_is_there(spark, folder, monkeypatch):
    with pytest.raises(FileNotFoundError):
        versioned.read(spark, folder)
    versioned.replace(spark.range(3), folder)
    reader = versioned.read(spark, folder)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versioned, "commit", lost)
        with pytest.raises(OSError):
            versioned.replace(spark.range(10), folder)
    assert versioned.read(spark, folder).count() == 3
    versioned.replace(spark.range(5), folder)
    assert versioned.read(spark, folder).count() == 5
    assert reader.count() == 3  # one that began before still reads its files
    gone = versioned.vacuum(spark, folder, keep=1)
    assert len(gone) == 2 and versioned.read(spark, folder).count() == 5
    assert len(versioned.pointers(spark, folder)) == 1


def test_two_writers_cannot_take_one_number(spark, folder, monkeypatch):
    versioned.replace(spark.range(1), folder)
    before = versioned.pointers(spark, folder)
    versioned.replace(spark.range(2), folder)
    monkeypatch.setattr(versioned, "pointers", lambda *_: before)  # a writer that has not seen the other's
    with pytest.raises(Exception, match="(?i)exist"):
        versioned.commit(spark, folder, "mine")


# checks in passing

CHECKS = [
    quality.Check("rows", "row_count", lo=1),
    quality.Check("named", "not_null", "market_name"),
    quality.Check("price", "price_range", "price", lo=0, hi=100),
]


def test_observed_checks_equal_a_scan(spark, folder):
    rows = spark.createDataFrame([("a", 5.0), (None, 7.0), ("b", 120.0)], "market_name string, price double")
    report = sinks.append_checked(rows, {"source": "S"}, dt.datetime(2024, 1, 1), folder, "t", CHECKS)
    order = ["check_order", "check_name", "passed", "observed"]
    scan = quality.run_checks(spark.read.parquet(folder), "t", CHECKS)
    assert sorted(map(tuple, report.select(*order).collect())) == sorted(map(tuple, scan.select(*order).collect()))
    with pytest.raises(quality.QualityGateError):
        quality.gate(report)
    empty = sinks.append_checked(rows.where("price > 1000"), {"source": "S"}, dt.datetime(2024, 1, 1), folder + "/e", "t", CHECKS)
    assert [r.check_name for r in empty.collect()] == ["rows"]
    with pytest.raises(ValueError):
        quality.observed(rows, [quality.Check("u", "unique", "price")])


def test_a_checked_load_reads_its_source_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)
    source = f"{folder}/source"
    spark.range(1000).selectExpr("'m' market_name", "cast(id as double) price").coalesce(1).write.parquet(source)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.read.parquet(source).mapInArrow(count, "market_name string, price double")
    sinks.append_checked(df, {"source": "S"}, dt.datetime(2024, 1, 1), f"{folder}/raw", "t", CHECKS).collect()
    assert seen.value == 1000


# layouts


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_bucketed_series_need_no_exchange(spark):
    p = executed(entry.queries()["bucketed_features"](spark, SF))
    assert "Window" in p and "Bucketed: true" in p
    assert not re.search(r"Exchange hashpartitioning\(market_name#\d+, commodity_name#\d+", p)


@pytest.mark.parametrize("name", ["market_snapshot", "state_averages", "temporal_split_by_commodity"])
def test_newest_dates_do_not_deal_prices_by_commodity(spark, name):
    p = executed(entry.queries()[name](spark, SF))
    dealt = re.findall(r"Exchange hashpartitioning\(commodity_name#\d+, \d+\)[^\n]*\n[^\n]*", p)
    # counts per commodity may be dealt out; rows may not
    assert all("HashAggregate" in d for d in dealt), dealt


def test_variant_fields_of_missing_values(spark):
    df = spark.createDataFrame([(1, 2.5, None), (2, None, 7)], "k int, a double, b int")
    back = sinks.from_feature_variant(sinks.to_feature_variant(df, ["k"], ["a", "b"]), ["k"], {"a": "double", "b": "int", "c": "double"})
    assert sorted(map(tuple, back.collect())) == [(1, 2.5, None, None), (2, None, 7, None)]


def test_ranked_lists_keep_their_order(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1)], "k string, v int")
    assert sorted(map(tuple, reports.with_rank(df, ["k", "v"]).collect())) == [("a", 1, 1), ("a", 2, 2), ("b", 1, 3)]
    by = reports.with_rank(df, [F.desc("v")], ["k"])
    assert sorted(map(tuple, by.collect())) == [("a", 1, 2), ("a", 2, 1), ("b", 1, 1)]


def test_raw_schema_of_wide_loads(spark, tmp_path):
    write(tmp_path / "a.csv", "DATES,mkt_name,rice\n2020-01-01,Kano,10.5\n")
    long = wide_files.raw_columns(wide_files.read_wide(spark, str(tmp_path)))
    path = f"{checkpoint_dir(spark)}/raw-{dt.datetime.now().timestamp()}"
    sinks.append_raw(long, wide_files.RAW_CONSTANTS, dt.datetime(2024, 1, 1), path=path, schema=schemas.RAW_WORLDBANK)
    assert spark.read.parquet(path).schema.fieldNames() == schemas.RAW_WORLDBANK.fieldNames()
