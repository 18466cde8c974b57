"""The clustered listing table: files are left out by day and by name, rows are not."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

from pricelens.fixture import view
from pricelens.sources import clustered as CT


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clustered"))
    rows = view(spark, SF_SMALL, "star_listings")
    assert CT.write_clustered(rows, root, files=24) == rows.count()
    return root, rows


def bag(df):
    return sorted(map(str, df.collect()))


def test_whole_table_is_read_back(spark, table):
    root, rows = table
    assert bag(CT.read_clustered(spark, root)) == bag(rows)
    assert len(CT.files_for(spark, root)) == 24


@pytest.mark.parametrize("first,last", [("1995-03-01", "1995-03-31"), (None, "1996-03-01"), ("2001-01-01", None)])
def test_days_leave_files_out(spark, table, first, last):
    root, rows = table
    day = F.to_date("scraped_at")
    want = rows.where((day >= F.lit(first or "1900-01-01").cast("date")) & (day <= F.lit(last or "2900-01-01").cast("date")))
    got = CT.read_clustered(spark, root, first, last)
    assert bag(got) == bag(want) and want.count() > 0
    files = CT.files_for(spark, root, first, last)
    assert 0 < len(files) < 12
    assert {os.path.basename(f) for f in files} >= {os.path.basename(r[0]) for r in got.select(F.input_file_name()).distinct().collect()}


def test_a_name_leaves_files_of_one_day_out(spark, tmp_path):
    rows = [(i, f"item {i % 40:02d}", dt.datetime(2024, 1, 1 + i % 2)) for i in range(4000)] + [(9000, "item 00", None)]
    df = spark.createDataFrame(rows, "id long, product_name string, scraped_at timestamp_ntz")
    CT.write_clustered(df, str(tmp_path), files=16)
    day = len(CT.files_for(spark, str(tmp_path), "2024-01-02", "2024-01-02"))
    files = CT.files_for(spark, str(tmp_path), "2024-01-02", "2024-01-02", "item 07")
    assert 1 <= len(files) <= 2 < day <= 9
    assert CT.read_clustered(spark, str(tmp_path), "2024-01-02", "2024-01-02", "item 07").count() == 100
    assert CT.read_clustered(spark, str(tmp_path), name="item 00").count() == 101  # rows without a time are found by name
    assert CT.read_clustered(spark, str(tmp_path), "2031-01-01").count() == 0


def test_a_hot_product_is_cut_over_files(spark, tmp_path):
    rows = [(i, "hot" if i % 3 == 0 else f"item {i}", dt.datetime(2024, 1, 1)) for i in range(3000)]
    CT.write_clustered(spark.createDataFrame(rows, "id long, product_name string, scraped_at timestamp_ntz"), str(tmp_path), files=12)
    assert len(CT.files_for(spark, str(tmp_path), name="hot")) >= 4
    assert CT.read_clustered(spark, str(tmp_path), name="hot").count() == 1000
