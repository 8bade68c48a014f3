"""Every query against its SQL in DuckDB on the smallest tables, and the shape of those without SQL."""

import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

from factloom.plans import catalogue

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(DIR):
        pytest.skip(f"no tables at {DIR}")
    con = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (float, Decimal)):
        return float(f"{float(value):.9g}")
    return value


def rows(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted([tuple(plain(r[i]) for i in order) for r in values], key=str)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DIR)
    want = duck.sql(catalogue.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_has_rows(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DIR)
    assert got.count() > 0


def test_flagship(spark, duck):
    assert catalogue.flagship(spark, DIR).count() > 0


def test_profile_sections_of_keys_of_any_length(spark, duck, tmp_path):
    duck.sql(f"COPY (SELECT * REPLACE (k AS s_suppkey) FROM supplier CROSS JOIN (VALUES (1), (999), (1000), (1001), (1003), (12345), (60100)) AS x(k) WHERE s_suppkey = 1) TO '{tmp_path}/supplier.parquet'")
    got = catalogue.QUERIES["profile_sections"](spark, str(tmp_path))
    want = duck.sql(catalogue.ORACLES["profile_sections"].replace("FROM supplier", f"FROM '{tmp_path}/supplier.parquet'"))
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())
