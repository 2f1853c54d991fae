"""Every named query against the independent SQL engine, on whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as driver
from veil.plans.oracles import ORACLES
from veil.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    yield con
    con.close()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("<NA>", "NaT"):
        return "NULL"
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return repr(float(v))
    return str(v)


def _table(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(driver.queries()) >= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, sf_dir, name):
    got = _table(driver.queries()[name](spark, sf_dir).toPandas())
    want = _table(sql.execute(driver.oracle_sql()[name]).df())
    assert got == want


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0
    assert df.columns == ["bp", "custid", "level", "pdl", "age", "gender", "iban", "street"]
