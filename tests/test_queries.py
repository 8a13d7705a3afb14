"""Every query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from lociframe.registry import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events"


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def canonical(df):
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, small, name):
    found = canonical(QUERIES[name](spark, small).toPandas())
    if name not in SQL:
        assert len(found.columns)
        return
    wanted = canonical(duck.sql(SQL[name]).df())
    assert list(found.columns) == list(wanted.columns)
    assert len(found) == len(wanted)
    for c in found:
        assert found[c].dtype == wanted[c].dtype or not len(found), c
        if found[c].dtype.kind == "f":
            assert np.allclose(found[c].astype(float), wanted[c].astype(float), atol=2e-6, equal_nan=True), c
        else:
            assert ((found[c] == wanted[c]) | (found[c].isna() & wanted[c].isna())).all(), c


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_site_order_rounds_halves_to_even(spark, duck, tmp_path):
    """Prices of a half decide the order: 2.5 stands with 2, as in SQL."""
    duck.sql(f"COPY (SELECT i AS p_partkey, 'x' AS p_name, 'b' AS p_brand, 't' AS p_type, 7::INTEGER AS p_size, (i * 37 % 40) / 2.0::DOUBLE AS p_retailprice FROM range(80) r(i)) TO '{tmp_path}/part.parquet'")
    own = duckdb.connect()
    own.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    assert sorted(map(tuple, QUERIES["site_order"](spark, str(tmp_path)).collect())) == sorted(own.sql(SQL["site_order"]).fetchall())


def test_site_order_places_every_site(spark, duck, small, tmp_path):
    """Sites of all chromosomes have a place; rows without size, price or key come last, as in SQL."""
    rows = QUERIES["site_order"](spark, small).collect()
    assert sorted(r["k"] for r in rows) == sorted(k for (k,) in duck.sql("SELECT p_partkey FROM part").fetchall())
    assert sorted(r["place"] for r in rows) == list(range(1, len(rows) + 1))
    own = duckdb.connect()
    own.sql(f"COPY (SELECT nullif(i, 31) AS p_partkey, CASE WHEN i % 9 > 0 THEN i % 13 END::INTEGER AS p_size, CASE WHEN i % 7 > 0 THEN (i * 37 % 40) / 2.0::DOUBLE END AS p_retailprice FROM range(120) r(i)) TO '{tmp_path}/part.parquet'")
    own.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    got = [tuple(r) for r in QUERIES["site_order"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(own.sql(SQL["site_order"]).fetchall(), key=repr) and len(got) == 120
