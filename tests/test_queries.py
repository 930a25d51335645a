"""Each query against its SQL, on the driver's smaller tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from covey.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def oracle():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return db


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if pd.api.types.is_numeric_dtype(frame[c].dtype) and not pd.api.types.is_bool_dtype(frame[c].dtype):
            frame[c] = frame[c].astype(float)
        else:
            frame[c] = [None if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and np.isnan(x) else str(x) for x in frame[c]]
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    got, want = normal(QUERIES[name](spark, DATA).toPandas()), normal(oracle.execute(SQL[name]).df())
    assert list(got.columns) == list(want.columns)
    pd.testing.assert_frame_equal(got, want, check_exact=False, rtol=1e-9, atol=1e-9)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
