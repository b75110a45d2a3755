"""Layer 2: every registered query against its DuckDB oracle on the sf0.001 tables."""
import hashlib

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tickscan.plans import registry as R
from tickscan.sources.tables import TABLES

# The core's own queries; those of the training-data operators are tested in tests/llm.
BATCH_KEYS = [k for k in R.all_queries() if not k.startswith("stream_")]
STREAM_KEYS = [k for k in R.all_queries() if k.startswith("stream_")]


def norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            df[c] = s.astype("datetime64[us]").astype("int64").astype(str)
        elif pd.api.types.is_float_dtype(s):
            df[c] = s.map(lambda v: "None" if pd.isna(v) else repr(round(float(v), 9)))
        else:
            df[c] = s.map(lambda v: "None" if v is None or (isinstance(v, float) and pd.isna(v)) else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def digest(df):
    return hashlib.sha1(pd.util.hash_pandas_object(norm(df), index=False).values.tobytes()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def check(spark, duck, key):
    got = R.all_queries()[key](spark, SF_SMALL).toPandas()
    want = duck.execute(R.all_oracles()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)


def test_every_query_has_oracle():
    assert set(R.all_queries()) == set(R.all_oracles())
    assert set(R.all_queries()) <= set(E.queries()) and set(R.all_oracles()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_batch_query(spark, duck, key):
    check(spark, duck, key)


@pytest.mark.parametrize("key", STREAM_KEYS)
def test_stream_query(spark, duck, key):
    check(spark, duck, key)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["symbol", "window_start", "trade_timestamp", "message"]
    assert df.count() > 0
