"""Registered queries against their DuckDB SQL on the smallest tables (the driver's check, in small).

Set LAKELOAD_ORACLE_ALL=1 to run every registered query instead of the representative set.
"""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as E
from lakeload.sources.files import TABLES

REPRESENTATIVE = ["profile_full", "recommend_types", "profile_partials", "profile_merge", "profile_double",
                  "sample_plan", "scan_where", "scan_key_ranges", "scan_hash_buckets", "describe_columns",
                  "check_key", "key_candidates", "plan_types", "type_rules", "plan_types_inferred", "cast_decimal",
                  "cast_rejects", "part_truncate", "part_hour", "load_merge", "load_partitioned", "metadata_report"]
NAMES = sorted(E.oracle_sql()) if os.environ.get("LAKELOAD_ORACLE_ALL") else REPRESENTATIVE


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr([_norm(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())
