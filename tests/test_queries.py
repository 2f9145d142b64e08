"""Registered queries against DuckDB at sf0.001, the fixture run, and the driver entry."""

import math

import duckdb
import pytest

from prepspark.catalog import oracles, queries
from prepspark.sources.tables import TABLES, table_path

SF = "/root/testdata/sf0.001"

FAST = ["profile_missing", "semantic_types", "analyze_columns", "issues_summary", "impute_mode", "cap_iqr",
        "encode_label", "scale_robust", "bin_equal_freq", "mutual_info", "knn_impute", "table_digest", "audit_chain",
        "quality_score", "read_csv_infer", "stream_scale_events", "scale_columns",
        "fs_low_variance"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    res = duck.execute(oracles()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


def test_every_query_has_callable_and_known_oracles():
    qs, os_ = queries(), oracles()
    assert set(os_) <= set(qs)
    assert len(qs) >= 90


def test_reference_fixture_basic_run(spark):
    from prepspark.plans.prep import run_basic_prep

    df = spark.createDataFrame([(1, 20.0, "India", 1), (2, None, "IND", 0), (2, None, "IND", 0), (3, 42.0, "Inida", 1)],
                               "id long, age double, country string, target long")
    res = run_basic_prep(df, "target", "classification", key="id")
    out = res.frame.collect()
    assert len(out) == 3  # one exact duplicate removed
    assert "target" in res.frame.columns and "is_test" in res.frame.columns
    assert res.reports["digest"]["rows"] == 3


def test_entry_smoke(spark):
    import importlib.util
    import os

    path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0
