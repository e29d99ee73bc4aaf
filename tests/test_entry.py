"""The registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Neighbourhoods need the 100 suppliers of larger tables.
NEED_PLOT = {"tpi5", "laplacian", "neigh_mean", "regrid_weights_apply", "dist_to_urban"}
# One of each family; the driver runs them all.
CHOSEN = ["region_regime_summary", "daily_weather", "argmax_companion", "trail_sum_90", "dry_run_length", "zscore_causal", "drought_index", "horizon_3", "bracket_interp", "asof_edition", "warm_start", "idw_k", "nearest_event", "exposure", "polygon_cells", "refine", "block_pool", "mode_pool", "auc_rank", "regime_metrics", "matched_negatives", "set_overlap", "range_coalesce", "latest_vintage", "laea", "edge_equals_batch", "stream_dedupe", "rollup_density", "holiday_flags", "search_sorted"]


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def rows(found):
    return sorted(tuple(repr(v) if v is not None else "~" for v in row) for row in found)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_its_sql(spark, small, duck, name):
    df = entry.queries()[name](spark, small)
    columns = sorted(df.columns)
    mine = rows(tuple(r) for r in df.select(*columns).collect())
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    order = [rel.columns.index(c) for c in columns]
    assert mine == rows(tuple(r[i] for i in order) for r in rel.fetchall())


def test_every_oracle_has_a_query_and_binds(duck):
    queries = entry.queries()
    for name, sql in entry.oracle_sql().items():
        assert name in queries
        duck.sql(f"EXPLAIN {sql}")


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
