"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from lakeloom import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    return ("float", round(v, 5) + 0.0) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in catalog.ORACLES:
        assert got
        return
    result = duck.sql(catalog.ORACLES[name])
    names = list(result.columns)
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert got == want


def test_entry_has_all_queries(spark):
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1


def test_keyed_objects_hold_many_keys_a_file(spark, sf_dir):
    """A file a hundred keys is a file to create, rename, list and open: their number, not their bytes, took the time."""
    got = catalog.QUERIES["keyed_json_bootstrap"](spark, sf_dir)
    keys = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    assert got.count() == got.select("key").distinct().count() == keys
    assert len(got.inputFiles()) <= 3 + keys // 10_000


@pytest.mark.parametrize("name", ["lineup_resolution", "weighted_plus_minus", "team_match_result", "gold_chain", "matchup_matrix"])
def test_player_rows_are_dealt_by_fixture_once(name, spark, sf_dir):
    """No shuffle by fixture and team, whose share of a task would grow with the tables under a fixed number of partitions."""
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert "hashpartitioning(fixture_id" in plan
    assert not [line for line in plan.splitlines() if "hashpartitioning(fixture_id" in line and "team_id" in line]
