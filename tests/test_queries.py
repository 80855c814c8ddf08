import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_every_relay_query_has_sql():
    from outflow.jobs import oracle, queries

    assert set(queries.QUERIES) == set(oracle.ORACLE_SQL)
    assert set(entry.queries()) >= set(queries.QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", ["t4_committed_rows", "a4_apply_results", "t10_stream_committed_rows", "r4_stream_dedupe", "a10_relay_stream", "s6_write_state", "a8_retry_pass", "a9_snapshot_pass", "s5_message_manifest", "c8_recover", "c9_sets_at_checkpoints"])
def test_queries_match_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = entry.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got.columns) == sorted(columns)
    plain = lambda x: x.replace(tzinfo=None) if hasattr(x, "tzinfo") else x
    assert sorted((tuple(plain(x) for x in r) for r in got.select(*columns).collect()), key=key) == sorted(want.fetchall(), key=key)
