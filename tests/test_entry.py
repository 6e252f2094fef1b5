"""The driver contract: entry() and the query/oracle registries."""

import duckdb

import __spark_entry__ as ent
from daybook.queries import ORACLE_SQL, QUERIES


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert "processed_date" in df.columns
    assert df.count() > 0


def test_every_query_has_oracle_or_is_rows_only():
    q, o = ent.queries(), ent.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) - set(ORACLE_SQL) == {"train_logistic_lbfgs"}
    assert set(QUERIES) <= set(q) and set(ORACLE_SQL) <= set(o)


def test_oracles_parse_in_duckdb():
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for name, sql in ent.oracle_sql().items():
        con.execute(f"EXPLAIN {sql}")


def test_sample_queries_match_oracle_small(spark):
    """A few queries end to end on sf0.001 (the full sweep is tools/check_oracle.py)."""
    con = duckdb.connect()
    for t in ("orders", "events", "lineitem", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for name in ("window_period_end_quarter", "completeness_events_month", "join_feature",
                 "live_partitions", "runlog_upsert_nodes", "classification_metrics", "valid_iso_date"):
        got = ent.queries()[name](spark, "/root/testdata/sf0.001")
        rows = sorted(tuple(str(x) for x in r) for r in got.select(*sorted(got.columns)).collect())
        cur = con.execute(ent.oracle_sql()[name])
        cols = [d[0] for d in cur.description]
        orows = [dict(zip(cols, r)) for r in cur.fetchall()]
        want = sorted(tuple(str(r[c]) for c in sorted(cols)) for r in orows)
        assert rows == want, name


def test_query_keys_are_descriptive():
    import re

    for key in QUERIES:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", key), key
        assert "pipeline" not in key and not re.match(r"op\d+_", key), key


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_QUERIES="valid_iso_date,runlog_max_id", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(repo, "bench.py")], capture_output=True, text=True, env=env,
                         timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and set(d["queries"]) == {"valid_iso_date", "runlog_max_id"} and d["sf"] == 0.001
