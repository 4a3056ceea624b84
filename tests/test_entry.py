import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
# Rows of queries at the smallest scale; None where SQL tells all of them.
CORE = {
    "facet_filter": None, "search_folded": None, "facet_domains": None, "sort_title_top": 100, "edge_target_missing": 4, "dup_edge": 4, "self_edge": 4, "dup_in_array": 8, "schema_rule_findings": None,
    "findings_by_code": None, "collection_summary": 1, "snapshot_diff": None, "rename_similarity": None, "change_kind_counts": 1, "stream_distinct_changes": 600, "html_stats": 1, "html_clean_full": 100, "asset_lookup_fallback": None, "chunk_grid": 100,
}


def rows_of(result, columns):
    order = sorted(columns)
    return sorted(tuple(str(v) for v in (dict(zip(columns, r))[c] for c in order)) for r in result)


def test_registry():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(FOLDER + "/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.skipif(not os.path.exists(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", CORE)
def test_core_queries(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    got = df.collect()
    if CORE[name] is not None:
        assert len(got) == CORE[name]
    assert got
    if name in entry.oracle_sql():
        found = duck.execute(entry.oracle_sql()[name])
        assert rows_of(got, df.columns) == rows_of(found.fetchall(), [d[0] for d in found.description])


@pytest.mark.skipif(not os.path.exists(FOLDER), reason="no test data")
def test_flagship(spark):
    assert entry.entry(spark).columns == ["record_id"]


@pytest.mark.skipif(not os.path.exists(FOLDER), reason="no test data")
def test_summary_counts_all_rules(spark):
    queries = entry.queries()
    counts = {"error": 0, "warning": 0}
    for r in queries["findings_by_code"](spark, FOLDER).collect():
        counts[r["severity"]] = counts.get(r["severity"], 0) + r["n"]
    got, keys = queries["collection_summary"](spark, FOLDER).first(), queries["key_findings_summary"](spark, FOLDER).first()
    assert (got["errors"], got["warnings"], got["passed"]) == (counts["error"], counts["warning"], counts["error"] == 0)
    assert got["errors"] + got["warnings"] > keys["errors"] + keys["warnings"]
