"""Queries on tables where one key holds a third of all rows."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import difference, duck

SOURCE = "/root/testdata/sf0.001"
HOT = {
    "lineitem": "CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_suppkey END AS l_suppkey, "
    "CASE WHEN l_orderkey % 3 = 0 THEN 11 ELSE l_partkey END AS l_partkey",
    "events": "CASE WHEN event_id % 3 = 0 THEN 6 ELSE user_id END AS user_id",
    "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey",
    "documents": "CASE WHEN doc_id % 3 = 0 THEN 'src3' ELSE source END AS source, "
    "CASE WHEN doc_id % 3 = 0 THEN 'the same text' ELSE text END AS text",
    "pages": "CASE WHEN page_id % 3 = 0 THEN 'http://hot.example.com/a/b' ELSE url END AS url",
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
NAMES = (
    "supplier_skew star_join_using star_join_using_merge star_join_merge_hint key_counts "
    "ndjson_event_count rolling_dir_check rolling_file_order log_size dir_checksum external_ingest "
    "catalog_entries label_score detect_skew detect_straggler detect_slow_host detect_loaded_executor "
    "detect_spec_waste detect_rescan detect_partial_cache detect_job_failures findings"
).split()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    with duckdb.connect() as connection:
        for table in TABLES:
            replaced = f" REPLACE ({HOT[table]})" if table in HOT else ""
            connection.execute(
                f"COPY (SELECT *{replaced} FROM '{SOURCE}/{table}.parquet') "
                f"TO '{out}/{table}.parquet' (FORMAT parquet)"
            )
    return str(out)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_change_nothing(spark, folder, name):
    result = queries()[name](spark, folder)
    assert difference(result, duck(folder), oracle_sql()[name]) is None
