"""The queries again, over tables where one key or text holds a third of the rows."""

import duckdb
import pytest

import __spark_entry__ as entry_file
from tests.test_oracles import TABLES, table

SOURCE = "/root/testdata/sf0.001"
HOT = {
    "customer": "CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE c_nationkey END::INTEGER AS c_nationkey",
    "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey",
    "lineitem": "CASE WHEN l_linenumber % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey, "
    "CASE WHEN l_linenumber % 3 = 0 THEN 9 ELSE l_suppkey END AS l_suppkey",
    "events": "CASE WHEN event_id % 3 = 0 THEN 8 ELSE user_id END AS user_id",
    "documents": f"CASE WHEN doc_id % 3 = 0 THEN (SELECT text FROM '{SOURCE}/documents.parquet' WHERE doc_id = 6) "
    "ELSE text END AS text, CASE WHEN doc_id % 3 = 0 THEN 'src0' ELSE source END AS source",
}
AFFECTED = [
    "s3_registered_join",
    "s4_list_files",
    "s5_text_files",
    "s6_manifests",
    "s7_lane_counts",
    "r7_topk_join",
    "r10_qualified_flag",
    "r10_semi",
    "r10_anti",
    "r11_reroute",
    "r12_hazard_ranks",
    "r13_route_lane",
    "d5_except_all",
    "d6_profile",
    "i7_cached",
    "g1_guarded",
    "g2_review_state",
    "g2_review_state_strict",
    "g3_approved",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    duck = duckdb.connect()
    for name in TABLES:
        change = f" REPLACE ({HOT[name]})" if name in HOT else ""
        duck.execute(f"COPY (SELECT *{change} FROM '{SOURCE}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)")
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return folder, duck


@pytest.mark.parametrize("name", AFFECTED)
@pytest.mark.parametrize("broadcast", [True, False], ids=["broadcast", "shuffled"])
def test_query_equals_sql_under_skew(spark, skewed, name, broadcast):
    folder, duck = skewed
    key = "spark.sql.autoBroadcastJoinThreshold"
    if not broadcast:
        spark.conf.set(key, "-1")
    try:
        frame = entry_file.queries()[name](spark, folder)
        actual = table(frame.columns, [tuple(r) for r in frame.collect()])
    finally:
        spark.conf.unset(key)
    cursor = duck.execute(entry_file.oracle_sql()[name])
    assert actual == table([d[0] for d in cursor.description], cursor.fetchall())
