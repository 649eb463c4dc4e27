import random
import zlib
from collections import Counter, defaultdict

import pytest

from opsframe.llm import queries, sharding
from tests.llm.cases import DOCS, awkward, rows, sentence


def check_places(out, shards):
    places = defaultdict(list)
    for r in out:
        places[r.shard].append(r.slot)
    counts = [len(places[i]) for i in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(places[i]) == list(range(counts[i])) for i in range(shards))


@pytest.mark.parametrize("bucket_bytes", [sharding.BUCKET_BYTES, 2_000])
def test_every_row_has_one_place(spark, tmp_path, bucket_bytes):
    docs = rows([sentence(random.Random(i), 20) for i in range(200)] + ["copy"] * 100) + awkward()
    spark.createDataFrame(docs, DOCS).write.parquet(str(tmp_path / "docs"))
    frame = spark.read.parquet(str(tmp_path / "docs"))
    out = sharding.sharded(frame, bucket_bytes=bucket_bytes)
    assert out.columns == [*frame.columns, "shard", "slot"]
    found = out.collect()
    check_places(found, 16)
    assert Counter(tuple(r)[:5] for r in found) == Counter(docs)
    again = sharding.sharded(frame, bucket_bytes=bucket_bytes).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_order_is_shuffled_and_depends_on_the_seed(spark, tmp_path):
    spark.range(4_000).selectExpr("id AS doc_id", "'some text' AS text").write.parquet(str(tmp_path / "d"))
    frame = spark.read.parquet(str(tmp_path / "d"))
    first, second = (
        {r.doc_id: (r.shard, r.slot) for r in sharding.sharded(frame, bucket_bytes=8_000, seed=s).collect()}
        for s in (1, 2)
    )
    assert sum(first[i] == second[i] for i in first) < 20
    # Neighbours of the input are not neighbours in their shard.
    pairs = sum(first[i][0] == first[i + 1][0] for i in range(3_999))
    assert 150 < pairs < 350
    mean = sum(first[i][1] for i in range(1_000)) / 1_000
    assert abs(mean - 4_000 / 16 / 2) < 12


def test_plan_is_native_with_one_shuffle_of_texts(spark, tmp_path):
    spark.range(100).selectExpr("id AS doc_id", "'some text' AS text").write.parquet(str(tmp_path / "d"))
    frame = spark.read.parquet(str(tmp_path / "d"))
    buckets = (
        frame.selectExpr("struct(doc_id, text) AS r", "cast(doc_id % 4 AS int) AS b")
        .repartitionById(4, "b").groupBy("b").agg({"r": "collect_list"})
    )
    plan = buckets._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_the_same_files_give_the_same_places_in_any_splits(spark, tmp_path):
    texts = [sentence(random.Random(i), 400) for i in range(600)] + ["copy"] * 200
    spark.createDataFrame(rows(texts), DOCS).coalesce(2).write.option("parquet.block.size", 65_536).parquet(
        str(tmp_path / "d")
    )
    found, parts = [], []
    for size, cost in (("128m", "128m"), ("100k", "0")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        try:
            frame = spark.read.parquet(str(tmp_path / "d")).where("n_chars > 3")
            parts.append(frame.rdd.getNumPartitions())
            found.append(Counter(map(tuple, sharding.sharded(frame, bucket_bytes=50_000).collect())))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert parts[0] < parts[1]
    assert found[0] == found[1]


def test_texts_move_once_beyond_the_broadcast_threshold(spark, tmp_path):
    """The join with the buckets' starts broadcasts the stored starts, never the rows."""
    spark.createDataFrame(rows([sentence(random.Random(i), 60) for i in range(500)]), DOCS).write.parquet(
        str(tmp_path / "d")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        out = sharding.sharded(spark.read.parquet(str(tmp_path / "d")), bucket_bytes=20_000)
        plan = out._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_shards_are_written_in_folders(spark, tmp_path):
    spark.createDataFrame(rows(["a b"] * 50), DOCS).write.parquet(str(tmp_path / "d"))
    out = sharding.sharded(spark.read.parquet(str(tmp_path / "d")), shards=4)
    sharding.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter(r.shard for r in back.collect()) == {0: 13, 1: 13, 2: 12, 3: 12}


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame([("t", 1, 2, 3)], "text string, shard int, slot int, bucket int")
    row = sharding.sharded(frame).first()
    assert (row.shard, row.slot, row.bucket) == (0, 0, 3)
    assert sharding.sharded(frame.limit(0)).count() == 0


def test_query_digest(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in queries.table(spark, folder, "documents").collect()}
    out = queries.op6_sharding(spark, folder).collect()
    check_places(out, 16)
    assert {r.doc_id: (r["size"], r.text_crc32) for r in out} == {
        i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs.items()
    }
    assert all(r.law == "rows" and r.grown_shard is None for r in out)
