import random

from pyspark.sql import functions as F

from vidstrata.operators.keys import first_by_key, fits_broadcast, hot_keys, spread_join, unseen
from vidstrata.session import estimated_bytes

NEVER_BROADCAST = 1 << 62


def test_first_by_key(spark):
    rows = [(random.Random(i).randrange(20), i, f"v{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "k int, seq int, v string").repartition(7)
    first = {}
    for k, seq, v in rows:
        first.setdefault(k, (seq, v))
    got = {r["k"]: (r["seq"], r["v"]) for r in first_by_key(df, ["k"], ["seq"]).collect()}
    assert got == first


def test_first_by_key_reduces_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("0 AS k", "id AS seq", "'x' AS v")
    plan = first_by_key(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_first_by_key_carries_what_is_kept_only(spark):
    rows = [(i % 20, i // 7, f"v{i}", f"path {i}") for i in range(500)]
    df = spark.createDataFrame(rows, "k int, seq int, v string, path string").repartition(7)
    kept = first_by_key(df, ["k"], ["seq", "path"], keep=["v"])
    assert kept.columns == ["k", "v"]
    whole = first_by_key(df, ["k"], ["seq", "path"]).select("k", "v")
    assert sorted(kept.collect()) == sorted(whole.collect())
    partial = next(line for line in kept._jdf.queryExecution().optimizedPlan().toString().splitlines() if "min_by" in line)
    assert partial.count("path#") == 1  # in the order, not in the row as well


def test_unseen(spark):
    source = spark.createDataFrame([(i, "s") for i in range(10)], "k int, v string")
    target = spark.createDataFrame([(i,) for i in range(5, 1000)], "k int")
    assert sorted(r["k"] for r in unseen(source, target, ["k"]).collect()) == [0, 1, 2, 3, 4]


def skewed(spark):
    """A third of the left rows on one key; that key twice on the right."""
    left = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 100 = 1 THEN NULL ELSE concat('k', id % 50) END "
        "AS lk", "id AS video")
    right = spark.range(60).selectExpr("concat('k', id) AS rk", "id AS channel").union(
        spark.createDataFrame([("hot", 900), ("hot", 901), (None, 902)], "rk string, channel long"))
    return left, right


def test_spread_join_equals_the_plain_join(spark):
    left, right = skewed(spark)
    plain = left.join(right, F.col("lk") == F.col("rk"))
    spread = spread_join(left, right, "lk", "rk", "video", share=20,
                         right_bytes=NEVER_BROADCAST)
    assert spread.columns == plain.columns
    key = lambda df: sorted((r["lk"], r["video"], r["channel"]) for r in df.collect())
    assert key(spread) == key(plain)
    assert spread.count() > 2000


def test_hot_keys_are_few_and_cut_fine(spark):
    left, _ = skewed(spark)
    hot = {r["lk"]: r["_pieces"] for r in hot_keys(left, "lk", share=20).collect()}
    assert set(hot) == {"hot"}
    assert 6 <= hot["hot"] <= 7


def test_spread_join_spreads_the_hot_key(spark):
    left, right = skewed(spark)
    plan = spread_join(left, right, "lk", "rk", "video", share=20,
                       right_bytes=NEVER_BROADCAST)._jdf.queryExecution().optimizedPlan().toString()
    assert "_piece" in plan and "xxhash64(video" in plan


def test_small_right_side_is_broadcast(spark):
    left, right = skewed(spark)
    plan = spread_join(left, right, "lk", "rk", "video", right_bytes=1000)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_no_task_gets_the_whole_hot_key(spark):
    """A third of 60,000 rows on one key: tasks stay near their even share of 1/16."""
    left = spark.range(60000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 5000) END AS lk", "id AS video")
    right = spark.range(5001).selectExpr(
        "CASE WHEN id = 5000 THEN 'hot' ELSE concat('k', id) END AS rk", "id AS channel")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)

    def largest(joined):
        sizes = [r["count"] for r in
                 joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 60000
        return max(sizes)

    try:
        plain = largest(left.join(right, F.col("lk") == F.col("rk")))
        spread = largest(spread_join(left, right, "lk", "rk", "video", share=200))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert plain > 20000 and spread < 2.2 * 60000 / 16


def test_estimated_bytes(spark):
    scan = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert 10_000 < estimated_bytes(scan) < 1_000_000
    assert estimated_bytes(scan.select("o_orderkey")) < estimated_bytes(scan)
    assert fits_broadcast(scan) and not fits_broadcast(scan.crossJoin(scan).crossJoin(scan))
