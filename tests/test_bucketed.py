"""Silver stored in buckets by id: gold's joins on the stored tables need no shuffle."""

import os

from pyspark.sql import functions as F

from goldmart.operators.gold import build_gold_dataset
from goldmart.plans.catalogue import flat, order_gold, raw_frames
from goldmart.plans.frames import LINE_ORDER
from goldmart.plans.pipeline import write_silver
from goldmart.sinks.writers import write_bucketed
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_on_stored_silver_has_no_exchange(spark, tmp_dir):
    silver = write_silver(raw_frames(spark, SF_SMALL), f"{tmp_dir}/silver", {"credits": LINE_ORDER, "keywords": LINE_ORDER})
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gold = build_gold_dataset(silver["clean"], silver["directors"], silver["keywords"], silver["ratings"])
        plan = plan_of(gold)
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
        got, want = flat(gold), flat(order_gold(spark, SF_SMALL))
        assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_hold_one_key_each_and_leave_no_table(spark, tmp_dir):
    df = spark.range(1000).selectExpr("id % 100 AS k", "id AS v")
    before = {t.name for t in spark.catalog.listTables()}
    out = write_bucketed(df, f"{tmp_dir}/b", "k", 4)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert out.exceptAll(df).count() == 0 and out.count() == 1000
    files = out.select("k", F.input_file_name().alias("f")).distinct().groupBy("k").agg(F.count_distinct(F.regexp_extract("f", r"_(\d+)\.", 1)).alias("n"))
    assert files.agg(F.max("n")).first()[0] == 1
    assert "Exchange" not in plan_of(out.groupBy("k").agg(F.sum("v")))
    again = write_bucketed(df.where("k < 3"), f"{tmp_dir}/b", "k", 4)
    assert again.count() == 30 and os.path.exists(f"{tmp_dir}/b/_SUCCESS")


def test_one_file_for_each_bucket_after_a_window_on_the_key(spark, tmp_dir):
    from goldmart.operators.dedup import keep_first

    df = keep_first(spark.range(5000).selectExpr("id % 500 AS id", "id AS pos").repartition(7), ["id"], ["pos"])
    write_bucketed(df, f"{tmp_dir}/w", "id")
    assert len([f for f in os.listdir(f"{tmp_dir}/w") if f.endswith(".parquet")]) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
