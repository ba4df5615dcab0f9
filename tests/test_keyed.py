"""One key is read from few row groups of a table written for look-ups."""

from pyspark.sql import functions as F

from goldmart.operators.profile import record_of
from goldmart.sinks.writers import write_keyed, write_parquet


def rows_read(df):
    """(rows the scan gave out, rows of the result)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value(), df.count()


def test_one_key_reads_few_row_groups(spark, tmp_dir):
    n = 200_000
    df = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(n * 10))).alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(4)
    keyed = spark.read.parquet(write_keyed(df, f"{tmp_dir}/keyed", row_group_bytes=1 << 18))
    plain = spark.read.parquet(write_parquet(df, f"{tmp_dir}/plain"))
    some = [r["id"] for r in df.limit(3).collect()]
    for value in some:
        read, found = rows_read(record_of(keyed, value))
        assert found == df.where(F.col("id") == value).count() >= 1 and read < n / 10
        assert "PushedFilters: [IsNotNull(id), EqualTo(id," in record_of(keyed, value)._jdf.queryExecution().toString()
    assert rows_read(record_of(plain, some[0]))[0] > n / 10
    assert rows_read(record_of(keyed, -5))[0] == 0
    assert keyed.exceptAll(df).count() == 0


def test_no_sort_is_added_where_rows_come_sorted(spark, tmp_dir):
    from goldmart.sinks.writers import write_bucketed

    a, b = (write_bucketed(spark.range(1000).selectExpr("id", f"id * {k} AS v{k}"), f"{tmp_dir}/{k}", "id", 4) for k in (2, 3))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b, "id", "left")
        plan = joined.sortWithinPartitions("id")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Sort [") == 2
        assert spark.read.parquet(write_keyed(joined, f"{tmp_dir}/out")).count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
