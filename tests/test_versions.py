"""Outputs change all at once: a write that breaks leaves the old version in place."""

import os

import pytest
from pyspark.sql import functions as F

from goldmart.sinks.versions import current, publish, versions
from goldmart.sinks.writers import manifest, write_csv, write_parquet


def broken(spark):
    """Rows of which one partition fails after others are written."""
    return spark.range(0, 1000, 1, 8).select(F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("broken on purpose")).cast("long")).alias("id"))


@pytest.mark.parametrize("write, read", [(write_parquet, "parquet"), (write_csv, "csv")])
def test_a_broken_write_leaves_the_old_output(spark, tmp_dir, write, read):
    path = f"{tmp_dir}/out.{read}"
    count = lambda folder: getattr(spark.read.option("header", True), read)(folder).count()
    with pytest.raises(FileNotFoundError):
        current(spark, path)
    first = publish(spark.range(10).toDF("id"), path, write)
    old = spark.read.parquet(first) if read == "parquet" else None
    with pytest.raises(Exception, match="broken on purpose"):
        publish(broken(spark), path, write)
    assert current(spark, path) == first and count(first) == 10 and versions(spark, path) == [first]
    second = publish(spark.range(20).toDF("id"), path, write)
    assert current(spark, path) == second and count(second) == 20 and versions(spark, path) == [first, second]
    assert old is None or old.count() == 10  # a frame on the old version goes on
    assert os.path.exists(f"{second}/_SUCCESS")


def test_an_unpublished_folder_is_not_current(spark, tmp_dir):
    path = f"{tmp_dir}/out"
    folder = publish(spark.range(3).toDF("id"), path, write_parquet)
    write_parquet(spark.range(5).toDF("id"), f"{path}/version-99999999999999999999-late")
    assert current(spark, path) == folder


def test_manifest_names_the_output_of_a_version(spark, tmp_dir):
    folders = [publish(spark.range(3).toDF("id"), f"{tmp_dir}/a.csv", write_csv), write_parquet(spark.range(3).toDF("id"), f"{tmp_dir}/b")]
    assert {r["arquivo"] for r in manifest(spark, folders).collect()} == {"a.csv", "b"}


def test_two_runs_keep_the_tables_of_the_first(spark, tmp_dir):
    from goldmart.plans.catalogue import raw_frames
    from goldmart.plans.frames import LINE_ORDER, THRESHOLDS
    from goldmart.plans.pipeline import run_frames
    from tests.conftest import SF_SMALL

    go = lambda: run_frames(spark, raw_frames(spark, SF_SMALL), tmp_dir, order_by={"credits": LINE_ORDER, "keywords": LINE_ORDER}, thresholds=THRESHOLDS)
    first, second = go(), go()
    for name, folder in second["paths"].items():
        if name.endswith("_csv"):
            continue
        path = os.path.dirname(folder)
        assert versions(spark, path) == [first["paths"][name], folder]
    assert first["gold"].count() == second["gold"].count() > 0
    raw_counts = {r["indicador"]: r["valor"] for r in second["stage_counters"].collect()}
    assert raw_counts["total_linhas_brutas"] == sum(s["linhas"] for s in second["source_summary"])
