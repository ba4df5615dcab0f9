"""Files cut at every kind of place read like Spark's own one-task reader."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldmart.sources import csv_ranges
from goldmart.sources.bronze import read_raw_csv

OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


@pytest.fixture()
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]

    def use(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield use
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def whole_file(spark, path, columns):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_corrupt"]])
    return [tuple(r) for r in spark.read.schema(schema).options(**OPTIONS).csv(path).collect()]


def in_ranges(spark, path):
    df = csv_ranges.read_records(spark, path)
    return df


def write(tmp_dir, name, text):
    path = f"{tmp_dir}/{name}"
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return path


def random_csv(seed, end="\n", rows=200):
    rng = random.Random(seed)

    def field():
        kind = rng.random()
        if kind < 0.3:
            return rng.choice(["", "x", "7.5", "ünï", " lead", "trail ", '5" disk', "a b"])
        inner = "".join(rng.choice(["a", "é", ",", "\n", '""', " ", "\n\n", "b" * 30]) for _ in range(rng.randint(0, 12)))
        return f'"{inner}"'

    lines = ["id,a,b,c"]
    for i in range(rows):
        n = 3 if rng.random() < 0.9 else rng.randint(0, 5)
        lines.append(",".join([str(i), *(field() for _ in range(n))]))
        if rng.random() < 0.05:
            lines.append("")
    return end.join(lines) + (end if rng.random() < 0.5 else "")


@pytest.mark.parametrize("seed, end, size", [(1, "\n", 64), (2, "\n", 257), (3, "\r\n", 100), (4, "\n", 1000), (5, "\r\n", 333), (6, "\n", 37)])
def test_ranges_read_like_the_whole_file(spark, tmp_dir, small_ranges, seed, end, size):
    path = write(tmp_dir, "one.csv", random_csv(seed, end))
    want = whole_file(spark, path, ["id", "a", "b", "c"])
    small_ranges(size)
    df = read_raw_csv(spark, path)
    assert csv_ranges._lines(spark, path).rdd.getNumPartitions() > 5
    # na tokens become null in both
    got = [tuple(r[:5]) for r in df.orderBy("_pos").collect()]
    assert got == want
    assert df.select("_pos.block").distinct().count() > 1


def test_a_record_over_many_ranges_and_an_open_quote_at_the_end(spark, tmp_dir, small_ranges):
    text = 'id,t\n1,"' + "line, of text\n" * 300 + '"\n2,x\n3,"' + "\n" * 50 + '"\n4,"never closed\nmore'
    path = write(tmp_dir, "long.csv", text)
    want = whole_file(spark, path, ["id", "t"])
    small_ranges(150)
    got = [tuple(r[:3]) for r in read_raw_csv(spark, path).orderBy("_pos").collect()]
    assert [r[:2] for r in got] == [r[:2] for r in want] and len(got) == 4


def test_folders_with_equal_and_other_headers(spark, tmp_dir, small_ranges):
    import os

    os.mkdir(f"{tmp_dir}/in")
    write(tmp_dir, "in/a.csv", 'id,t\n1,"a\nb"\n2,b\n')
    write(tmp_dir, "in/b.csv", 'id,t\r\n3,"c\r\nd"\r\n')
    write(tmp_dir, "in/c.csv", "id,t")
    small_ranges(16)
    df = read_raw_csv(spark, f"{tmp_dir}/in")
    assert [tuple(r) for r in df.orderBy("_pos").select("id", "t").collect()] == [("1", "a\nb"), ("2", "b"), ("3", "c\r\nd")]
    write(tmp_dir, "in/d.csv", "t,id\nx,4\n")
    with pytest.raises(csv_ranges.HeaderError, match="d.csv"):
        read_raw_csv(spark, f"{tmp_dir}/in")


@pytest.mark.parametrize("line, outside, inside", [
    (b"a,b", False, True), (b'a,"b', True, False), (b'a,"b",c', False, False), (b'"a""', True, False), (b'"",""', False, True), (b'5" disk,x', False, False),
    (b"", False, True), (b'"', True, False), (b'""', False, True), (b',"', True, False), (b'x"y,"', True, True),
])
def test_states_of_a_line(line, outside, inside):
    assert (csv_ranges.quoted_after(line, False), csv_ranges.quoted_after(line, True)) == (outside, inside)


def test_positions_keep_the_input_order_of_duplicates(spark, tmp_dir, small_ranges):
    from goldmart.operators.dedup import keep_first

    path = write(tmp_dir, "dup.csv", "id,t\n" + "".join(f'{i % 7},"row\n{i}"\n' for i in range(300)))
    small_ranges(90)
    first = keep_first(read_raw_csv(spark, path), ["id"], ["_pos"]).select("id", F.col("t")).collect()
    assert sorted((r["id"], r["t"]) for r in first) == [(str(i), f"row\n{i}") for i in range(7)]
