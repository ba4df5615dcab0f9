"""Exact quantiles per group (linear interpolation) without gathering a large group in one task.

A group of at most ``local_rows`` rows is bounded, so its values are sorted as one array: one
shuffle, however many such groups there are. A larger group is answered by selection in stages:

1. approximate equi-depth bounds of the group straight from the scan (``percentile_approx`` is a
   partial aggregate with a bounded sketch), distinct ones only;
2. each row's bucket by binary search over the bounds (one compiled column a step);
3. rows per bucket (partial aggregate), running totals, and with them the buckets that hold a wanted rank;
4. only the values of these buckets, about 1/256 of the group each, are counted and ranked exactly,
   every bucket in a task of its own.

Rows meet the bounds and the hit buckets of their group on (group, salt), so a group with a third of all rows is spread
over ``SALTS`` tasks; they are dealt out once, and only the values of hit buckets again. Both ways are exact; which one a group takes depends on its own size only. A group below ``min_count`` is dropped once its few
values lie together: dropping it earlier would take the same shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOCAL_ROWS = 100_000
SALTS = 16
_LEVELS = 8  # 256 buckets per group


def _with_bucket(df: DataFrame, value: str, bounds: str, levels: int, name: str = "_k") -> DataFrame:
    """Add the number of bounds strictly below ``value`` (bounds sorted, at most 2^levels - 1). Each step of the binary search is a column of its
    own, which Spark compiles; a fold over the steps is evaluated for each row anew."""
    df = df.withColumn(name, F.lit(0))
    for step in (1 << level for level in reversed(range(levels))):
        below = F.coalesce(F.get(F.col(bounds), F.col(name) + F.lit(step - 1)) < F.col(value), F.lit(False))
        df = df.withColumn(name, F.col(name) + F.when(below, F.lit(step)).otherwise(F.lit(0)))
    return df


def _with_salt(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_salt", F.pmod(F.xxhash64("_v") + F.spark_partition_id(), F.lit(SALTS)).cast("int"))


def _salted(per_key: DataFrame) -> DataFrame:
    """The rows of the large keys, once for each salt. The hint keeps the rows of the groups from being taken for the small side of a join and broadcast
    to the few tasks that hold these."""
    return per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("shuffle_hash")


def _interpolate(lo: Column, hi: Column, n: Column, frac: float, midpoint_mean: bool) -> Column:
    """Linear between ranks: numpy's two-sided form; (lo + hi) / 2 at the midpoint on request."""
    pos = (n - F.lit(1)) * F.lit(float(frac))
    t = pos - F.floor(pos)
    diff = hi - lo
    val = F.when(t == F.lit(0.0), lo)
    if midpoint_mean:
        val = val.when(t == F.lit(0.5), (lo + hi) / F.lit(2.0))
    return val.when(t < F.lit(0.5), lo + diff * t).otherwise(hi - diff * (F.lit(1.0) - t))


def _selected(rows: DataFrame, keys: list[str], fracs, names, midpoint_mean: bool, levels: int, accuracy: int) -> DataFrame:
    """(keys..., names...) of the large groups by selection; ``rows`` are (keys..., _v), with ``_salt`` if they are dealt out by it already."""
    rows = rows if "_salt" in rows.columns else _with_salt(rows)
    nb = (1 << levels) - 1
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.array_distinct(F.percentile_approx("_v", [i / (nb + 1) for i in range(1, nb + 1)], accuracy)).alias("_b"),
    )
    placed = _with_bucket(rows.join(_salted(stats), [*keys, "_salt"]), "_v", "_b", levels).drop("_b")

    running = Window.partitionBy(*keys).orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = placed.groupBy(*keys, "_k").agg(F.count(F.lit(1)).alias("_bn"), F.max("_n").alias("_n"))
    sizes = sizes.withColumn("_before", F.sum("_bn").over(running) - F.col("_bn"))
    ranks = {}
    for i, f in enumerate(fracs):
        pos = (F.col("_n") - F.lit(1)) * F.lit(float(f))
        ranks[f"_lo{i}"], ranks[f"_hi{i}"] = F.floor(pos).cast("bigint"), F.ceil(pos).cast("bigint")
    inside = [(r >= F.col("_before")) & (r < F.col("_before") + F.col("_bn")) for r in ranks.values()]
    targets = sizes.where(F.exists(F.array(*inside), lambda x: x)).select(*keys, "_k", "_before")

    wanted = targets.groupBy(*keys).agg(F.collect_list(F.struct("_k", "_before")).alias("_t"))
    hit = placed.join(_salted(wanted), [*keys, "_salt"]).withColumn("_t", F.filter("_t", lambda t: t["_k"] == F.col("_k")))
    values = hit.where(F.size("_t") > 0).withColumn("_before", F.col("_t")[0]["_before"]).groupBy(*keys, "_k", "_v").agg(
        F.count(F.lit(1)).alias("_c"), F.max("_n").alias("_n"), F.max("_before").alias("_before")
    )
    within = Window.partitionBy(*keys, "_k").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn("_end", F.col("_before") + F.sum("_c").over(within)).withColumn("_start", F.col("_end") - F.col("_c"))
    covers = [F.max(F.when((F.col("_start") <= r) & (r < F.col("_end")), F.col("_v"))).alias(name) for name, r in ranks.items()]
    picked = values.groupBy(*keys).agg(F.max("_n").alias("_n"), *covers)
    return picked.select(*keys, *[
        _interpolate(F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col("_n"), f, midpoint_mean).alias(names[i]) for i, f in enumerate(fracs)
    ])


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fracs: Sequence[float],
    names: Sequence[str] | None = None,
    midpoint_mean: bool = False,
    min_count: int = 1,
    levels: int = _LEVELS,
    accuracy: int = 10000,
    local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """(keys..., one column per fraction): exact quantiles of the non-null values of each group with at
    least ``min_count`` of them. Groups without values are absent."""
    keys, names = list(keys), list(names) if names else [f"q{i}" for i in range(len(fracs))]
    base = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    sizes = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    # rows meet the large keys on (keys, salt): no task gets a whole hot group, however the planner joins
    large = sizes.where(F.col("_size") > F.lit(local_rows)).select(*keys, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = _with_salt(base)
    small = salted.join(large, [*keys, "_salt"], "left_anti").groupBy(*keys).agg(F.sort_array(F.collect_list("_v")).alias("_all"))
    small = small.withColumn("_n", F.size("_all").cast("bigint")).where(F.col("_n") >= F.lit(min_count))
    at = lambda rank: F.get(F.col("_all"), rank((F.col("_n") - F.lit(1)) * F.lit(float(f))).cast("int"))
    columns = []
    for f, name in zip(fracs, names):
        columns.append(_interpolate(at(F.floor), at(F.ceil), F.col("_n"), f, midpoint_mean).alias(name))
    small = small.select(*keys, *columns)
    return small.unionByName(_selected(salted.join(large, [*keys, "_salt"], "left_semi"), keys, fracs, names, midpoint_mean, levels, accuracy))
