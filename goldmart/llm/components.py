"""Connected components of an edge table by alternating star contraction.

Each round points every node's larger neighbours at the smallest node near it (large star), then
does the same with the smaller ones (small star), until every component is one star around its
smallest node; the number of rounds grows with the logarithm of the size. A round is two joins of edges with
per-node minima: the minima are partial aggregates, and a node's edges meet its minimum in ``SALTS`` places, so
that a node with very many edges is no single task. Rounds are cut with ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldmart.session import ensure_checkpoint_dir

MAX_ROUNDS, SALTS = 60, 16


def _minima(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the smallest node m of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    copies = least.select("u", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(copies, ["u", "salt"]).drop("salt")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (u, v: long).

    Self-loops, repeated edges and either direction are fine; edges with a null end are ignored;
    an empty table gives an empty result."""
    ensure_checkpoint_dir(edges.sparkSession)
    current = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = current.checkpoint()
    seen = None
    for _ in range(MAX_ROUNDS):
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first()
        if tuple(state) == seen or state[0] == 0:
            break
        seen = tuple(state)
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _minima(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _minima(large).select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v")
        current = small.where("u <> v").distinct().checkpoint()
    else:
        raise RuntimeError("connected components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
