"""Embedding near-duplicates: Euclidean p-stable hashing, then exact cosine checks.

Vectors are normalised; in each of ``tables`` tables a vector's bucket is the tuple of ``draws``
quantised Gaussian projections floor((a.v + b) / width). Unit vectors of cosine 0.98 lie 0.2 apart and share a given
table's bucket with probability 0.26, hence some bucket of 24 with 0.9994; closer pairs more often.

* Equal vectors of a label are one class, counted first, so groups of copies never meet each other.
* A bucket is checked in blocks of ``block`` classes: each block meets each other block of its
  bucket in a task of its own, so no task holds a bucket, however large it is.
* A check multiplies two blocks in double precision and writes, for each vector, its number of links and one
  edge to the smallest vector of its local group: never the pairs. A pair found in several tables is counted
  in the first only.

Cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a
null label link with nothing and keep their own id; vectors of different length never link; repeated
rows are copies of one another; a null ``vec_id`` never becomes a component id unless nothing else
is there; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldmart.llm.common import ship
from goldmart.llm.components import connected_components
from goldmart.session import materialize

TABLES, DRAWS, WIDTH, SEED, BLOCK = 24, 16, 2.0, 20_000, 512
_RUN = 4096


def _projections(dim: int, tables: int, draws: int, width: float):
    import numpy as np

    rng = np.random.default_rng((SEED, dim))
    return rng.standard_normal((dim, tables * draws)), rng.uniform(0, width, tables * draws), rng.integers(1, 1 << 62, draws) | 1


def _unit(vectors):
    import numpy as np

    matrix = np.asarray(vectors, dtype=np.float64)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _with_buckets(classes: DataFrame, tables: int, draws: int, width: float) -> DataFrame:
    """Add ``sig`` (array<long>): the bucket of each table."""
    names = classes.columns
    at = names.index("vec")

    def run(batches):
        import numpy as np

        for batch in batches:
            rows = batch.column(at).to_pylist()
            sig = np.zeros((len(rows), tables), np.int64)
            by_dim = {}
            for i, v in enumerate(rows):
                by_dim.setdefault(len(v), []).append(i)
            for dim, own in by_dim.items():
                a, b, mix = _projections(dim, tables, draws, width)
                cells = np.floor((_unit([rows[i] for i in own]) @ a + b) / width).astype(np.int64)
                sig[own] = ((cells.reshape(len(own), tables, draws) + 1_000_003) * mix).sum(axis=2) + dim
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(sig), pa.list_(pa.int64()))], names=[*names, "sig"])

    schema = T.StructType(classes.schema.fields + [T.StructField("sig", T.ArrayType(T.LongType()))])
    return classes.mapInArrow(run, schema)


def _local_roots(a, b, ids):
    """Smallest id of each vector's group under the links (a, b), as positions into ids."""
    import numpy as np

    root = ids.copy()
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == root).all():
            return root
        root = new


def _links(ids, vecs, sig, block, table, within, threshold):
    """Positions (a, b) of linked pairs of one bucket's block pair, and whether this table is the first
    in which the pair meets."""
    import numpy as np

    left = np.flatnonzero(block == block.min())
    right = left if within else np.flatnonzero(block != block.min())
    near = vecs[left] @ vecs[right].T >= threshold
    if within:
        near = np.triu(near, 1)
    x, y = np.nonzero(near)
    a, b = left[x], right[y]
    first = np.ones(len(a), bool)
    for start in range(0, len(a), 1 << 16):
        part = slice(start, start + (1 << 16))
        first[part] = ~(sig[a[part], :table] == sig[b[part], :table]).any(axis=1)
    return a, b, first


def _check(members: DataFrame, threshold: float) -> DataFrame:
    """(cid, links, root) from rows grouped by (label, t, key, lo, hi), streamed in sorted order; a group's
    size is bounded by two blocks."""

    def run(batches):
        import numpy as np

        def judged(rows):
            ids = np.array(rows["cid"], np.int64)
            a, b, first = _links(ids, _unit(rows["vec"]), np.array(rows["sig"], np.int64), np.array(rows["block"]), rows["t"][0], rows["lo"][0] == rows["hi"][0], threshold)
            if not len(a):
                return None
            weight = np.array(rows["n_rows"], np.int64)
            links = np.zeros(len(ids), np.int64)
            np.add.at(links, a[first], weight[b[first]])
            np.add.at(links, b[first], weight[a[first]])
            hit = np.unique(np.concatenate([a, b]))
            return ids[hit], links[hit], _local_roots(a, b, ids)[hit]

        columns = ["label", "t", "key", "lo", "hi", "cid", "n_rows", "block", "vec", "sig"]
        key, rows, out = None, None, []

        def flush():
            found = list(map(np.concatenate, zip(*out)))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["cid", "links", "root"])

        for batch in batches:
            got = [batch.column(i).to_pylist() for i in range(len(columns))]
            for row in zip(*got):
                if row[:5] != key:
                    if rows is not None and (found := judged(rows)):
                        out.append(found)
                    key, rows = row[:5], {c: [] for c in columns}
                for c, v in zip(columns, row):
                    rows[c].append(v)
            if sum(len(o[0]) for o in out) >= _RUN:
                yield flush()
        if rows is not None and (found := judged(rows)):
            out.append(found)
        if out:
            yield flush()

    group = ["label", "t", "key", "lo", "hi"]
    rows = members.select(*group, "cid", "n_rows", "block", "vec", "sig").repartition(*group).sortWithinPartitions(*group)
    return rows.mapInArrow(run, "cid long, links long, root long")


def near_vectors(
    df: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
    tables: int = TABLES, draws: int = DRAWS, width: float = WIDTH, block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per input row."""
    vec = F.col("vec")
    rows = df.select(df[f"`{id_col}`"].cast("long").alias("vec_id"), df[f"`{vector}`"].cast("array<double>").alias("vec"), df[f"`{label}`"].alias("label"))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(vec.isNotNull() & F.col("label").isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    classes = rows.where("usable").groupBy("label", "vec").agg(F.count(F.lit(1)).alias("n_rows"), F.min("vec_id").alias("first_id"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    hashed = materialize(_with_buckets(classes.select("cid", "label", "n_rows", "vec"), tables, draws, width), "vector-buckets")

    keys = hashed.select("cid", "label", F.posexplode("sig").alias("t", "key"))
    sizes = keys.groupBy("label", "t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = keys.join(sizes, ["label", "t", "key"]).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    shared = shared.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    meets = shared.select("cid", "label", "t", "key", "block", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    meets = meets.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    members = meets.join(hashed.select("cid", "n_rows", "vec", "sig"), "cid")
    found = materialize(_check(members, threshold), "vector-links")

    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    rooted = classes.join(groups, classes["cid"] == groups["node"], "left").join(counts, "cid", "left")
    rooted = rooted.withColumn("root", F.coalesce("component", "cid"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_class = rooted.join(smallest, "root").select("label", "vec", "component_id", (F.col("n_rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    linked = rows.where("usable").join(per_class, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


ship(__name__)
