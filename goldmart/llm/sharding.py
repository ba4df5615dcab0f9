"""Assignment of rows to shards by a hierarchical weighted hash tree.

A tree has regions of racks of weighted shards. A key descends: at each level every child draws
ln(u) / weight, u being the uniform number hashed from the key and the child's name, and the
largest draw wins; a child's weight is the sum of its shards. So a child is chosen in proportion
to its weight, and when a weight changes only that child's draws change: rows move only between
subtrees whose weights change. A new shard comes as a region of its own, so it takes rows only into
itself and no row moves between old shards. A draw costs one hash, and a key makes one per child on its
way, not one per shard.

Everything is column expressions on the JVM; placement is row-wise, without a shuffle. Numbering the rows
of a shard without gaps needs the counts before a row: equal rows are counted first (a partial
aggregate, so a key repeated in a third of all rows is one row a task), counts are summed within
(shard, one of ``SLOT_BUCKETS`` hash buckets), and the bucket totals of a shard, a bounded table, give the offsets.

Cases: a null key is the empty text; a null text has no bytes (crc32 0); rows that agree in key, size
and crc32 are numbered one after the other; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldmart.session import materialize

SLOT_BUCKETS = 4096
_DIGITS = 13  # hexadecimal digits of a hash that a draw uses: 52 bits
_CHUNK = 1 << 16

#: {region: {rack: {shard: weight}}}
Tree = dict[str, dict[str, dict[int, float]]]


def even_tree(regions: int = 2, racks: int = 3, shards: int = 4) -> Tree:
    """Equal weights; shards are numbered through regions and racks from 0."""
    return {
        f"region{r}": {f"rack{k}": {(r * racks + k) * shards + s: 1.0 for s in range(shards)} for k in range(racks)}
        for r in range(regions)
    }


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region of its own."""
    new = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return {**tree, f"added{new}": {"rack0": {new: weight}}}


def _weight(node) -> float:
    return sum(_weight(v) for v in node.values()) if isinstance(node, dict) else node


def _uniform(key: Column, name: str) -> Column:
    """A number in (0, 1) from the md5 of the child's name and the key."""
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(name + ":"), key).cast("binary")), 1, _DIGITS), 16, 10)
    return (digits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 4 * _DIGITS))


def _winner(key: Column, children: dict, path: str) -> Column:
    """Position of the child with the largest draw; the earlier child wins a tie."""
    if len(children) == 1:
        return F.lit(0)
    draws = [
        F.struct((F.ln(_uniform(key, f"{path}/{name}")) / F.lit(float(_weight(child)))).alias("draw"), F.lit(-i).alias("place"))
        for i, (name, child) in enumerate(children.items())
    ]
    return -F.greatest(*draws)["place"]


def _descend(key: Column, node, path: str) -> Column:
    if not isinstance(next(iter(node.values())), dict):
        leaves = list(node)
        return F.get(F.array(*[F.lit(s) for s in leaves]), _winner(key, node, path))
    chosen, out = _winner(key, node, path), None
    branches = [_descend(key, child, f"{path}/{name}") for name, child in node.items()]
    if len(branches) == 1:
        return branches[0]
    for i, branch in enumerate(branches[:-1]):
        out = F.when(chosen == i, branch) if out is None else out.when(chosen == i, branch)
    return out.otherwise(branches[-1])


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard (int) of a key."""
    return _descend(F.coalesce(key.cast("string"), F.lit("")), tree, "").cast("int")


def slot_bucket(key: Column, size: Column, text_crc32: Column) -> Column:
    """One of 4,096 parts of a shard by the whole row, so the different rows of one id are spread."""
    row = F.concat(F.lit("slot:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), size.cast("string"), F.lit(":"), text_crc32.cast("string"))
    return F.conv(F.substring(F.md5(row.cast("binary")), 1, 3), 16, 10).cast("int")


def assign(df: DataFrame, tree: Tree, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard): one row per input row; ``grown_shard``
    is the shard after one more shard has been added."""
    key, body = df[f"`{id_col}`"], df[f"`{text}`"]
    placed = df.select(
        key.alias("id"), (F.coalesce(F.octet_length(body), F.lit(0)).cast("long") + 8).alias("size"),
        F.coalesce(F.crc32(body.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    row = ["id", "size", "text_crc32"]
    counted = placed.groupBy(*row).agg(F.count(F.lit(1)).alias("copies"))
    counted = counted.withColumns({
        "shard": shard_of(F.col("id"), tree), "grown_shard": shard_of(F.col("id"), grown(tree)), "bucket": slot_bucket(F.col("id"), F.col("size"), F.col("text_crc32")),
    })
    counted = materialize(counted, "shard-rows")
    totals = counted.groupBy("shard", "bucket").agg(F.sum("copies").alias("total"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    inner = Window.partitionBy("shard", "bucket").orderBy(*[F.col(c).asc_nulls_first() for c in row]).rowsBetween(Window.unboundedPreceding, -1)
    numbered = counted.withColumn("first", F.coalesce(F.sum("copies").over(inner), F.lit(0))).join(offsets, ["shard", "bucket"])
    chunks = numbered.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(_CHUNK))))
    each = F.explode(F.sequence(F.col("chunk"), F.least(F.col("chunk") + _CHUNK, F.col("copies")) - 1))
    rows = chunks.select(*row, "shard", "grown_shard", "offset", "first", each.alias("nth"))
    return rows.select(
        *row, F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("first") + F.col("nth")).cast("long").alias("slot"), "grown_shard"
    )
