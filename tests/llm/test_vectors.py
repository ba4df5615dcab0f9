import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from goldmart.llm import near_vectors


def plain(rows, threshold=0.98):
    """n_links and smallest reachable id per row position, by all pairs."""
    def unit(v):
        if v is None or not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        a = np.array(v, dtype=np.float64)
        return a / math.sqrt((a * a).sum()) if (a * a).sum() else None

    units = [unit([None if x is None else float(np.float32(x)) for x in v]) if v is not None else None for _, v, _ in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if units[i] is None or units[j] is None or rows[i][2] is None or rows[i][2] != rows[j][2] or len(units[i]) != len(units[j]):
            continue
        if float(units[i] @ units[j]) >= threshold:
            links[i] += 1
            links[j] += 1
            root[find(j)] = find(i)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((vec_id, links[i], min(group) if group else None))
    return sorted(out, key=repr)


def crowd(rng, center, n, noise):
    return [list(map(float, center + noise * rng.standard_normal(len(center)))) for _ in range(n)]


def test_against_all_pairs_with_crowds_copies_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    vectors = []
    for label in (1, 1, 2):
        center = rng.standard_normal(16)
        vectors += [(v, label) for v in crowd(rng, center, 40, 0.03)] + [([float(x) for x in center], label)] * 30
    vectors += [(list(map(float, rng.standard_normal(16))), int(rng.integers(1, 4))) for _ in range(150)]
    rows = [(1000 - i, v, label) for i, (v, label) in enumerate(vectors)]
    one = rows[0][1]
    rows += [(5000, None, 1), (5001, [], 1), (5002, [0.0] * 16, 1), (5003, [float("nan")] + one[1:], 1), (5004, [float("inf")] + one[1:], 1),
             (5005, [None] + one[1:], 1), (5006, one, None), (5007, one[:8], 1), (1000, one, 1), (None, one, 1), (None, None, 1), (5008, [-0.0] * 16, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"Vec": F.lit(1), "CID": F.lit(2), "n_rows": F.lit(0)})
    for block in (512, 16):
        got = near_vectors.near_vectors(df, tables=64, block=block).collect()
        assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == plain(rows)
        assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(1500):  # pairs at cosine 0.9805
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist(), 1), (2 * i + 1, (0.9805 * a + math.sqrt(1 - 0.9805**2) * b).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    linked = near_vectors.near_vectors(df).where("n_links > 0").count()
    assert linked >= 0.995 * len(rows)
