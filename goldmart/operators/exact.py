"""Sums and means of doubles that do not depend on the order of rows.

A sum of doubles is rounded at every step, so its last places follow the order in which partial sums meet, and a rounding to two decimals
can follow them. Here a double is split into a whole number and a power of two (``scale``, a multiple of ``STEP``): nothing is
rounded. Whole numbers of one scale are summed as three limbs of ``LIMB`` bits in longs, by ordinary partial aggregates on (keys, scale), exactly up to
4 * 10^12 rows for each group and scale. At the end a group has a few scales; their sum is one big whole number, and the only rounding is its
conversion, or its quotient by the count, to the nearest double (half to even).

Nulls are skipped; a group without values has a null sum and mean. NaN and infinities are kept apart: any of them decides the result as
in ordinary sums (NaN, or opposite infinities, give NaN), whatever the order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))

STEP, LIMB = 8, 21
# The least scale: below the last bit of the smallest double, and even, so that it is applied in two halves.
LEAST_SCALE = -1080
PARTS = ("lo", "mid", "hi", "n", "odd")

_RESULT = T.StructType([T.StructField("total", T.DoubleType()), T.StructField("mean", T.DoubleType())])


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) <= F.lit(1.7976931348623157e308))


def scale_of(value: Column) -> Column:
    """The scale of a finite double; null otherwise. A double of exponent e has bits from e - 52 up; the logarithm may
    be off by one next to a power of two, which the margin of one bit takes."""
    last_bit = F.floor(F.log2(F.abs(value))) - F.lit(53)
    step = F.floor(last_bit / F.lit(STEP)) * F.lit(STEP)
    found = F.greatest(F.coalesce(step, F.lit(LEAST_SCALE)), F.lit(LEAST_SCALE)).cast("int")
    return F.when(_finite(value), F.when(value == 0.0, F.lit(LEAST_SCALE)).otherwise(found))


def whole_of(value: Column, scale: Column) -> Column:
    """The whole number (long) that is ``value`` in units of 2^scale; powers of two are exact."""
    half = F.pow(F.lit(2.0), -scale / F.lit(2))
    return (value * half * half).cast("bigint")


def limb_sums(whole: Column, value: Column) -> dict[str, Column]:
    """Aggregates of one scale: the limbs' sums, the count, and the sum of the values that are not finite."""
    mask = F.lit((1 << LIMB) - 1)
    return {
        "lo": F.sum(whole.bitwiseAND(mask)), "mid": F.sum(F.shiftright(whole, LIMB).bitwiseAND(mask)), "hi": F.sum(F.shiftright(whole, 2 * LIMB)),
        "n": F.count(value), "odd": F.sum(F.when(~_finite(value), value)),
    }


def _rounded(scales) -> tuple[float | None, float | None]:
    """(total, mean) of the scales of a group."""
    units, n, odd = 0, 0, None
    for s in scales:
        n += s["n"]
        if s["odd"] is not None:
            odd = s["odd"] if odd is None else odd + s["odd"]
        if s["scale"] is not None:
            units += (s["lo"] + (s["mid"] << LIMB) + (s["hi"] << 2 * LIMB)) << (s["scale"] - LEAST_SCALE)
    if not n:
        return None, None
    if odd is not None:
        return odd, odd

    def quotient(below):
        try:
            return units / below  # of whole numbers: correctly rounded
        except OverflowError:
            return float("inf") if units > 0 else float("-inf")

    return quotient(1 << -LEAST_SCALE), quotient(n << -LEAST_SCALE)


# Bounds of ``_rounded_at_once``: the distance of a group's scales, its number of scales, its count, and scales whose results are ordinary doubles.
_SPREAD, _MOST, _COUNT, _ORDINARY = 16, 64, 1 << 20, (-900, 800)


def _carried(lo, mid, hi):
    """The same number with the two low limbs in [0, 2^LIMB)."""
    mask = (1 << LIMB) - 1
    mid = mid + (lo >> LIMB)
    return lo & mask, mid & mask, hi + (mid >> LIMB)


def _rounded_at_once(lengths, parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sure, total, mean) of many groups, none of them empty; ``parts`` holds the fields of all their scales, one group after the other.

    The scales of a group are brought to the least one. Its units are then high * 2^42 + low with 0 <= low < 2^42 and high < 2^53,
    two exact doubles, so their sum is the total, rounded once. The quotient by the count is taken in long division down to 2^-10,
    with one more bit that tells whether something is left: the bits still fit two exact doubles, and what is left can not lie on the other side of a
    tie, if the high part is 4 or more. Groups outside these bounds, or with values that are not finite, are not ``sure``."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    over = lambda op, x: op.reduceat(x, starts)
    lo, mid, hi = _carried(parts["lo"], parts["mid"], parts["hi"])
    some = (lo != 0) | (mid != 0) | (hi != 0)
    least = over(np.minimum, np.where(some, parts["scale"], 1 << 20))
    most = over(np.maximum, np.where(some, parts["scale"], LEAST_SCALE))
    zero, n = ~over(np.logical_or, some), over(np.add, parts["n"])
    least = np.where(zero, 0, least)
    sure = zero | ((most - least <= _SPREAD) & (least >= _ORDINARY[0]) & (most <= _ORDINARY[1]))
    shift = np.where(some, np.clip(parts["scale"] - np.repeat(least, lengths), 0, _SPREAD), 0)
    sure &= over(np.logical_and, (np.abs(hi) < np.left_shift(1, 46 - shift)) & ~parts["is_odd"]) & (lengths <= _MOST) & (n > 0) & (n < _COUNT)
    high = np.where(np.repeat(sure, lengths), hi, 0)  # no overflow in the groups that are left out
    lo, mid, hi = _carried(*(over(np.add, x << shift) for x in (lo, mid, high)))
    low = (mid << LIMB) | lo
    negative = hi < 0
    hi, low = np.where(negative, -hi - (low > 0), hi), np.where(negative & (low > 0), (1 << 2 * LIMB) - low, low)
    n = np.where(sure, n, 1)
    q, r = hi // n, hi % n
    r = (r << 2 * LIMB) + low
    ql, r = r // n, r % n
    sub, r = (r << 10) // n, (r << 10) % n
    sure &= (q >= 4) | (r == 0)
    sign, unit = np.where(negative, -1.0, 1.0), float(1 << 2 * LIMB)
    total = hi.astype(float) * unit + low.astype(float)
    mean = q.astype(float) * unit + ((ql << 11) | (sub << 1) | (r > 0)).astype(float) / 2048.0
    return sure, sign * np.ldexp(total, least) + 0.0, sign * np.ldexp(mean, least) + 0.0


@F.arrow_udf(_RESULT)
def exact_result(scales: pa.Array) -> pa.Array:
    """Struct (total, mean) of an array of scales; the longs must not pass through floats."""
    lengths = np.array(scales.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    total, mean, missing = np.zeros(len(scales)), np.zeros(len(scales)), np.ones(len(scales), dtype=bool)
    filled = np.flatnonzero(lengths)
    if len(filled):
        flat = scales.flatten()
        parts = {k: flat.field(k).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("scale", "lo", "mid", "hi", "n")}
        parts["is_odd"] = flat.field("odd").is_valid().to_numpy(zero_copy_only=False)
        sure, total[filled], mean[filled] = _rounded_at_once(lengths[filled], parts)
        missing[filled[sure]] = False
        rest = filled[~sure]
        for i, found in zip(rest, map(_rounded, scales.take(pa.array(rest)).to_pylist())):
            missing[i] = found[0] is None
            if not missing[i]:
                total[i], mean[i] = found
    return pa.StructArray.from_arrays([pa.array(x, pa.float64(), mask=missing) for x in (total, mean)], names=["total", "mean"])


def exact_groups(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str | Column], counts: Mapping[str, str | Column] | None = None) -> DataFrame:
    """(keys..., counts..., measures...): each count as a long, each measure as a struct (total, mean).

    One aggregate on the keys and the measures' scales (a handful for each group, so the map side combines as with ordinary sums),
    then one on the keys alone."""
    counts = dict(counts or {})
    values = {m: (F.col(c) if isinstance(c, str) else c).cast("double") for m, c in measures.items()}
    rows = df.select(*keys, *[F.when((F.col(c) if isinstance(c, str) else c).isNotNull(), 1).alias(f"_c_{n}") for n, c in counts.items()],
                     *[v.alias(f"_v_{m}") for m, v in values.items()])
    rows = rows.withColumns({f"_s_{m}": scale_of(F.col(f"_v_{m}")) for m in values})
    rows = rows.withColumns({f"_w_{m}": whole_of(F.when(F.col(f"_s_{m}").isNotNull(), F.col(f"_v_{m}")), F.col(f"_s_{m}")) for m in values})
    scaled = rows.groupBy(*keys, *[f"_s_{m}" for m in values]).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(f"_c_{n}").alias(f"_c_{n}") for n in counts],
        *[agg.alias(f"_{part}_{m}") for m in values for part, agg in limb_sums(F.col(f"_w_{m}"), F.col(f"_v_{m}")).items()],
    )
    per_scale = {m: F.struct(F.col(f"_s_{m}").alias("scale"), *[F.col(f"_{part}_{m}").alias(part) for part in PARTS]) for m in values}
    whole = scaled.groupBy(*keys).agg(
        F.sum("_rows").alias("_rows"), *[F.sum(f"_c_{n}").alias(n) for n in counts], *[F.collect_list(s).alias(m) for m, s in per_scale.items()])
    return whole.select(*keys, *counts, *[exact_result(m).alias(m) for m in values])


def merged_scales(df: DataFrame, keys: Sequence[str], scale: str = "_scale", result: str = "_exact", count: str = "n") -> DataFrame:
    """(keys..., count, result): rows that hold limb sums (``PARTS``) of one scale each, added up per keys."""
    merged = df.groupBy(*keys, scale).agg(*[F.sum(p).alias(p) for p in PARTS])
    per_key = merged.groupBy(*keys).agg(F.sum("n").alias(count), F.collect_list(F.struct(F.col(scale).alias("scale"), *PARTS)).alias(result))
    return per_key.withColumn(result, exact_result(result))
