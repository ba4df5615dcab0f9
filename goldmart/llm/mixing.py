"""Mixing documents to target domain weights with soft domain membership.

1. A naive Bayes classifier is fitted on the labelled table: counts of hashed words and word
   endings per domain. It uses at most ``per_domain`` labelled documents of each domain (those with the smallest
   hash of the id), a documented bound; its weights are one row of ``2 * BUCKETS`` numbers per domain.
2. Every document gets posteriors p over the domains from all its words. Evidence is the mean over the words
   times at most ``EVIDENCE`` words, so long texts keep soft memberships.
3. Nonnegative document rates r minimise the distance of the expected domain totals
   sum(tokens * r * p) from the targets by projected gradient on r. Document terms are scaled by tokens and the residual by the
   Gram matrix of the domains, which makes the step size 1 safe; a step is r <- max(0, r - p . h),
   with one vector h of all documents, so rates are a fold over the few h found so far; they are written once every
   ``STEPS_A_TABLE`` steps. Targets that need long take larger steps, by the Gram matrix of the documents that are not at 0; one that
   does not come nearer is taken back. Each step is one distributed aggregate that returns a sum for each domain. It ends when the totals meet the
   targets within ``TOLERANCE``, or when a step moves next to nothing (the least distance that nonnegative rates reach);
   a residual above the tolerance is given with a warning. A caller may bound rates by ``max_rate``; none is set.

All work on rows is DataFrame functions. Words are exploded and added up per text at once in the scan
stage (partial aggregates), so the shuffle carries one row per text and task.

Cases: null and blank texts have no tokens, posteriors equal to the prior, and take part with weight 0; null or
unknown domains are not learned; a target that no document can serve is approached as far as nonnegative rates go, with a warning; repeated rows share posteriors and rate; without labels the posteriors are uniform;
an empty table gives an empty result; other columns are ignored by ``rates`` and kept by ``mix``.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldmart.session import materialize

BUCKETS, EVIDENCE, PER_DOMAIN = 1 << 13, 40, 2000
MAX_STEPS, TOLERANCE = 1000, 1e-4
# A step that moves less of the tokens than this is the end: no nonnegative rates come nearer.
LEAST_MOVE, STEPS_A_TABLE = 1e-7, 25
# After so many plain steps, steps by the Gram matrix of the documents with a rate above 0 are tried first.
PLAIN_STEPS = 40
MAX_RATE = float("inf")
CHUNK = 10_000
SMOOTHING = 0.5


def _features(word: Column) -> list[Column]:
    """Places of a word and of its last three characters in the weight rows."""
    whole = F.pmod(F.xxhash64(word), F.lit(BUCKETS))
    ending = F.pmod(F.xxhash64(F.right(word, F.lit(3)), F.lit("end")), F.lit(BUCKETS)) + BUCKETS
    return [whole.cast("int"), ending.cast("int")]


def _words(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"\s+")


def classifier(docs: DataFrame, labels: DataFrame, domains: list[str], id_col: str, text: str, per_domain: int = PER_DOMAIN) -> DataFrame:
    """One row with ``w`` (log P(feature | domain), place by place and in each domain by domain) and ``prior``
    (log prior per domain), from ``labels`` (id, domain)."""
    known = labels.where(F.col("domain").isin(domains) & F.col("id").isNotNull()).distinct()
    some = [known.where(F.col("domain") == d).orderBy(F.xxhash64("id", F.lit("mixing")), "id").limit(per_domain) for d in domains]
    chosen = reduce(DataFrame.unionByName, some)
    texts = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text}`"].alias("text"))
    words = texts.join(F.broadcast(chosen), "id").select("domain", F.explode(_words(F.col("text"))).alias("word")).where("word <> ''")
    seen = words.select("domain", F.explode(F.array(*_features(F.col("word")))).alias("place"))
    counts = seen.groupBy("place").agg(*[F.count(F.when(F.col("domain") == d, 1)).alias(f"n{i}") for i, d in enumerate(domains)])
    places = docs.sparkSession.range(2 * BUCKETS).select(F.col("id").cast("int").alias("place"))
    full = places.join(counts, "place", "left").fillna(0)
    row = full.agg(F.array_sort(F.collect_list(F.struct("place", *[f"n{i}" for i in range(len(domains))]))).alias("rows"))
    total_of = lambda n: F.aggregate("rows", F.lit(0.0), lambda a, r: a + r[n])
    totals = [total_of(f"n{i}") for i in range(len(domains))]
    row = row.select("rows", F.array(*totals).alias("total"))
    weights = F.flatten(F.transform("rows", lambda r: F.array(*[
        F.ln((r[f"n{i}"] + F.lit(SMOOTHING)) / (F.get("total", i) / 2 + F.lit(SMOOTHING * BUCKETS))) for i in range(len(domains))
    ])))
    sizes = known.agg(*[F.count(F.when(F.col("domain") == d, 1)).alias(f"s{i}") for i, d in enumerate(domains)])
    every = F.array(*[F.ln((F.col(f"s{i}") + 1.0) / (sum(F.col(f"s{j}") for j in range(len(domains))) + float(len(domains)))) for i in range(len(domains))])
    prior = sizes.select(every.alias("prior")).scalar()
    return materialize(row.select(weights.alias("w"), prior.alias("prior")), "mixing-classifier")


def posteriors(docs: DataFrame, model: DataFrame, domains: list[str], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_key, copies, tokens, p0, p1, ...): one row per distinct (id, text), written once; ``copies``
    is its number of rows, ``tokens`` the words of one of them."""
    n = len(domains)
    weight, prior = model.select("w").scalar(), model.select("prior").scalar()
    texts = docs.select(docs[f"`{id_col}`"].alias("id"), F.xxhash64(docs[f"`{text}`"]).alias("text_key"), _words(docs[f"`{text}`"]).alias("words"))
    words = texts.select("id", "text_key", F.posexplode("words").alias("at", "word"))
    placed = words.select("id", "text_key", "at", (F.col("word") != "").cast("int").alias("real"), *[f.alias(f"f{k}") for k, f in enumerate(_features(F.col("word")))])
    given = [F.col("real") * (F.get(weight, F.col("f0") * n + i) + F.get(weight, F.col("f1") * n + i)) for i in range(n)]
    sums = placed.groupBy("id", "text_key").agg(
        F.count(F.when(F.col("at") == 0, 1)).alias("copies"), F.sum("real").alias("words"), *[F.sum(g).alias(f"g{i}") for i, g in enumerate(given)]
    )
    share = F.when(F.col("words") > 0, F.least(F.col("words") / F.col("copies"), F.lit(float(EVIDENCE))) / F.col("words")).otherwise(0.0)
    logits = sums.select("id", "text_key", "copies", (F.col("words") / F.col("copies")).cast("long").alias("tokens"), *[(F.get(prior, i) + share * F.col(f"g{i}")).alias(f"l{i}") for i in range(n)])
    top = F.greatest(*[F.col(f"l{i}") for i in range(n)]) if n > 1 else F.col("l0")
    parts = [F.exp(F.col(f"l{i}") - top) for i in range(n)]
    out = logits.select("id", "text_key", "copies", "tokens", *[(p / reduce(Column.__add__, parts)).alias(f"p{i}") for i, p in enumerate(parts)])
    return materialize(out, "mixing-posteriors")


def _rate(steps: list[list[float]], n: int, max_rate: float = MAX_RATE) -> Column:
    """(rate, was): the rate in ``rate`` after the given steps and before the last of them."""
    start = F.struct(F.col("rate"), F.col("rate").alias("was"))
    if not steps:
        return start
    moves = F.expr("array(" + ", ".join("array(" + ", ".join(f"{float(x)!r}D" for x in h) + ")" for h in steps) + ")")
    dot = lambda h: reduce(Column.__add__, [F.col(f"p{i}") * F.get(h, i) for i in range(n)])
    bounded = (lambda r: F.least(F.lit(max_rate), r)) if max_rate < float("inf") else (lambda r: r)
    return F.aggregate(moves, start, lambda s, h: F.struct(bounded(F.greatest(F.lit(0.0), s["rate"] - dot(h))).alias("rate"), s["rate"].alias("was")))


def _solve(gram, residual):
    """gram^+ residual for a small symmetric matrix: directions without documents are left out, so h stays small along them."""
    import numpy as np

    size, axes = np.linalg.eigh(np.array(gram, float))
    real = size > 1e-9 * max(float(size.max()), 0.0)
    return (axes[:, real] @ ((axes[:, real].T @ np.array(residual, float)) / size[real])).tolist()


def fit_rates(
    members: DataFrame, shares: list[float], max_steps: int = MAX_STEPS, tolerance: float = TOLERANCE, max_rate: float = MAX_RATE
) -> tuple[DataFrame, float]:
    """``members`` with their ``rate`` by projected gradient, and the largest distance of a total from its target as a share of
    all tokens; the targets are ``shares`` of all tokens."""
    n = len(shares)
    mass = F.col("copies") * F.col("tokens")
    sums = members.agg(F.coalesce(F.sum(mass), F.lit(0)).alias("all"), *[F.coalesce(F.sum(mass * F.col(f"p{i}") * F.col(f"p{j}")), F.lit(0.0)).alias(f"g{i}_{j}") for i in range(n) for j in range(n)]).first()
    gram = [[sums[f"g{i}_{j}"] for j in range(n)] for i in range(n)]
    total = float(sums["all"])
    base, steps, taken, left = members.withColumn("rate", F.lit(1.0)), [], 0, 0.0
    bold, last, last_gap = False, None, float("inf")
    rated = lambda: base.withColumn("rate", _rate(steps, n, max_rate)["rate"])
    while total:
        now = base.select(mass.alias("m"), _rate(steps, n, max_rate).alias("s"), *[f"p{i}" for i in range(n)])
        free = F.when(F.col("s.rate") > 0, F.col("m")).otherwise(0.0)
        now = now.agg(
            F.sum(F.col("m") * F.abs(F.col("s.rate") - F.col("s.was"))).alias("moved"), *[F.sum(F.col("m") * F.col("s.rate") * F.col(f"p{i}")).alias(f"t{i}") for i in range(n)],
            *[F.sum(free * F.col(f"p{i}") * F.col(f"p{j}")).alias(f"f{i}_{j}") for i in range(n) for j in range(n)],
        ).first()
        residual = [now[f"t{i}"] - shares[i] * total for i in range(n)]
        gap = sum(a * b for a, b in zip(residual, _solve(gram, residual)))
        if bold and gap >= last_gap:
            steps[-1], bold = _solve(gram, last), False
            taken += 1
            continue
        left = max(abs(x) for x in residual) / total
        if left <= tolerance or taken >= max_steps or steps and not bold and now["moved"] <= LEAST_MOVE * total:
            break
        bold, last, last_gap = taken >= PLAIN_STEPS, residual, gap
        if len(steps) == STEPS_A_TABLE:
            base, steps = materialize(rated(), "mixing-rates"), []
        steps.append(_solve([[now[f"f{i}_{j}"] for j in range(n)] for i in range(n)] if bold else gram, residual))
        taken += 1
    if left > tolerance:
        warnings.warn(f"mixing: after {taken} steps a domain's total is off its target by {left:.4g} of all tokens", stacklevel=2)
    return rated(), left


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text: str = "text", per_domain: int = PER_DOMAIN, max_rate: float = MAX_RATE) -> DataFrame:
    """(id, text_key, copies, tokens, p0.., rate): one row per distinct (id, text); domains in the order of ``targets``."""
    domains = list(targets)
    whole = sum(targets.values())
    members = posteriors(docs, classifier(docs, labels, domains, id_col, text, per_domain), domains, id_col, text)
    return fit_rates(members, [targets[d] / whole for d in domains], max_rate=max_rate)[0]


def mix(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every row repeated by its rate: the whole part always, the rest by a hash of the id.
    Rows with rate 0 go; columns are unchanged. Copies are made ``CHUNK`` at a time, so a large rate costs no large array."""
    draw = F.pmod(F.xxhash64(F.col("__id"), F.col("__key"), F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    keyed = docs.withColumns({"__id": F.col(f"`{id_col}`"), "__key": F.xxhash64(F.col(f"`{text}`"))})
    rate = found.select(F.col("id").alias("__of"), F.col("text_key").alias("__of_key"), F.col("rate").alias("__rate"))
    joined = keyed.join(rate, keyed["__id"].eqNullSafe(rate["__of"]) & (keyed["__key"] == rate["__of_key"]))
    whole = F.floor("__rate").cast("long")
    times = whole + (draw < F.col("__rate") - whole).cast("long")
    chunks = joined.withColumn("__n", times).where("__n > 0").withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(CHUNK).cast("long"))))
    repeated = chunks.withColumn("__i", F.explode(F.sequence(F.col("__from"), F.least(F.col("__from") + CHUNK, F.col("__n")) - 1)))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
