"""Catalogue inputs derived from the TESTDATA star schema.

The catalogue tables have the movie schema but are built by Spark from ``orders``, ``lineitem``,
``customer`` and ``part``, so every operator runs on data that grows with the scale
factor. Dirt is produced by CASE expressions on keys (a value rule per row, never a row filter).

Order mart roles: id = order key, title = order status, genre = order priority, director = the
customer's name (from the order's first line, by the total line order below), keywords = the two
words of the first line's part name, budget = net line value, revenue = order total, runtime = days
from order to last shipment, votes = line count, vote average = mean discount in quarter steps,
user rating = half-step rating per order through a two-ids-per-order link bridge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A total order of the lines within one order key (no two lines tie on it).
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]

# Catalogue thresholds sized for the order mart (about 4 lines per order).
THRESHOLDS = {
    "min_genre": 20,
    "min_director": 6,
    "min_decade": 20,
    "min_keyword": 10,
    "top_limit": 20,
    "top_min_votes": 4,
    "top_min_budget": 100_000,
    "feed_min_budget": 100_000,
    "feed_min_revenue": 100_000,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def dirty_dates(movies: DataFrame) -> DataFrame:
    """The movies table with release dates and collections in the shapes a raw export holds, by order key % 10."""
    k = F.col("_pos") % 10
    text = (
        F.when(k == 0, F.lit("1995-1-5")).when(k == 1, F.lit("1995-02-30")).when(k == 2, F.lit("1995"))
        .when(k == 3, F.lit("1995-03-04 10:00:00")).when(k == 4, F.lit("")).when(k == 5, F.lit("1600-01-01"))
        .when(k == 6, F.lit("2300-05-05")).when(k == 7, F.lit("2000-12-31")).otherwise(F.col("release_date"))
    )
    collection = F.when(k % 4 == 0, F.lit("  ")).when(k % 4 == 1, F.lit(" Saga ")).when(k % 4 == 2, F.lit("")).otherwise(F.col("belongs_to_collection"))
    return movies.withColumns({"release_date": text, "belongs_to_collection": collection})


def quoted_titles(movies: DataFrame) -> DataFrame:
    """Raw movies whose titles hold quotes, commas and line ends, by part key % 5."""
    k, t = F.col("l_partkey") % 5, F.coalesce(F.col("title"), F.lit("none"))
    title = (
        F.when(k == 0, F.concat(F.lit('"'), t, F.lit('"'))).when(k == 1, F.concat(t, F.lit(', the\nsecond ""line"\n')))
        .when(k == 2, F.concat(F.lit('\n\n,"",'), t)).when(k == 3, F.concat(t, F.lit('" disk'))).otherwise(F.col("title"))
    )
    return movies.withColumn("title", title)


def order_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movies-shaped raw table, one row per order."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    net = F.rint(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) * F.lit(100.0))
    lines = li.groupBy("l_orderkey").agg(
        (F.sum(net) / F.lit(100.0)).alias("budget"),
        F.count(F.lit(1)).cast("double").alias("vote_count"),
        # mean discount in quarter points from exact integer cents: 4 * S / n is one correctly
        # rounded division, so an exact half step rounds the same (to even) in any engine
        (F.rint(F.lit(4.0) * F.sum(F.rint(F.col("l_discount") * F.lit(100.0))) / F.count(F.lit(1))) / F.lit(4.0)).alias("vote_average"),
        (F.rint(F.sum("l_tax") * F.lit(100.0)) / F.lit(100.0)).alias("popularity"),
        F.max("l_shipdate").alias("_last_ship"),
    )
    m = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
    return m.select(
        _s("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("title"),
        F.lit("False").alias("adult"),
        "budget",
        F.col("o_totalprice").alias("revenue"),
        F.datediff(F.col("_last_ship").cast("date"), F.col("o_orderdate").cast("date")).cast("double").alias("runtime"),
        F.concat(F.lit("[{'id': "), _s(F.length("o_orderpriority")), F.lit(", 'name': '"),
                 F.col("o_orderpriority"), F.lit("'}]")).alias("genres"),
        F.when(F.col("o_orderstatus") == F.lit("F"), F.lit("Colecao")).alias("belongs_to_collection"),
        "vote_average",
        "vote_count",
        "popularity",
        F.lit("en").alias("original_language"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"),
        F.concat(F.lit("order "), _s("o_orderkey")).alias("overview"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("_pos"),
    )


def order_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits-shaped raw table, one row per line. By part key: producer only (k%5=0), a
    Python-only literal (k%7=3), a truncated literal (k%11=4), else producer + director."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # the names come to the orders first: the lines, about four for an order, are shuffled by the order key alone
    named = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name")
    x = li.join(named, F.col("l_orderkey") == F.col("o_orderkey"))
    pk = F.col("l_partkey")
    producer = F.concat(F.lit("{'job': 'Producer', 'name': 'P"), _s("l_suppkey"), F.lit("'}"))
    director = F.concat(F.lit("{'job': 'Director', 'name': '"), F.col("c_name"), F.lit("'}"))
    crew = (
        F.when(pk % 5 == 0, F.concat(F.lit("["), producer, F.lit("]")))
        .when(pk % 7 == 3, F.concat(F.lit("[{'job': 'Director', 'name': '"), F.col("c_name"), F.lit("', 'adult': False}]")))
        .when(pk % 11 == 4, F.concat(F.lit("[{'job': 'Director', 'name': '"), F.col("c_name"), F.lit("'")))
        .otherwise(F.concat(F.lit("["), producer, F.lit(", "), director, F.lit("]")))
    )
    return x.select(_s("l_orderkey").alias("id"), crew.alias("crew"), *LINE_ORDER)


def order_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords-shaped raw table, one row per line, from the part name's two words. By part
    key: truncated (k%17=0), a None name between the words (k%13=5), empty list (k%19=7)."""
    li = table(spark, sf_dir, "lineitem")
    words = F.split("p_name", " ")
    # the words are cut once for a part, not for each of its lines
    part = table(spark, sf_dir, "part").select("p_partkey", F.get(words, 0).alias("_w1"), F.get(words, 1).alias("_w2"))
    x = li.join(part, li["l_partkey"] == part["p_partkey"], "left")
    w1, w2 = F.col("_w1"), F.col("_w2")
    k = _s("l_partkey")
    item = lambda w: F.concat(F.lit("{'id': "), k, F.lit(", 'name': '"), w, F.lit("'}"))
    pk = F.col("l_partkey")
    kw = (
        F.when(pk % 17 == 0, F.concat(F.lit("["), item(w1), F.lit(", {'id': "), k, F.lit(", 'name': '"), w2))
        .when(pk % 13 == 5, F.concat(F.lit("["), item(w1), F.lit(", {'id': "), k, F.lit(", 'name': None}, "),
                                     item(w2), F.lit("]")))
        .when(pk % 19 == 7, F.lit("[]"))
        .otherwise(F.concat(F.lit("["), item(w1), F.lit(", "), item(w2), F.lit("]")))
    )
    return x.select(_s("l_orderkey").alias("id"), kw.alias("keywords"), *LINE_ORDER)


def _movie_id():
    return F.col("l_orderkey") * F.lit(2) + F.col("l_linenumber") % F.lit(2)


def order_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links-shaped raw table: two movieIds per order map to the order; every mapping is
    repeated later in the input with a wrong target, which keep-first must ignore."""
    li = table(spark, sf_dir, "lineitem")
    m = li.select(_movie_id().alias("movieId"), F.col("l_orderkey").alias("tmdbId")).distinct()
    first = F.struct(_s("tmdbId").alias("tmdbId"), F.lit(0).alias("_pos"))
    later = F.struct(_s(F.lit(-1) - F.col("tmdbId")).alias("tmdbId"), F.lit(1).alias("_pos"))
    return m.select(_s("movieId").alias("movieId"), F.inline(F.array(first, later)))


def order_ratings(spark: SparkSession, sf_dir: str, varied: bool = True) -> DataFrame:
    """Ratings-shaped raw table, one row per line; no rating when part key % 23 = 0.
    ``varied``: the line quantity; else a half-step rating fixed per order."""
    li = table(spark, sf_dir, "lineitem")
    value = F.col("l_quantity") if varied else (F.lit(1) + F.col("l_orderkey") % F.lit(10)) * F.lit(0.5)
    return li.select(
        _s("l_suppkey").alias("userId"),
        _s(_movie_id()).alias("movieId"),
        F.when(F.col("l_partkey") % 23 != 0, _s(value)).alias("rating"),
        _s(F.col("l_shipdate").cast("date")).alias("timestamp"),
    )


def dirty_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movies-shaped raw text with dirt, one row per line: order keys repeat (about four lines
    per order), so keep-first has real duplicates to resolve."""
    li = table(spark, sf_dir, "lineitem")
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    q = _s(F.col("l_quantity").cast("bigint"))
    ident = (
        F.when(ok % 7 == 0, F.concat(F.lit("x"), _s(ok)))
        .when(ok % 11 == 0, F.lit(""))
        .when(ok % 13 == 0, F.concat(F.lit("000"), _s(ok)))
        .when(ok % 17 == 0, F.concat(F.lit(" "), _s(ok)))
        .when(ok % 19 == 0, F.concat(_s(ok), F.lit(".0")))
        .otherwise(_s(ok))
    )
    nbsp = F.lit(chr(0xA0))
    title = (
        F.when(ln % 4 == 0, F.lit("   "))
        .when(ln % 4 == 1, F.concat(F.lit("  "), F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus"), F.lit("\t")))
        .when(ln % 4 == 2, F.lit("NA"))
        .otherwise(F.concat(nbsp, F.col("l_returnflag"), nbsp))
    )
    adult = (
        F.when(pk % 6 == 0, F.lit(" TRUE "))
        .when(pk % 6 == 1, F.lit("False"))
        .when(pk % 6 == 2, F.lit(None).cast("string"))
        .when(pk % 6 == 3, F.lit("junk"))
        .when(pk % 6 == 4, F.lit("true"))
        .otherwise(F.lit("FALSE"))
    )
    budget = (
        F.when(pk % 5 == 0, F.lit("0"))
        .when(pk % 5 == 1, F.lit("1e3"))
        .when(pk % 5 == 2, F.concat(F.lit(" "), q, F.lit(" ")))
        .when(pk % 5 == 3, F.concat(q, F.lit("d")))
        .otherwise(F.lit("nan"))
    )
    revenue = F.when(sk % 4 == 0, F.lit("0")).otherwise(F.concat(q, F.lit("00")))
    runtime = (
        F.when(sk % 6 == 0, F.lit("0"))
        .when(sk % 6 == 1, F.lit("-1"))
        .when(sk % 6 == 2, F.lit(""))
        .when(sk % 6 == 3, F.lit("abc"))
        .otherwise(F.concat(q, F.lit(".5")))
    )
    return li.select(
        ident.alias("id"),
        title.alias("title"),
        adult.alias("adult"),
        budget.alias("budget"),
        revenue.alias("revenue"),
        runtime.alias("runtime"),
        F.lit("[]").alias("genres"),
        F.when(ln % 3 == 0, F.lit(" ")).alias("belongs_to_collection"),
        F.lit("7.5").alias("vote_average"),
        q.alias("vote_count"),
        F.lit("N/A").alias("popularity"),
        F.lit("en").alias("original_language"),
        F.lit("1995-1-5").alias("release_date"),
        F.lit("null").alias("overview"),
        F.col("l_linestatus").alias("status"),
        *LINE_ORDER,
        F.col("l_orderkey").alias("_okey"),
    )


def number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text number per line, eight shapes chosen by part key % 8."""
    li = table(spark, sf_dir, "lineitem")
    q = _s(F.col("l_quantity").cast("bigint"))
    pk = F.col("l_partkey") % 8
    txt = (
        F.when(pk == 0, F.lit("1e3"))
        .when(pk == 1, F.concat(F.lit(" "), q, F.lit(" ")))
        .when(pk == 2, F.concat(q, F.lit("d")))
        .when(pk == 3, F.concat(F.lit("+"), q))
        .when(pk == 4, F.concat(q, F.lit(".7")))
        .when(pk == 5, F.concat(F.lit("-"), q, F.lit(".25")))
        .when(pk == 6, F.lit("0x10"))
        .otherwise(F.lit("nan"))
    )
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", txt.alias("texto"))


def na_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text value per line: NA tokens and near-tokens chosen by line number."""
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    txt = (
        F.when(ln == 1, F.lit("NA"))
        .when(ln == 2, F.lit("n/a"))
        .when(ln == 3, F.lit("#N/A N/A"))
        .when(ln == 4, F.lit(" NA"))
        .when(ln == 5, F.lit("na"))
        .when(ln == 6, F.lit("-nan"))
        .otherwise(F.col("l_returnflag"))
    )
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", txt.alias("texto"))


def literal_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One literal per part, twelve shapes chosen by part key % 12, built from the name's words."""
    part = table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    w1, w2 = F.get(words, 0), F.get(words, 1)
    k = _s("p_partkey")
    it = lambda w: F.concat(F.lit("{'id': "), k, F.lit(", 'name': '"), w, F.lit("'}"))
    v = F.col("p_partkey") % 12
    lit_ = (
        F.when(v == 0, F.concat(F.lit("["), it(w1), F.lit(", "), it(w2), F.lit("]")))
        .when(v == 1, F.concat(F.lit("[{'id': "), k, F.lit(", 'name': \""), w1, F.lit("'s\", 'x': True}, "), it(w2), F.lit("]")))
        .when(v == 2, F.concat(F.lit("["), it(w1), F.lit(", {'name': '"), w2))
        .when(v == 3, F.concat(F.lit("["), it(w1), F.lit(", 5, "), it(w2), F.lit("]")))
        .when(v == 4, F.lit("[]"))
        .when(v == 5, F.lit(None).cast("string"))
        .when(v == 6, F.concat(F.lit("[{'name': '"), w1, F.lit("', 'name': '"), w2, F.lit("'}]")))
        .when(v == 7, F.concat(F.lit("{'name': '"), w1, F.lit("'}")))
        .when(v == 8, F.concat(F.lit("["), it(w1), F.lit(",]")))
        .when(v == 10, F.concat(F.lit("[{'id': 1, 'name': \""), w1, F.lit("': None, "), w2, F.lit("\"}]")))
        .when(v == 11, F.concat(F.lit("[{'id': None, 'name': \""), w1, F.lit("': None}\", 'x': None}]")))
        .otherwise(F.concat(F.lit("["), it(w1), F.lit(", "), it(w1), F.lit("]")))
    )
    return part.select("p_partkey", "p_name", (F.col("p_partkey") % 12).cast("int").alias("variante"), lit_.alias("literal"))
