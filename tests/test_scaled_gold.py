"""The steps that gold shares with most queries: each cell parsed once and late, exact results over whole batches, one pass for the links."""

import random
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from goldmart.functions.literals import PLAIN_LIST, _Cells, _json_members, with_members, with_name_list
from goldmart.functions.numeric import digits_only_id, to_double, to_long_truncated
from goldmart.operators.exact import LIMB, _rounded_at_once
from goldmart.operators.silver import build_directors, build_keywords
from goldmart.plans.frames import order_links

CELLS = ["[{'job': 'Director', 'name': 'D', 'adult': False}]", "[{'name': 'a', 'x': True, 'y': None}]", "[{'name': 'a'}]"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_python_words_are_read_by_the_jvm_and_words_in_quotes_are_not(spark):
    df = spark.createDataFrame([(c,) for c in [*CELLS, "[{'name': 'True'}]", "[{'name': False}]"]], "raw string")
    assert [r[0] for r in df.select(_json_members(F.col("raw")).isNotNull()).collect()] == [True, True, True, False, False]
    names = [list(r[0]) for r in with_name_list(df, "raw", "n").select("n.names").collect()]
    assert names == [["D"], ["a"], ["a"], ["True"], []]


def test_first_rows_are_found_before_cells_are_parsed_once(spark):
    rows = [("1", CELLS[0], 0), ("1", "[{'job': 'Director', 'name': 'late'}]", 1), ("2", "[{'job': 'Director'", 0), ("3", "(", 0), (None, CELLS[0], 0)]
    credits = spark.createDataFrame(rows, "id string, crew string, _pos int")
    found, keywords = build_directors(credits), build_keywords(credits.withColumnRenamed("crew", "keywords"))
    plans = plan_of(found), plan_of(keywords)
    assert [tuple(r) for r in found.collect()] == [(1, "D")]
    assert sorted((r["id"], list(r["keywords_list"])) for r in keywords.collect()) == [(1, ["D"]), (2, []), (3, [])]
    for plan in plans:
        assert plan.count("from_json") == plan.count("_python_members(") == 1
        assert plan.index("from_json") < plan.index("Window")


def test_ordinary_groups_are_rounded_at_once_and_exactly():
    rng = random.Random(8)
    groups, lengths = [], []
    fields = {k: [] for k in ("scale", "lo", "mid", "hi", "n", "is_odd")}
    for _ in range(3000):
        scales = rng.sample([-64, -56, -48], rng.randint(1, 3))
        total = Fraction(0)
        for scale in scales:
            n = rng.randint(1, 1000)
            whole = rng.choice([1, 1, -1]) * rng.randrange(1 << 53, 1 << 61) * n
            fields["scale"].append(scale)
            fields["lo"].append(whole & ((1 << LIMB) - 1))
            fields["mid"].append((whole >> LIMB) & ((1 << LIMB) - 1))
            fields["hi"].append(whole >> 2 * LIMB)
            fields["n"].append(n)
            fields["is_odd"].append(False)
            total += Fraction(whole) * Fraction(2) ** scale
        groups.append((total, sum(fields["n"][-len(scales):])))
        lengths.append(len(scales))
    sure, totals, means = _rounded_at_once(np.array(lengths), {k: np.array(v) for k, v in fields.items()})
    assert sure.mean() > 0.95
    for ok, total, mean, (exact, n) in zip(sure, totals, means, groups):
        assert not ok or (total, mean) == (float(exact), float(exact / n))


def test_links_come_from_one_distinct_pass(spark, tmp_dir):
    spark.createDataFrame([(5, 1), (5, 2), (5, 3), (None, 1), (7, None)], "l_orderkey long, l_linenumber int").write.parquet(f"{tmp_dir}/lineitem.parquet")
    links = order_links(spark, tmp_dir)
    assert plan_of(links).count("FileScan") == 1
    got = sorted((str(r["movieId"]), str(r["tmdbId"]), r["_pos"]) for r in links.collect())
    assert got == sorted([("11", "5", 0), ("11", "-6", 1), ("10", "5", 0), ("10", "-6", 1), ("None", "None", 0), ("None", "None", 1), ("None", "7", 0), ("None", "-8", 1)])


def test_long_ids_keep_their_rounding(spark):
    df = spark.createDataFrame([("999999999999999",), ("9007199254740993",), ("007",), (" 12 ",), ("12.7",), ("\x0012",), ("x",)], "id string")
    assert [r[0] for r in df.select(to_long_truncated(df, "id")).collect()] == [999999999999999, 9007199254740992, 7, 12, 12, None, None]


def test_plain_lists_are_known_by_one_pattern(spark):
    plain = [*CELLS, "[]", "[{}]", "[{'id': -1.5, \"name\": \"Joe's\", 'job': None}, {'x': 0}]", "[{'name': 'true love, NaN'}]", "[{'a': 'New Test For'}]"]
    other = ["[{'name': 7}]", "[{'name': False}]", "[{'name': 'True'}]", "[{'a': 007}]", "[{'a': 1},]", "[{'a': '\\\\n'}]", "[{'a' 'b': 1}]", "[{'a': [1]}]", "[{'a': {}}]",
             "[{'a': 'b\tc'}]", "[{'a': 1} ", "[{'a': 1}] ", "[{'a': 1}]\n", "[5]", "{'name': 'a'}", "[{'name\": 'x'}]", "[{'a': null}]", "[{'a': +1}]", "[{'a': b'x'}]", "['a']"]
    df = spark.createDataFrame([(c, c in plain) for c in plain + other], "raw string, is_plain boolean")
    got = with_members(df, "raw", "m").select("raw", "is_plain", F.col("raw").rlike(PLAIN_LIST).alias("p"), _json_members(F.col("raw")).isNotNull().alias("jvm"), "m").collect()
    cells = _Cells()
    for r in got:
        cells.add(r["raw"])
        assert r["p"] == r["is_plain"] and (r["jvm"] or not r["p"]), r["raw"]
        assert [(m["name"] or None, m["job"]) for m in r["m"]["members"]] == [(m["name"], m["job"]) for m in cells.members[-1]], r["raw"]
        assert r["m"]["malformed"] == cells.malformed[-1], r["raw"]


def test_a_long_plain_list_does_not_exhaust_the_stack(spark):
    raw = "[" + ", ".join(["{'id': 1, 'name': 'N T F', 'job': None}"] * 50_000) + "]"
    row = with_name_list(spark.createDataFrame([(raw,)], "raw string"), "raw", "n").select(F.col("raw").rlike(PLAIN_LIST), F.size("n.names")).first()
    assert tuple(row) == (True, 50_000)


def test_plain_ids_are_read_without_a_pattern(spark):
    texts = ["5", "-5", "-0", "0", "00", "+5", " 5", "5 ", "5\n", "", "-", "999999999999999", "-999999999999999", "1000000000000001", "9223372036854775807",
             "9223372036854775808", "-9223372036854775808", "-9223372036854775809", None]
    df = spark.createDataFrame([(t,) for t in texts], "id string")
    got = df.select(to_long_truncated(df, "id"), digits_only_id("id"), to_double(df, "id").try_cast("bigint")).collect()
    assert [g[0] for g in got] == [g[2] for g in got]
    assert [g[1] for g in got] == [int(t) if t and t.isascii() and t.isdigit() and int(t) < 2**63 else None for t in texts]
    assert "RLIKE ^[0-9]{1,15}" not in plan_of(df.select(to_long_truncated(df, "id")))


def test_credits_meet_the_customers_once_per_order(spark, tmp_dir):
    """The lines are joined to one side only, which already has the names: no shuffle of lines by customer."""
    from goldmart.plans.frames import order_credits

    t = F.lit("2000-01-01").cast("timestamp")
    lines = spark.createDataFrame([(1, 1, 7), (1, 2, 8), (2, 1, 9), (3, 1, 1), (None, 1, 1)], "l_orderkey long, l_linenumber int, l_partkey long")
    lines = lines.withColumns({"l_suppkey": F.lit(4).cast("long"), "l_shipdate": t, "l_extendedprice": F.lit(1.0), "l_quantity": F.lit(2.0)})
    lines.write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.createDataFrame([(1, 10), (2, None), (3, 11), (3, 10), (None, 10)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame([(10, "A"), (10, "B"), (None, "C")], "c_custkey long, c_name string").write.parquet(f"{tmp_dir}/customer.parquet")
    credits = order_credits(spark, tmp_dir)
    crew = {n: f"[{{'job': 'Producer', 'name': 'P4'}}, {{'job': 'Director', 'name': '{n}'}}]" for n in "AB"} | {None: None}
    expected = [("1", 1, "A"), ("1", 1, "B"), ("1", 2, "A"), ("1", 2, "B"), ("2", 1, None), ("3", 1, None), ("3", 1, "A"), ("3", 1, "B")]
    assert sorted(((r["id"], r["l_linenumber"], r["crew"]) for r in credits.collect()), key=str) == sorted(((i, n, crew[c]) for i, n, c in expected), key=str)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(order_credits(spark, tmp_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 4  # lines, orders by customer, customers, orders by order
