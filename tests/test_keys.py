"""Key rules against brute force, with and without heavy keys."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plumbline.operators import keys
from plumbline.operators.keys import ForeignKey, NoTwoCycle, UniqueKey, fan_out_left_join


def brute(check, rows, known):
    if isinstance(check, UniqueKey):
        def key(r):
            return (r[0] or "").strip() if check.strip else r[0]
        n = Counter(key(r) for r in rows)
        return [n[key(r)] > 1 and not (check.ignore_blank and not (r[0] or "").strip()) for r in rows]
    if isinstance(check, ForeignKey):
        return [(r[0] is not None or not check.optional) and r[0] not in known for r in rows]
    edges = {r for r in rows}
    return [None not in r and (r[1], r[0]) in edges for r in rows]


CHECKS = [
    UniqueKey(("a",)),
    UniqueKey(("a",), strip=True, ignore_blank=True),
    ForeignKey("a", "master", "k"),
    ForeignKey("a", "master", "k", optional=True),
    NoTwoCycle("a", "b"),
]


@pytest.mark.parametrize("hot", [1, 1000])
@pytest.mark.parametrize("check", CHECKS, ids=lambda c: repr(c)[:40])
def test_counts_and_marks_match_brute_force(spark, monkeypatch, check, hot):
    monkeypatch.setattr(keys, "HOT_KEYS", hot)
    rng = random.Random(5)
    names = ["a", "b", " b", "c", "d ", "d", "", "  ", None, "e", "f", "g", "h"]
    rows = [(rng.choice(names), rng.choice(names)) for _ in range(60)]
    # Two keys that hold a third of the rows each, one known to the master and one not.
    rows += [("heavy", "x")] * 60 + [("popular", "y")] * 60 + [("once", "twice")]
    known = {"a", "c", "popular", "once"}
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "a STRING, b STRING, i INT").repartition(5)
    master = spark.createDataFrame([(k,) for k in known] * 2 + [(None,)], "k STRING")
    expected = brute(check, rows, known)
    refs = {"master": master}
    assert keys.failing_row_count(check, df, refs).first()["failed_count"] == sum(expected)
    marked = keys.mark_rows(df, check, refs, "bad").orderBy("i").collect()
    assert [r["bad"] for r in marked] == expected


def test_shuffled_join_gives_the_same_marks(spark):
    rows = [("k%d" % (i % 50), i) for i in range(400)] + [("single", 1000)]
    df = spark.createDataFrame(rows, "a STRING, i INT")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        frame = keys.mark_rows(df, UniqueKey(("a",)), {}, "bad")
        marked = frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert len(marked) == len(rows)
    # What the Bloom filter or the list of heavy keys decides does not reach the join of the failing groups.
    assert "__bits" in plan and len(re.findall(r"(?:Broadcast|SortMerge|ShuffledHash)\w*Join", plan)) >= 5
    assert all(r["bad"] == (r["a"] != "single") for r in marked)


def test_self_loop_counts_and_longer_cycles_do_not(spark):
    edges = [("a", "a"), ("b", "c"), ("c", "d"), ("d", "b"), ("x", "y"), ("y", "x"), ("x", "y")]
    df = spark.createDataFrame(edges, "a STRING, b STRING")
    assert keys.failing_row_count(NoTwoCycle("a", "b"), df, {}).first()[0] == 4


def test_fan_out_keeps_multiplicity_and_unmatched_rows(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k STRING, v INT")
    right = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "k STRING, n STRING")
    got = {tuple(r) for r in fan_out_left_join(left, right, "k").collect()}
    assert got == {("a", 1, "x"), ("a", 1, "y"), ("b", 2, None), (None, 3, None)}


def test_empty_table_has_no_failures(spark):
    df = spark.createDataFrame([], "a STRING, b STRING")
    for check in CHECKS:
        refs = {"master": spark.createDataFrame([], "k STRING")}
        assert keys.failing_row_count(check, df, refs).first()[0] == 0
        assert keys.mark_rows(df, check, refs, "bad").count() == 0


def test_bloom_filter_holds_every_key_and_few_others(spark):
    held = spark.range(20_000).selectExpr("concat('k', id) AS a", "IF(id % 7 = 0, NULL, id) AS b")
    asked = spark.range(60_000).selectExpr("concat('k', id) AS a", "IF(id % 7 = 0, NULL, id) AS b", "id < 20000 AS inside")
    table = keys.bloom_filter(held, ["a", "b"])
    word, bits = keys._bloom_place(keys._digests(["a", "b"]))
    hits = asked.join(table, F.expr(f"{word} = __word"), "left").withColumn("hit", F.expr(f"coalesce(__bits & {bits} = {bits}, false)"))
    counts = {r.inside: (r.n, r.hits) for r in hits.groupBy("inside").agg(F.expr("count(*) AS n"), F.expr("count_if(hit) AS hits")).collect()}
    assert counts[True] == (20_000, 20_000) and counts[False][0] == 40_000 and counts[False][1] < 400
    assert table.count() <= keys.BLOOM_WORDS
    # A missing part is not taken for an absent one.
    assert keys.bloom_filter(spark.sql("SELECT 'x' AS a, CAST(NULL AS STRING) AS b"), ["a", "b"]).collect() != keys.bloom_filter(
        spark.sql("SELECT CAST(NULL AS STRING) AS a, 'x' AS b"), ["a", "b"]).collect()


def test_marks_beyond_the_list_of_heavy_keys(spark, monkeypatch):
    monkeypatch.setattr(keys, "HOT_KEYS", 2)
    rows = [("hot", i) for i in range(500)] + [("warm", i) for i in range(90)] + [(f"t{i // 2}", i) for i in range(40)]
    rows += [(f"s{i}", i) for i in range(300)] + [(None, 1), (None, 2), ("", 3), ("", 4)]
    df = spark.createDataFrame(rows, "a STRING, i INT").repartition(5)
    marked = keys.mark_rows(df, UniqueKey(("a",), ignore_blank=True), {}, "bad").collect()
    assert len(marked) == len(rows)
    assert all(r.bad == ((r.a or "")[:1] in ("h", "w", "t")) for r in marked)
