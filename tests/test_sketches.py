"""Profiles from sketches of parts against exact ones."""

from plumbline.operators import profiling, sketches
from plumbline.session import fresh_path


def rows(spark, start, end):
    return spark.range(start, end).selectExpr(
        "CAST(id DIV 10000 AS STRING) AS day", "id", "CASE WHEN id % 10 < 3 THEN 'hot' ELSE concat('v', id % 5000) END AS word",
        "CASE WHEN id % 4 = 0 THEN CAST('NaN' AS DOUBLE) ELSE id % 7 END AS number", "concat(repeat('x', 300), id % 2) AS text")


def test_merged_sketches_keep_their_bounds(spark):
    df, path = rows(spark, 0, 30000), fresh_path(spark, "sketches")
    sketches.keep(sketches.sketch(df.where("day < '2'"), "day"), path)
    sketches.keep(sketches.sketch(df.where("day = '2'"), "day"), path)
    found = sketches.merged_profile(sketches.kept(spark, path), "t")
    audit = {r.column_name: r for r in sketches.audited(found, df).collect()}
    assert set(audit) == set(df.columns)
    assert all(r.counts_equal and r.unique_in_bound and r.top_in_bound for r in audit.values())
    got = {r.column_name: r for r in found.collect()}
    assert [r.column_name for r in found.collect()] == df.columns
    assert got["word"].top_values[0].asDict() == {"value": "hot", "rows": 9000}
    assert got["number"].missing_count == 7500 and got["number"].unique_count == 7
    assert {v.value[:7] for v in got["text"].top_values} == {"sha256:"} and got["text"].unique_count == 2
    # The counts of few values are those of the exact profile.
    exact = {r.column_name: r for r in profiling.profile(df, "t").collect()}
    assert {(v.value, v.rows) for v in got["day"].top_values} == {(v.value, v.rows) for v in exact["day"].top_values}


def test_a_part_written_again_replaces_itself_only(spark):
    path = fresh_path(spark, "sketches")
    sketches.keep(sketches.sketch(rows(spark, 0, 20000), "day"), path)
    sketches.keep(sketches.sketch(rows(spark, 10000, 10500), "day"), path)
    lines = sketches.kept(spark, path).where("column_name = 'id'")
    assert sorted((r.part, r.row_count) for r in lines.collect()) == [("0", 10000), ("1", 500)]


def test_the_audit_finds_a_stale_part(spark):
    df = rows(spark, 0, 20000)
    found = sketches.merged_profile(sketches.sketch(df.where("day = '0'"), "day"), "t")
    audit = {r.column_name: r for r in sketches.audited(found, df).collect()}
    assert not audit["id"].counts_equal and not audit["id"].unique_in_bound and not audit["word"].top_in_bound


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None), (None, "a"), ("p", None)], "day string, v string")
    got = {r.column_name: r for r in sketches.merged_profile(sketches.sketch(df, "day"), "t").collect()}
    assert (got["v"].row_count, got["v"].missing_count, got["v"].unique_count) == (3, 2, 1)
    assert [v.asDict() for v in got["v"].top_values] == [{"value": "a", "rows": 1}]
    assert sketches.merged_profile(sketches.sketch(df.limit(0), "day"), "t").count() == 0
