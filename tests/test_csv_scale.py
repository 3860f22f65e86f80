"""CSV files and reports of large tables, tested on small ones."""

import pytest
from pyspark.sql import functions as F

from plumbline.sources.records import csv_records, one_line_each
from plumbline.sources.sinks import write_report
from plumbline.sources.tables import read_csv


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("text,plain", [
    ('id,t\n1,a\n2,"b, ""c"""\n3,""\n4,d"e\n5,"f"g"\n6,h,extra\n7\n', True),
    ('id,t\n1,a\n2,"b\nc"\n3,d\n', False),
    ('id,t\r\n1,a\r\n2,b\r\n', False),
    ('id,t\n1,a\n\n2,b\n', False),
    ('id,t\n1,"never closed\n2,b\n', False),
    ('id,t\n', True),
    ('', True),
])
def test_files_of_whole_lines_are_left_to_the_reader(spark, tmp_path, text, plain):
    (tmp_path / "t.csv").write_bytes(text.encode())
    path = str(tmp_path / "t.csv")
    assert one_line_each(spark, path) is plain
    if not text:
        return
    df = read_csv(spark, path)
    assert ("MapInArrow" not in plan(df)) is plain
    parsed = F.from_csv("record", "id STRING, t STRING", {"escape": '"', "mode": "PERMISSIVE"}).alias("row")
    slow = csv_records(spark, path).select(parsed).select("row.*")
    assert sorted(map(str, df.collect())) == sorted(str(r).replace("t=''", "t=None") for r in slow.collect())


def test_csv_reports_are_compressed_and_read_back(spark, tmp_path):
    rows = [(i, text) for i, text in enumerate(['plain', ' blanks ', 'a "quote"', 'two\nlines', '{"a":"b,c"}', "x,y"] * 20)]
    df = spark.createDataFrame(rows, "id INT, text STRING")
    path = write_report(df.repartition(4), str(tmp_path / "rows"), "csv")
    assert {"".join(p.suffixes) for p in (tmp_path / "rows").glob("part-*")} == {".csv.gz"}
    assert sorted((int(r.id), r.text) for r in read_csv(spark, path, na_tokens=()).collect()) == sorted(rows)
    one = write_report(df, str(tmp_path / "one"), "csv", one_file=True)
    assert [p.suffix for p in (tmp_path / "one").glob("part-*")] == [".csv"]
    assert sorted((int(r.id), r.text) for r in read_csv(spark, one, na_tokens=()).collect()) == sorted(rows)
