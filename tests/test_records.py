"""CSV records with line breaks inside values, cut at any split."""

import csv
import io
import random

import pytest

from plumbline.sources.records import csv_records
from plumbline.sources.tables import read_csv


def values(rng):
    # Pieces that a splitter could take for structure.
    pieces = ["a", "bc ", " ", ",", '"', '""', "\n", "\r\n", '",\n', '"\n"', "é", "x" * 40]
    return "k" + "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 9)))


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


@pytest.mark.parametrize("size", [67, 211, 1 << 20])
def test_breaks_and_quotes_across_splits(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    want = []
    for part in range(2):
        rows = [(f"{part}-{i}", values(rng), values(rng)) for i in range(20)]
        rows.append((f"{part}-long", "k" + '"\n,' * 40, "kz"))
        rng.shuffle(rows)
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n")
        writer.writerows([("id", "first\nname", "b"), *rows])
        (tmp_path / f"{part}.csv").write_text(out.getvalue(), newline="")
        want += rows
    small_splits(size)
    df = read_csv(spark, str(tmp_path))
    assert df.columns == ["id", "first\nname", "b"]
    assert sorted(map(tuple, df.collect())) == sorted(want)
    # The way for too many splits to send to all tasks gives the same records.
    sent, joined = (sorted(map(tuple, csv_records(spark, str(tmp_path), n).collect())) for n in (1000, 0))
    assert sent == joined and len(sent) == len(want)
    if size < 100:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4


def test_stray_quotes_carriage_returns_and_blank_records(spark, tmp_path, small_splits):
    text = 'id,t\r\n1,5" pipe\r\n2,"a\r\nb"\r\n\r\n3,\r\n4,"x ""y"""\r\n5,"never closed\r\n6,z'
    (tmp_path / "t.csv").write_bytes(text.encode())
    for size in (9, 1 << 20):
        small_splits(size)
        records = [r.record for r in csv_records(spark, str(tmp_path / "t.csv")).orderBy("block", "line").collect()]
        assert records == ['1,5" pipe', '2,"a\r\nb"', "3,", '4,"x ""y"""', '5,"never closed\r\n6,z']
    got = {r.id: r.t for r in read_csv(spark, str(tmp_path / "t.csv")).collect()}
    assert got["1"] == '5" pipe' and got["2"].replace("\r\n", "\n") == "a\nb" and got["3"] is None and got["4"] == 'x "y"'


def test_empty_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,t\n")
    df = read_csv(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["id", "t"] and df.count() == 0
