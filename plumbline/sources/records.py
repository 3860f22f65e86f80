"""Records of CSV files whose quoted values may hold line breaks, cut in parallel.

A line alone does not tell whether it begins inside a quoted value, but it tells how it ends for either beginning. Each task
composes this along its splits for both beginnings. One row per split then settles where the splits begin, and only
lines of records with line breaks are shuffled, to the place where their record begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import fresh_path

# A quoted value without its closing quote, and fields from the start of a record or after a separator up to such a value.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_OPENS = rf'(?:(?:{_QUOTED}"[^,]*+|[^,"][^,]*+)?+,)*+{_QUOTED}\z'
_OPEN_FROM_OUTSIDE = rf"^{_OPENS}"
_OPEN_FROM_INSIDE = rf'^[^"]*+(?:""[^"]*+)*+(?:\z|"[^,]*+,{_OPENS})'

_PLACED = ("file string, block bigint, line bigint, value string, first boolean, inside0 boolean, open0 boolean, start0 bigint, "
           "inside1 boolean, open1 boolean, start1 bigint")
_ENDS = "file string, block bigint, open0 boolean, open1 boolean, last0 bigint, last1 bigint"
#: Splits up to which one row for each is sent to all tasks, some 50 MB; more of them are joined by the optimizer's choice.
BROADCAST_SPLITS = 200_000


def csv_records(spark: SparkSession, path: str, broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """The records of all files of ``path``, without the header record of each file and without blank ones.

    Columns: ``file``, ``block`` and ``line``, which order the records, and the text ``record``. A quote opens a value only
    where the value begins; inside it a quote is doubled. Breaks inside values stay as they are, carriage returns included. A
    value that is never closed takes the rest of its file. An empty file has no record.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")
    quoted = F.instr("value", '"') > 0
    turns = lines.select(
        "*", (quoted & F.col("value").rlike(_OPEN_FROM_OUTSIDE)).alias("open0"),
        (~quoted | F.col("value").rlike(_OPEN_FROM_INSIDE)).alias("open1"))
    # The splits are settled without their texts and kept as a small table, so that both readers below share them.
    folder = fresh_path(spark, "csv-splits")
    _beginnings(turns.drop("value").mapInArrow(_ends, _ENDS)).write.parquet(folder)
    begun = spark.read.parquet(folder)

    # A split that the earlier scan did not see would lose its rows.
    seen = "coalesce(inside, CAST(raise_error('the splits of a file changed between two scans') AS BOOLEAN))"
    if begun.count() <= broadcast_splits:
        # One row per split, few enough for every task: lines know where they begin before they are followed.
        known = turns.join(F.broadcast(begun), ["file", "block"], "left").withColumn("inside", F.expr(seen))
        carried = begun.select("file", "block", "carried")
        placed = known.select(*turns.columns, "inside").mapInArrow(_follow, _PLACED).join(F.broadcast(carried), ["file", "block"])
        lines = placed.selectExpr(
            "file", "block", "line", "value", "first", "carried", "inside0 AS continues", "open0 AS open", "start0 AS start")
    else:
        known = turns.mapInArrow(_follow, _PLACED).join(begun, ["file", "block"], "left").withColumn("__inside", F.expr(seen))
        lines = known.selectExpr(
            "file", "block", "line", "value", "first", "carried", "if(__inside, inside1, inside0) AS continues",
            "if(__inside, open1, open0) AS open", "if(__inside, start1, start0) AS start")
    whole = lines.where("NOT continues AND NOT open").selectExpr("file", "block", "line", "value AS record", "first AS header")
    parts = lines.where("continues OR open").selectExpr(
        "file", "if(start IS NULL, carried, named_struct('block', block, 'line', start)) AS begin",
        "named_struct('block', block, 'line', line, 'value', value) AS part", "first")
    joined = parts.groupBy("file", "begin").agg(F.sort_array(F.collect_list("part")).alias("parts"), F.expr("bool_or(first) AS header"))
    joined = joined.selectExpr(
        "file", "begin.block AS block", "begin.line AS line", "array_join(parts.value, '\n') AS record", "header")
    return whole.unionByName(joined).where("NOT header").select(
        "file", "block", "line", F.regexp_replace("record", r"\r\z", "").alias("record")).where("trim(record) <> ''")


def one_line_each(spark: SparkSession, path: str) -> bool:
    """Whether every line of every file is a whole record: none ends inside a quoted value, is blank or holds a carriage return.

    If no line opens a value that it does not close, every line begins outside of values. Reading ends soon where a line does.
    """
    lines = spark.read.text(path, lineSep="\n")
    opens = (F.instr("value", '"') > 0) & F.col("value").rlike(_OPEN_FROM_OUTSIDE)
    return lines.where((F.trim("value") == "") | F.contains("value", F.lit("\r")) | opens).isEmpty()


class _Splits:
    """The state of the split that a task reads, for both of its beginnings; the first split of a file has but one."""

    def __init__(self) -> None:
        self.split, self.states, self.starts = None, [], []

    def followed(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        """Each run of lines of one split: its bounds, whether the split begins there, and by beginning the state before and
        after every line and the line where its record begins."""
        n = batch.num_rows
        if not n:
            return
        blocks, lines, files = batch["block"].to_numpy(), batch["line"].to_numpy(), batch["file"]
        turns = (blocks[1:] != blocks[:-1]) | pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(turns) + 1).tolist(), n]
        open0, open1 = (batch[c].to_numpy(zero_copy_only=False).astype(bool) for c in ("open0", "open1"))
        for a, b in zip(cuts, cuts[1:]):
            here = (files[a].as_py(), int(blocks[a]))
            if new := here != self.split:
                inside = batch["inside"][a].as_py() if "inside" in batch.schema.names else None
                self.split, self.starts = here, [-1, -1]
                self.states = [False, here[1] > 0] if inside is None else [inside, inside]
            found = []
            for h in (0, 1):
                after = _composed(open0[a:b], open1[a:b], self.states[h])
                before = np.concatenate(([self.states[h]], after[:-1]))
                own = np.maximum.accumulate(np.concatenate(([self.starts[h]], np.where(before, -1, lines[a:b]))))[1:]
                found.append((before, after, own))
                self.states[h], self.starts[h] = bool(after[-1]), int(own[-1])
            yield a, b, new, found

    def end(self) -> dict:
        start0, start1 = (None if s < 0 else s for s in self.starts)
        return {"file": self.split[0], "block": self.split[1], "open0": self.states[0], "open1": self.states[1], "last0": start0, "last1": start1}


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: for both beginnings whether it ends inside a value, and where the last record of it begins."""
    at = _Splits()
    schema = pa.schema({"file": pa.string(), "block": pa.int64(), "open0": pa.bool_(), "open1": pa.bool_(), "last0": pa.int64(), "last1": pa.int64()})
    for batch in batches:
        done, before = [], at.split and at.end()
        for _, _, new, _ in at.followed(batch):
            if new and before:
                done.append(before)
            before = at.end()
        yield pa.RecordBatch.from_pylist(done, schema)
    if at.split:
        yield pa.RecordBatch.from_pylist([at.end()], schema)


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For both beginnings of a split: whether a line begins and ends inside a value, and where its record begins.

    Where the column ``inside`` says how the split begins, both are that one.
    """
    at = _Splits()
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        blocks, lines, files = batch["block"].to_numpy(), batch["line"].to_numpy(), batch["file"]
        first, heads = np.zeros(n, bool), np.zeros(n, bool)
        inside, ends, begins = (np.zeros((2, n), t) for t in (bool, bool, np.int64))
        for a, b, new, found in at.followed(batch):
            heads[a], first[a] = True, new and blocks[a] == 0
            for h in (0, 1):
                inside[h, a:b], ends[h, a:b], begins[h, a:b] = found[h]
        # Lines that go on for both beginnings are put to the line before them; the whole then counts as one line.
        heads |= ~inside.all(axis=0)
        where = np.flatnonzero(heads)
        ends_at = np.append(where[1:], n) - 1
        offsets = pa.array(np.append(where, n), pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(offsets, batch["value"]), "\n")
        columns = [files.take(pa.array(where)), pa.array(blocks[where]), pa.array(lines[where]), texts, pa.array(first[where])]
        for h in (0, 1):
            begun = begins[h, where]
            columns += [pa.array(inside[h, where]), pa.array(ends[h, ends_at]), pa.array(begun, mask=begun < 0)]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PLACED.split(", ")])


def _composed(open0: np.ndarray, open1: np.ndarray, begin: bool) -> np.ndarray:
    """The state after each line: that of the last line which ends one way only, turned by every line since that turns it."""
    turned = np.cumsum(open0 & ~open1)
    settled = np.maximum.accumulate(np.where(open0 == open1, np.arange(len(open0)), -1))
    base = np.where(settled >= 0, open0[settled], begin)
    since = turned - np.where(settled >= 0, turned[settled], 0)
    return base ^ (since % 2 == 1)


def _beginnings(ends: DataFrame) -> DataFrame:
    """For each split whether it begins inside a value, and the place where the record begins that runs into it.

    The windows see one row per split of a file.
    """
    splits = ends.selectExpr("*", "struct(open0, open1) AS e")
    order = "OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND"
    turned = splits.selectExpr("*", f"count_if(e.open0 AND NOT e.open1) {order} CURRENT ROW) AS turned")
    settled = turned.selectExpr(
        "*", f"coalesce(max(turned) {order} 1 PRECEDING), 0L) AS turned_before",
        f"last(CASE WHEN e.open0 = e.open1 THEN struct(e.open0 AS state, turned) END, true) {order} 1 PRECEDING) AS settled")
    begun = settled.selectExpr(
        "*", "(if(coalesce(settled.state, false), 1, 0) + turned_before - coalesce(settled.turned, 0L)) % 2 = 1 AS inside")
    return begun.selectExpr("*", "if(inside, last1, last0) AS own").selectExpr(
        "file", "block", "inside",
        f"last(CASE WHEN own IS NOT NULL THEN struct(block, own AS line) END, true) {order} 1 PRECEDING) AS carried")
