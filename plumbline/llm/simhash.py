"""SimHash near-duplicates: fingerprints, candidate blocks by the pigeonhole principle, bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Query, body, col, in_batches, packed, stored, table
from plumbline.llm.components import components

#: Production parameters.
SHINGLE, RADIUS, SEED = 4, 4, 42
#: A block of candidates with more fingerprints is dealt out further before it is compared.
BLOCK = 4096

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text in UTF-8, as a signed number; 0 without words.

    A bit is 1 if it is set in over half the XXH64 hashes of the text's shingles, repeats included. Bytes are
    split at ASCII white space and only A-Z are lower-cased.
    """
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 65536):
        a, b = starts[at:at + 65536].tolist(), ends[at:at + 65536].tolist()
        h = np.array([digest(joined[x:y], seed) for x, y in zip(a, b, strict=True)], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def long_fingerprint(h: np.ndarray, words: int) -> np.ndarray:
    """The SimHash of a set of shingles, given their hashes, in ``words`` signed numbers of 64 bits each.

    As in ``fingerprint``, a bit is 1 if it is set in over half the hashes; each word has hashes of its own, mixed from the given ones.
    """
    salts = (np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
    counts = np.zeros(64 * words, np.int64)
    for at in range(0, len(h), 4096):
        x = h[at:at + 4096, None] + salts
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        counts += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(h), bitorder="little").view("<i8")


def distance(a: list[Column], b: list[Column]) -> Column:
    """Number of bits in which two long fingerprints differ, given their words."""
    return reduce(Column.__add__, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b, strict=True)])


def fingerprints(docs: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint of the text (null: empty), in one pass."""
    rows = docs.select(*[col(c) for c in keep], body(text_col).cast("binary").alias("text"))
    out = rows.select(*keep).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t.as_py()) for t in b["text"]], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), fp], [*keep, "fp"])

    return in_batches(rows, run, out)


def within(fp: np.ndarray, block: np.ndarray, radius: int = RADIUS, halves: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in ``fp`` (uint64) whose fingerprints differ in at most ``radius`` bits.

    Rows of the same ``block`` must be consecutive; only they are compared, each with those behind it. Where
    ``halves`` is given, rows of half 0 are compared with all and others with those of another half. The bits of all rows are stored as vertical planes, 64 rows
    to a word. For each lag, one pass over the planes updates the distances of all rows to the row that many
    places behind: the distances are bit-sliced counters, two planes at a time go through a full adder, and a
    plane of overflows marks the rows that are beyond the radius. Words in which all rows are beyond it, or have
    no partner, are abandoned as the planes go by.
    """
    n = len(fp)
    digits = max(1, (radius + 1).bit_length())
    start = (1 << digits) - 1 - radius  # the counter overflows at distance radius + 1

    def planes(values: np.ndarray) -> np.ndarray:
        """The values' bits as 64 rows of words; the values are padded to whole words."""
        padded = np.zeros(-(-len(values) // 64) * 64, "<u8")
        padded[:len(values)] = values
        bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")

    def lanes(flags: np.ndarray) -> np.ndarray:
        padded = np.zeros(-(-len(flags) // 64) * 64, bool)
        padded[:len(flags)] = flags
        return np.packbits(padded, bitorder="little").view("<u8")

    own = planes(fp)
    lag = 0
    while (lag := lag + 1) < n:
        partner = block[lag:] == block[:-lag]
        if not partner.any():
            return
        if halves is not None:
            partner &= (halves[lag:] != halves[:-lag]) | (halves[lag:] == 0)
            if not partner.any():
                continue
        alive = lanes(partner)
        at = np.flatnonzero(alive)
        alive = alive[at]
        # Row i + lag under row i: words shifted by whole words and by the remaining bits.
        word, bit = divmod(lag, 64)
        wide = own.shape[1]
        low, high = at + word, at + word + 1
        counters = [np.full(len(at), -1 if start >> d & 1 else 0, np.int64).view("<u8") for d in range(digits)]
        over = ~alive
        for b in range(0, 64, 2):
            diff = []
            for p in (own[b], own[b + 1]):
                other = np.where(low < wide, p[np.minimum(low, wide - 1)], 0)
                if bit:
                    other = other >> np.uint64(bit) | np.where(high < wide, p[np.minimum(high, wide - 1)], 0) << np.uint64(64 - bit)
                diff.append(p[at] ^ other)
            # Full adder: two planes and the lowest digit give that digit anew and one carry.
            x = diff[0] ^ diff[1]
            carry = diff[0] & diff[1] | counters[0] & x
            counters[0] = counters[0] ^ x
            for d in range(1, digits):
                counters[d], carry = counters[d] ^ carry, counters[d] & carry
            over = over | carry
            if b % 8 == 6:
                left = np.flatnonzero(~over)
                if not len(left):
                    break
                if len(left) < 0.7 * len(at):
                    at, over, low, high = at[left], over[left], low[left], high[left]
                    counters = [c[left] for c in counters]
        near = np.unpackbits((~over).view(np.uint8), bitorder="little").reshape(-1, 64)
        w, lane = np.nonzero(near)
        if len(w):
            first = at[w] * 64 + lane
            yield first, first + lag


def _forest(pairs: Iterator[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """For each of n places the least place that the pairs connect it with."""
    label = np.arange(n)
    for a, b in pairs:
        while len(a):
            x, y = label[a], label[b]
            new = x != y
            if not new.any():
                break
            a, b, x, y = a[new], b[new], x[new], y[new]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (further := label[label]).tobytes() != label.tobytes():
                label = further
    return label


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, half, fp) to edges (a, b), at most one for each row."""

    def edges(key: np.ndarray, half: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        block = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
        label = _forest(within(fp.view(np.uint64), block, radius, half if half.any() else None), len(fp))
        moved = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[label[moved]])], ["a", "b"])

    held: list[np.ndarray] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(np.stack([b[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "half", "fp")]))
        size += b.num_rows
        if size < 65536:
            continue
        rows = np.concatenate(held, axis=1)
        # The last block may go on in the next batch; it has at most ``BLOCK`` rows or two dealt-out parts.
        ended = np.flatnonzero(rows[0] != rows[0, -1])
        cut = int(ended[-1]) + 1 if len(ended) else 0
        if cut:
            yield edges(*np.ascontiguousarray(rows[:, :cut]))
        held, size = [rows[:, cut:]], rows.shape[1] - cut
    if size:
        yield edges(*np.ascontiguousarray(np.concatenate(held, axis=1)))


def chunks_for(n: int, radius: int = RADIUS, bits: int = 64) -> list[list[int]]:
    """The masks of bits by which n fingerprints are put into blocks.

    The bits are cut into radius + c pieces. Two fingerprints within the radius agree on at least c of them, so that
    comparing those that agree on some c pieces finds every pair. c is the least for which the c pieces have about
    as many bits as it takes to number the fingerprints.
    """
    want, c = max(1.0, log2(max(n, 2)) + 2), 1
    while c * bits / (radius + c) < want and c < 6:
        c += 1
    edges = [bits * i // (radius + c) for i in range(radius + c + 1)]
    pieces = [list(range(a, b)) for a, b in zip(edges, edges[1:])]
    return [sorted(sum(chosen, [])) for chosen in combinations(pieces, c)]


def _signed(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def keyed(fps: DataFrame, masks: list[list[int]]) -> DataFrame:
    """(key, fp): each fingerprint once for each mask; the key is a hash of the mask's number and the masked bits.

    Two blocks that share a hash by chance are compared as one, which finds nothing wrong and loses nothing.
    """
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)])
    return fps.select(F.explode(keys).alias("key"), "fp")


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK, masks: list[list[int]] | None = None) -> DataFrame:
    """Edges (a, b) that connect all fingerprints of ``fps`` (distinct longs ``fp``) within the radius of each other.

    Not every near pair is an edge, but every near pair is connected by edges; a block of m fingerprints gives fewer
    than m. Blocks of more than ``block`` fingerprints are dealt by a hash into parts of about half that size, and
    every two parts are compared on their own, so that no task ever holds a large block.
    """
    masks = chunks_for(fps.count(), radius) if masks is None else masks
    rows = keyed(fps, masks)
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    many = stored(rows.join(sizes, "key"), "blocks")
    few = many.filter(F.col("n") <= block).select("key", F.lit(0).alias("half"), "fp")
    large = many.filter(F.col("n") > block)
    parts = F.ceil(F.col("n") / (block / 2)).cast("int")
    part = F.pmod(F.xxhash64("fp", F.lit(1)), parts).cast("int")
    # A row of part p goes to all pairs of parts with p. Pairs of one part alone are compared in the pair (p, p).
    dealt = large.withColumns({"parts": parts, "part": part}).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("key"),
        F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2).alias("half"), "fp")
    work = few.unionAll(dealt)
    return work.repartition("key").sortWithinPartitions("key").mapInArrow(
        lambda batches: _compare(batches, radius), "a long, b long")


def near_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, carry: list[str] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """The columns of ``carry`` (all if not given) with ``fingerprint``, ``component_id`` and ``component``.

    Rows are linked if their fingerprints differ in at most ``radius`` bits; ``component_id`` is the least id
    among all rows that links lead to, ``component`` the fingerprint that stands for them. Rows with the same fingerprint count as one until the end, so that
    copies cost nothing. Null texts count as empty; texts without words share the fingerprint zero and are linked
    like others. Null ids never are the least; a component of null ids alone has a null id. Ids may repeat.
    """
    added = ("fingerprint", "component_id", "component")
    carry = [c for c in carry or docs.columns if c.lower() not in added]
    whole = docs.select(F.struct(*[col(c).alias(c) for c in carry]).alias("row"), col(id_col).alias("id"), col(text_col).alias("text"))
    rows = stored(fingerprints(whole, "text", "row", "id"), "fingerprints")
    least = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    found = components(links(least.select("fp"), radius, block))
    rooted = least.join(found, least["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    tops = rooted.filter("root <> fp").groupBy("root").agg(F.min("least").alias("low"))
    own = least.select(F.col("fp").alias("root"), F.col("least").alias("top"))
    tops = tops.join(own, "root").select("root", F.least("low", "top").alias("low"))
    classes = rooted.join(tops, "root", "left").select("fp", F.coalesce("low", "least").alias("component_id"), "root")

    def hexed(c: str) -> Column:
        return F.lpad(F.lower(F.hex(c)), 16, "0")

    return rows.join(classes, "fp").select(
        "row.*", hexed("fp").alias("fingerprint"), "component_id", hexed("root").alias("component"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of each component, that with its least id, with the columns of ``docs``.

    Among rows that repeat that id, or have no id in a component without ids, one stays.
    """
    whole = packed(docs, **{"id": id_col, "text": text_col})
    classes = near_classes(whole, "id", "text", radius, ["row", "id"])
    first = classes.filter(F.col("id").eqNullSafe(F.col("component_id")))
    # Only rows that repeat the least id of a component meet in this window, or rows of one without ids.
    place = F.row_number().over(Window.partitionBy("component").orderBy("fingerprint", F.xxhash64(F.to_json("row"))))
    return first.withColumn("place", place).filter("place = 1").select("row.*")


def op1(spark: SparkSession, folder: str) -> DataFrame:
    return near_classes(table(spark, folder, "documents").select("doc_id", "text"), carry=["doc_id"])


QUERY = Query("op1_simhash", op1)
