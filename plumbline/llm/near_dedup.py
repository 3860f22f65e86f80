"""Near-duplicates by shared word shingles: SimHash fingerprints compared within blocks find the pairs, their exact sets decide."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from plumbline.llm.common import in_batches, packed, stored
from plumbline.llm.simhash import distance, long_fingerprint

#: Production parameters: words of a shingle, and the Jaccard similarity of two sets of shingles from which texts are near.
SHINGLE, SIMILARITY = 5, 0.8
#: Blocks of a text and minima of hashes that name one: two texts of similarity s share one with probability
#: 1 - (1 - s^ROWS)^BANDS, 0.998 at 0.8. Pieces of a SimHash, as ``simhash`` has them, would not do: texts of similarity 0.8 differ
#: in 15 % of its bits.
BANDS, ROWS = 20, 6
#: Words of 64 bits of a text's SimHash, and the bits in which two texts of a block may differ, also for sets of fewer than FEW
#: shingles. At similarity 0.8 the means are 153 and, for the least sets, 191, the standard deviations 12.
WORDS, RADIUS, WIDE, FEW = 16, 200, 260, 20
#: Texts of a block at most that all others of the block are compared with in one round.
WIDEST = 512

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_RANDOM = np.random.default_rng(42).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
_FLIP, _FACTOR = _RANDOM[0], _RANDOM[1] | np.uint64(1)


def shingles(text: bytes, shingle: int = SHINGLE) -> set[bytes]:
    """The different runs of words of a text in UTF-8, words split and lower-cased as in ``simhash``; a short text is one run."""
    words = text.translate(_LOWER).split()
    return {b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()


def hashes(found: set[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


def bands(h: np.ndarray) -> list[int]:
    """The blocks of a set of hashes, signed: each a hash of the minima of ``ROWS`` permutations of them."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(h), 1024):
        np.minimum(least, ((h[at:at + 1024, None] ^ _FLIP) * _FACTOR).min(axis=0), out=least)
    keys = [xxhash.xxh64_intdigest(least[i * ROWS:(i + 1) * ROWS].tobytes(), i) for i in range(BANDS)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def similar(a: set[bytes], b: set[bytes]) -> bool:
    """Whether two sets are near; two empty ones are."""
    common = len(a & b)
    return common >= SIMILARITY * (len(a) + len(b) - common)


def _near(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``no`` of the rows of ``pairs`` (no, head) whose texts are near."""
    own = pairs.join(texts, "no")
    both = own.join(texts.select(F.col("no").alias("head"), F.col("text").alias("head_text")), "head")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, head = None, set()
        for b in batches:
            kept = []
            for no, h, text, other in zip(b["no"].to_pylist(), b["head"].to_pylist(), b["text"], b["head_text"], strict=True):
                if h != last:
                    last, head = h, shingles(other.as_py())
                if similar(shingles(text.as_py()), head):
                    kept.append(no)
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64())], ["no"])

    return in_batches(both.select("no", "head", "text", "head_text"), run, "no long").distinct()


def without_near(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: Callable[..., DataFrame] | None = None,
) -> DataFrame:
    """The rows of ``docs`` without those that are near one of a smaller id, null ids last.

    Texts whose shingles share minima form a block. In each round the first rows of a block are compared with all behind them by their
    SimHash, in the condition of a join, so that only pairs within the radius are ever rows; the sets of these are compared
    exactly, and rows that are near go. The first rows then leave the block and the rest of it goes on, until blocks are
    used up. So every two rows that stay and share a block have been compared, a block of m copies makes m pairs, texts that are
    alike but not near make none, and nothing goes on the strength of fingerprints alone. Null texts count as empty; ids may repeat.
    ``classes`` is ``simhash.near_classes`` or the like; the texts of each of its components form a block too.
    """
    whole = packed(docs, id=id_col).select("row", "id", F.monotonically_increasing_id().alias("no"))
    body = F.coalesce(F.col("row").getField(text_col), F.lit("")).cast("binary")
    out = whole.schema.add("bands", ArrayType(LongType())).add("size", "long").add("bits", ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, bits = [], [], []
            for t in b["text"]:
                h = hashes(shingles(t.as_py()))
                keys.append(bands(h))
                sizes.append(len(h))
                bits.append(long_fingerprint(h, WORDS))
            yield pa.RecordBatch.from_arrays(
                [b["row"], b["id"], b["no"], pa.array(keys, pa.list_(pa.int64())), pa.array(sizes, pa.int64()), pa.array(bits, pa.list_(pa.int64()))],
                ["row", "id", "no", "bands", "size", "bits"])

    rows = stored(in_batches(whole.withColumn("text", body), run, out), "bands")
    own = F.struct(F.col("id").isNull().alias("last"), "id", "no").alias("own")
    keys = rows.select(F.explode("bands").alias("key"), own, "size", *[F.col("bits")[i].alias(f"w{i}") for i in range(WORDS)])
    columns = keys.columns[1:]
    if classes:
        found = classes(rows.select("no", body.alias("text")), "no", "text", carry=["no"])
        single = rows.select("no", own, "size", *[F.col("bits")[i].alias(f"w{i}") for i in range(WORDS)])
        keys = keys.unionAll(found.select("no", F.xxhash64(F.lit("class"), "component").alias("key")).join(single, "no").select("key", *columns))
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = stored(keys.join(sizes, "key").select("key", *columns), "blocks")
    texts = stored(rows.join(blocks.select("own.no").distinct(), "no", "left_semi").select("no", body.alias("text")), "candidates")
    gone, width = texts.select("no").limit(0), 1
    while not blocks.isEmpty():
        place = F.row_number().over(Window.partitionBy("key").orderBy("own"))
        heads = blocks.withColumn("place", place).filter(F.col("place") <= width).select(
            F.col("key").alias("head_key"), *[F.col(c).alias(f"head_{c}") for c in columns])
        heads = stored(heads, "heads")
        least = F.least("size", "head_size")
        # Sets of s and more elements share s at most, so sizes alone rule out many.
        alike = (F.col("key") == F.col("head_key")) & (F.col("head_own") < F.col("own")) & (least >= SIMILARITY * F.greatest("size", "head_size")) & (
            distance(*[[F.col(f"{side}w{i}") for i in range(WORDS)] for side in ("", "head_")]) <= F.when(least < FEW, WIDE).otherwise(RADIUS))
        pairs = blocks.join(heads, alike).select(F.col("own.no").alias("no"), F.col("head_own.no").alias("head")).distinct()
        found = stored(_near(pairs, texts), "near")
        gone = gone.unionAll(found)
        last = heads.groupBy(F.col("head_key").alias("key")).agg(F.max("head_own").alias("last"))
        left = blocks.join(last, "key").filter(F.col("own") > F.col("last")).drop("last").withColumn("no", F.col("own.no")).join(
            found, "no", "left_anti")
        sizes = left.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
        blocks = stored(left.join(sizes, "key").select("key", *columns), "blocks")
        width = min(2 * width, WIDEST)
    return rows.join(gone, "no", "left_anti").select("row.*")
