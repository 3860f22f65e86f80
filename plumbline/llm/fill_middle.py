"""Fill-in-the-middle: texts cut into prefix, middle and suffix at unit borders that a Fenwick tree over blocks finds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import Query, body, col, in_batches, table

#: Production parameters: seed of the draws, per cent of texts that are cut, and per cent of those whose suffix leads.
SEED, CUT, SUFFIX_FIRST = 42, 50, 80
#: Marks of prefix, suffix and middle; a text that holds one stays plain.
MARKS = ("<P>", "<S>", "<M>")
#: Bytes of a block.
BLOCK = 4096

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


class Units:
    """Units of a text in UTF-8: white space with the word behind it, and white space at the end.

    A unit ends where a word ends, and at the end of the text. Two Fenwick trees over blocks of ``BLOCK`` bytes hold the
    numbers of unit ends and of code points, so a cut needs one descent and a look into one block.
    """

    def __init__(self, text: np.ndarray, block: int = BLOCK):
        white = _WHITE[text]
        self.block, self.ends = block, ~white
        if len(text):
            self.ends[:-1] &= white[1:]
            self.ends[-1] = True
        self.begins = (text & 0xC0) != 0x80
        starts = np.arange(0, len(text), block)
        self.units, self.points = (
            self._tree(np.add.reduceat(x, starts, dtype=np.int64) if len(text) else starts) for x in (self.ends, self.begins))
        self.n = int(np.count_nonzero(self.ends))

    @staticmethod
    def _tree(counts: np.ndarray) -> list[int]:
        tree = [0, *counts.tolist()]
        for i in range(1, len(tree)):
            above = i + (i & -i)
            if above < len(tree):
                tree[above] += tree[i]
        return tree

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points of the first ``k`` units."""
        if k == 0:
            return 0, 0
        at = points = 0
        for step in (1 << b for b in reversed(range(len(self.units).bit_length()))):
            if at + step < len(self.units) and self.units[at + step] < k:
                at += step
                k -= self.units[at]
                points += self.points[at]
        low = at * self.block
        end = low + int(np.flatnonzero(self.ends[low:low + self.block])[k - 1]) + 1
        return end, points + int(np.count_nonzero(self.begins[low:end]))


def transformed(text: bytes, key: str, seed: int, cut: int, suffix_first: int, marks: tuple[str, ...]) -> tuple:
    """``n``, form, code points of prefix and middle, and the output."""
    units = Units(np.frombuffer(text, np.uint8))
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i:i + 4]) for i in (0, 4, 8, 12))
    p, s, m = (x.encode() for x in marks)
    if not text or h3 % 100 >= cut or p in text or s in text or m in text:
        return units.n, "plain", None, None, text
    first, last = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    (a, before), (b, until) = units.cut(first), units.cut(last)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return units.n, "spm", before, until - before, b"".join((s, suffix, p, prefix, m, middle))
    return units.n, "psm", before, until - before, b"".join((p, prefix, s, suffix, m, middle))


def filled(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, cut: int = CUT,
    suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = MARKS, carry: list[str] | None = None,
) -> DataFrame:
    """The columns of ``carry`` (all if not given) with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    One pass in Arrow batches without shuffle; what is drawn depends on the id alone, so repeated ids draw alike and reruns
    agree. A null text counts as empty, and empty texts are plain with no unit; a null id counts as the empty text in the
    draw. A text of white space only is one unit. A text may be longer than a batch: it is cut in linear time. Columns of
    the input that clash with the results give way to them. An empty table gives an empty result.
    """
    carry = [c for c in carry or docs.columns if c.lower() not in _ADDED]
    key = F.coalesce(col(id_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[col(c).alias(c) for c in carry]).alias("row"), key.alias("key"), body(text_col).alias("text"))
    out = rows.select("row").schema
    for name, kind in zip(_ADDED, ("long", "string", "long", "long", "string"), strict=True):
        out = out.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [
                transformed(t.as_buffer().to_pybytes(), k.as_py(), seed, cut, suffix_first, marks)
                for k, t in zip(b["key"], b["text"], strict=True)]
            n, form, before, middle, text = zip(*made, strict=True) if made else ((),) * 5
            columns = [b["row"], pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()),
                       pa.array(middle, pa.int64()), pa.array(text, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["row", *_ADDED])

    return in_batches(rows, run, out).select("row.*", *_ADDED)


def restored(form: Column, output: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The exact text from a form and an output; the marks cannot occur in its parts."""
    p, s, m = map(F.lit, marks)

    def parts(first: Column, second: Column) -> tuple[Column, Column, Column]:
        low, high = F.position(second, output), F.position(m, output)
        a = F.substring(output, F.length(first) + 1, low - 1 - F.length(first))
        b = F.substring(output, low + F.length(second), high - low - F.length(second))
        return a, b, F.substring(output, high + F.length(m), F.length(output))

    psm, spm = parts(p, s), parts(s, p)
    return F.when(form == "psm", F.concat(psm[0], psm[2], psm[1])).when(
        form == "spm", F.concat(spm[1], spm[2], spm[0])).otherwise(output)


def op12(spark: SparkSession, folder: str) -> DataFrame:
    made = filled(table(spark, folder, "documents").select("doc_id", "text"), carry=["doc_id"])
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


SQL = rf"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
drawn AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n,
         ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= {CUT} THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM units),
parts AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:least(x, y)], ''), '') AS a,
         coalesce(array_to_string(u[least(x, y) + 1:greatest(x, y)], ''), '') AS b,
         coalesce(array_to_string(u[greatest(x, y) + 1:n], ''), '') AS c
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
       sha256(CASE form WHEN 'spm' THEN '<S>' || c || '<P>' || a || '<M>' || b
                        WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""

QUERY = Query("op12_fill_in_middle", op12, SQL)
