"""Byte-pair encoding and decoding with a given vocabulary file."""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from plumbline.llm.common import Query, body, col, in_batches, table

#: The code points with the Unicode property White_Space.
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: At most so many words are remembered, until the end of a task, and none longer than this.
REMEMBERED, LONGEST = 800_000, 48
#: Characters that are encoded before a batch of results is handed on.
HANDED_ON = 4_000_000


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes for the characters from U+0100 on, in turn.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Vocabulary:
    """A vocabulary file of the kind: NFC, white space dropped, lower case, words with an end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.names = {i: s for s, i in chain(self.ids.items(), special.items())}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # By two ids of 16 bits or more each, a rank in the upper half of a number whose lower half takes a place.
        self.bits = max(16, len(self.ids).bit_length())
        self.rank = {(self.ids[a] << self.bits) | self.ids[b]: n << 32 for n, (a, b) in enumerate(pairs)}
        self.made = [self.ids[a + b] for a, b in pairs]
        letters = byte_letters()
        self.inner = [self.ids.get(c) for c in letters]
        self.last = [self.ids.get(c + self.suffix) for c in letters]
        splits = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(splits.replace(r"\s", SPACES)).findall
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split if special else None
        self.at_space = regex.compile(f"[{SPACES}]+").split
        self.odd = regex.compile("[\x1c-\x1f]").search
        self.known = _Known(self)

    def merged(self, word: str) -> list[int]:
        """The ids of one word.

        The symbols form a doubly linked list. A queue holds the rank and place of each pair that can be merged,
        lowest rank first, leftmost first among equals. A merge joins the symbol with its successor and queues
        the two pairs that it creates. Entries whose pair has changed meanwhile are stale and are skipped.
        """
        raw = word.encode()
        s = [self.inner[b] for b in raw]
        s[-1] = self.last[raw[-1]]
        if None in s:
            s = [x for x in s if x is not None]
        n = len(s)
        if n < 2:
            return s
        get, made, bits = self.rank.get, self.made, self.bits
        queue = [r + i for i, (a, b) in enumerate(pairwise(s)) if (r := get(a << bits | b)) is not None]
        heapify(queue)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        s.append(-1)  # stands behind the end and before the beginning, and for symbols merged away; it has no pairs
        while queue:
            x = heappop(queue)
            i = x & 0xFFFFFFFF
            j = after[i]
            if get(s[i] << bits | s[j]) != x - i:
                continue
            a = s[i] = made[x >> 32]
            s[j] = -1
            k = after[i] = after[j]
            before[k] = i
            if (r := get(a << bits | s[k])) is not None:
                heappush(queue, r + i)
            h = before[i]
            if (r := get(s[h] << bits | a)) is not None:
                heappush(queue, r + h)
        return [x for x in s if x >= 0]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text; strings of special tokens inside it become those tokens."""
        parts = self.at_special(text) if self.at_special and "<|" in text else (text,)
        out: list[bytes] = []
        for part in parts:
            if part in self.special:
                out.append(_bytes([self.special[part]]))
                continue
            # Letter by letter, a capital sigma has one lower-case form, also at the end of a word.
            plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            pieces = [c for c in self.at_space(plain) if c] if self.odd(plain) else plain.split()
            out.extend(map(self.known.__getitem__, pieces))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary strings of the ids, joined by a space, as a file without a decoder asks for."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def _bytes(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class _Known(dict):
    """The ids, as bytes, of pieces between white space and of words met so far; forgets all when full."""

    def __init__(self, of: Vocabulary):
        super().__init__()
        self.of = of

    def __missing__(self, piece: str) -> bytes:
        if piece.isalpha():
            ids = _bytes(self.of.merged(piece))
        else:
            ids = b"".join([self[w] if w.isalpha() else _bytes(self.of.merged(w)) for w in self.of.words(piece)])
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns of ``carry`` (by default the id), ``ids`` (array of int) and ``decoded``.

    One pass without shuffle. ``path`` names the vocabulary file, which every executor must have. Texts are encoded
    whole, a null text as the empty one, which has no ids and decodes to the empty text. Ids may be null or repeat.
    """
    carry = [id_col] if carry is None else carry
    keep = docs.select(F.struct(*[col(c).alias(c) for c in carry]).alias("row"), body(text_col).alias("text"))
    out = keep.select("row").schema.add("ids", ArrayType(IntegerType())).add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts, done, ids, held = batch["text"], 0, [], 0
            for i in range(len(texts)):
                text = texts[i].as_py()
                ids.append(v.encode(text))
                held += len(text)
                if held >= HANDED_ON or i == len(texts) - 1:
                    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                    yield pa.RecordBatch.from_arrays(
                        [batch["row"].slice(done, len(ids)), lists,
                         pa.array(map(v.decode, ids), pa.string())], ["row", "ids", "decoded"])
                    done, ids, held = i + 1, [], 0
        # The Python worker keeps the vocabulary for its next task, which may be of another stage; words are up to 200 MB.
        v.known.clear()

    return in_batches(keep, run, out).select("row.*", "ids", "decoded")


def op2(spark: SparkSession, folder: str) -> DataFrame:
    from public_tokenizers import path

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return digests(encoded(docs, path("word_bpe_49k.json")), "doc_id")


def digests(tokens: DataFrame, *keys: str) -> DataFrame:
    return tokens.select(
        *keys, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERY = Query("op2_bpe", op2)
