"""Token counts of whole texts: batches of even size go to the tokenizer, only lengths come back."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.bpe import byte_letters
from plumbline.llm.common import Query, body, col, table

#: Characters of a batch for the tokenizer, and of a part of a long text.
BATCH, PART = 1_000_000, 50_000
#: Longer parts are counted by the library of the file: the backtracking of the faster one gives up on long runs.
LONG = 100_000
#: A text with more tokens is over the limit.
LIMIT = 1024
#: Fixed value: the splitting pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A safe boundary is a single blank between two characters that are no white space. The pattern takes such a blank as
#: the beginning of the next word, and no special token holds a blank, so no token crosses it.
_SAFE = regex.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])").search


def parts(text: str, most: int = PART) -> list[str]:
    """The text in parts of about ``most`` characters that together have as many tokens as the text.

    A stretch without a safe boundary stays whole, however long.
    """
    out, start = [], 0
    while len(text) - start > most and (m := _SAFE(text, start + most)):
        out.append(text[start:m.start()])
        start = m.start()
    return [*out, text[start:]]


@lru_cache(maxsize=2)
def _by_file(path: str):
    """The function of ``_counter`` by the library that reads the JSON file itself."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def _counter(path: str):
    """A function from a list of texts to their numbers of tokens."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    splitting = spec["pre_tokenizer"] or {}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if spec["normalizer"] is None and splitting.get("type") == "ByteLevel" and splitting.get("use_regex") and not splitting.get("add_prefix_space"):
        # The same vocabulary in the faster of two public libraries: ids of such files are the ranks of the merges.
        import tiktoken

        byte = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}
        encode = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special).encode
        allowed = set(special)

        def count(texts: list[str]) -> list[int]:
            return [len(encode(x, allowed_special=allowed, disallowed_special=())) if len(x) <= LONG else _by_file(path)([x])[0] for x in texts]

        return count
    return _by_file(path)


def lengths(texts: list[str], path: str) -> list[int]:
    """Numbers of tokens of the texts; the tokenizer gets batches of about ``BATCH`` characters."""
    count, total = _counter(path), [0] * len(texts)
    batch: list[str] = []
    owners: list[int] = []
    held = 0
    for i, text in enumerate(texts):
        for part in parts(text) if path.endswith(".json") else [text]:
            batch.append(part)
            owners.append(i)
            held += len(part)
            if held >= BATCH:
                for owner, n in zip(owners, count(batch), strict=True):
                    total[owner] += n
                batch, owners, held = [], [], 0
    for owner, n in zip(owners, count(batch) if batch else [], strict=True):
        total[owner] += n
    return total


def counted(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """The id with ``n_bytes``, ``n_tokens`` and ``over_limit``, without shuffle.

    ``path`` names the vocabulary file, which every executor must have. A null text counts as empty: 0 bytes,
    0 tokens. Ids may be null or repeat; every row gets its result. Texts of a model file that is not split by
    a pattern (sentencepiece) are counted in one piece.
    """
    rows = docs.select(col(id_col).alias("id"), body(text_col).alias("text"))
    out = rows.select("id").schema.add("n_bytes", "long").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = pa.array(lengths(b["text"].to_pylist(), path), pa.int64())
            yield pa.RecordBatch.from_arrays([b["id"], pc.binary_length(b["text"]).cast(pa.int64()), counts], ["id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, out).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op4(spark: SparkSession, folder: str) -> DataFrame:
    from public_tokenizers import path

    return counted(table(spark, folder, "documents").select("doc_id", "text"), path("byte_bpe_50k.json"))


QUERY = Query("op4_token_counts", op4)
