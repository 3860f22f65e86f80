"""Secrets in texts: assignments, access keys and hex strings by pattern, other random strings by how badly they tokenise."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from plumbline.llm.common import Query, body, col, in_batches, table

#: Production parameters: least characters of a random string and most characters a token of it.
LEAST, EFFICIENCY = 16, 1.8
KINDS = ("assign", "access", "hex", "random")
SPANS = ArrayType(StructType().add("kind", "string").add("start", "integer").add("end", "integer"))

#: The patterns of the kinds and their least lengths.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
#: Fixed value: a substring of each name of an assignment.
_NAMES = ("passw", "secret", "token", "api")

#: Access keys, hex strings and random strings all lie in such runs.
_RUN = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}}")
_PIECE, _BETWEEN, _SOLE = re.compile(rf"[^/_-]{{{LEAST},}}"), re.compile("[/_-]+"), re.compile(r"[A-Z]?[a-z]{3,}|[A-Z]{4,}")
#: Digests by their lengths in hex digits, digests with their names in front, UUIDs.
_DIGEST = re.compile(
    r"(?:0x)?(?:(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{48}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})"
    r"|(?:[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{48}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128}))"
    r"|(?:md5|sha1|sha224|sha256|sha384|sha512)-[A-Za-z0-9+/]+={0,2}"
    r"|[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")
#: Names and numbers: no digit and no capital behind a small letter, or digits and separators alone.
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|(?:[A-Z]?[a-z]+|[A-Z]+)(?:[/_+-]+(?:[A-Z]?[a-z]+|[A-Z]+))*|[0-9/_+=-]+")


@lru_cache(maxsize=2)
def _encoder(path: str):
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def is_named(run: str) -> bool:
    """Whether a string is a known digest, a name or a number."""
    return bool(_DIGEST.fullmatch(run) or _WORD.fullmatch(run))


def is_random(run: str, path: str, efficiency: float = EFFICIENCY) -> bool:
    """Whether a string has few characters a token and is no known digest, name or number."""
    return not is_named(run) and len(run) <= efficiency * len(_encoder(path)(run))


def spans_of(text: str, path: str, efficiency: float = EFFICIENCY) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all secrets of a text, sorted.

    A random string is a whole run of letters, digits and ``+/_-``, or, where a word stands between ``/``, ``_`` and ``-``
    or the whole is none, a piece between these. Those inside a span of another kind add nothing and are left out.
    """
    out: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    runs = [(m.start(), m[0]) for m in _RUN.finditer(text)]
    for kind, pattern, least in ((1, _ACCESS, LEAST_ACCESS), (2, _HEX, LEAST_HEX)):
        out += [(at + m.start(), kind, at + m.end()) for at, run in runs for m in pattern.finditer(run) if len(m[0]) >= least]
    base = list(out)
    for at, run in runs:
        if is_named(run):
            continue
        whole = not any(map(_SOLE.fullmatch, _BETWEEN.split(run))) and is_random(run, path, efficiency)
        found = [(0, run)] if whole else [(m.start(), m[0]) for m in _PIECE.finditer(run) if is_random(m[0], path, efficiency)]
        for start, piece in found:
            a, b = at + start, at + start + len(piece)
            if not any(x <= a and b <= y for x, _, y in base):
                out.append((a, 3, b))
    return sorted(out)


def scanned(docs: DataFrame, path: str, text_col: str = "text", carry: list[str] | None = None, efficiency: float = EFFICIENCY) -> DataFrame:
    """The columns of ``carry`` (all if not given) with ``spans``: an array of kind, start and end in code points, end exclusive.

    Sorted by start, then by kind in the order of ``KINDS``. ``path`` names a vocabulary of ranks that every executor has.
    One pass in Arrow batches without shuffle, over whole texts. A null text counts as empty and gives an empty array; ids
    play no part, repeated rows get the same spans. A column of the input named ``spans`` gives way.
    """
    carry = [c for c in carry or docs.columns if c.lower() != "spans"]
    rows = docs.select(F.struct(*[col(c).alias(c) for c in carry]).alias("row"), body(text_col).alias("text"))
    out = rows.select("row").schema.add("spans", SPANS)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(t.as_py(), path, efficiency)] for t in b["text"]]
            yield pa.RecordBatch.from_arrays([b["row"], pa.array(found, kind)], ["row", "spans"])

    return in_batches(rows, run, out).select("row.*", "spans")


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias("n_" + kind)


def op11(spark: SparkSession, folder: str) -> DataFrame:
    from public_tokenizers import path

    found = scanned(table(spark, folder, "documents").select("doc_id", "text"), path("byte_bpe_50k.tiktoken"), carry=["doc_id"])
    spans = F.col("spans")
    counts = [number(spans, kind) for kind in KINDS]
    base = F.filter(spans, lambda s: s["kind"] != "random")
    return found.select("doc_id", *counts[:3], F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"), counts[3])


QUERY = Query("op11_secret_scan", op11)
