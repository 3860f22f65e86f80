"""Language-model scores from a hierarchical Pitman-Yor model seated by Gibbs sampling."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import Query, body, bucketed, col, in_batches, remainder, table

#: Production parameters: the strengths of the restaurants (last two bytes of the word before, its last byte, all; below them
#: those of the word before), the sweeps of the sampler before the first sample that counts and the samples that are averaged.
STRENGTHS = (5.0, 20.0, 50.0, 2.0)
BURN_IN, SAMPLES, SEED = 1, 2, 42
#: Tokens of a block of texts, and bytes of text for each slice of the vocabulary.
BLOCK_TOKENS, SLICE_BYTES = 1 << 21, 12_000_000
#: Buckets of the tables kept between the steps, of which Spark allows 100,000; more slices share them.
MOST_BUCKETS = 50_000

#: The end of a text, a token that no word can be.
END = b"\n"
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Restaurants are numbered: 65,536 by the last two bytes of the word before, 256 by its last byte, one for all.
#: Behind them come the counts that the model needs besides and, from WORD, the restaurants of frequent words.
COARSE, ROOT, SIZES, ONCE, TRAINED, WORD = 1 << 16, (1 << 16) + 256, (1 << 16) + 257, (1 << 16) + 258, (1 << 16) + 262, 1 << 17
#: Every word has a restaurant for what follows it. The driver holds the totals of at most this many of them, words
#: that are frequent in a sample of this many bytes of text; those of all others pass between tasks. 0 begins a text.
FREQUENT, FREQUENT_BYTES, RARE = (1 << 16) - 2, 16_000_000, (1 << 16) - 1


def context(word: bytes) -> int:
    """The parent of the restaurant of the token behind ``word``, that of its ending; 0 for the first token of a text."""
    return word[-1] << 8 | (word[-2] if len(word) > 1 else 32)


def _pack(a: np.ndarray) -> bytes:
    """An array as bytes: the first bytes of all numbers, then the second ones and so on, compressed; of hashes, mostly sorted, the differences."""
    if a.dtype == np.uint64:
        a = np.diff(a, prepend=np.uint64(0))
    return a.dtype.char.encode() + zstandard.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes(), 1)


def _unpack(b: bytes) -> np.ndarray:
    kind = np.dtype(b[:1].decode())
    raw = np.frombuffer(zstandard.decompress(b[1:]), np.uint8)
    a = np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).ravel() if len(raw) else np.empty(0, kind)
    return np.cumsum(a, dtype=kind) if kind == np.uint64 else a


def _column(batch: pa.Table | pa.RecordBatch, name: str) -> list:
    return batch.column(name).to_pylist()


def frequent_words(docs: DataFrame, share: float, most: int = FREQUENT) -> dict[bytes, int]:
    """Numbers from 1 of the most frequent words in a share of the texts, told by hashes. They decide where totals are kept, no result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                count.update(w for w in text.as_py().translate(_LOWER).split() if len(w) <= 64)
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], ["word", "n"])

    some = docs.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(min(share, 1.0) * (1 << 20))).select("text")
    top = in_batches(some, run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)
    return {bytes(r.word): i for i, r in enumerate(top.collect(), 1)}


_TOKENS = "kind int, block long, slice int, ids array<{id}>, held array<boolean>, a binary, b binary, c binary, d binary, e binary, f binary"


def tokens(docs: DataFrame, held_out: str, slices: int, block: int = BLOCK_TOKENS, frequent: dict[bytes, int] | None = None) -> DataFrame:
    """Blocks of texts as numbers, from ``docs`` (id, text, held out).

    One row of kind 0 for each block: its ids, their token counts (a) and all tokens as numbers of the block's
    distinct pairs (b). One row of kind 1 for each block and slice of the vocabulary: hashes of its words (a), pairs of
    each word (b), contexts of the pairs (c) and how often the training texts of the block have them (d). A context is the
    word before: its number in ``frequent`` or, of other words, 65,535, with their hashes (e) and endings (f) in the order of the pairs.
    Words are known by XXH64.
    """
    kind = docs.schema["id"].dataType
    known = frequent or {}

    def flush(number: int, ids: list, held: list, lengths: list, local: dict, stream: list) -> Iterator[pa.RecordBatch]:
        words = list(local)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, 0) for w in words), np.uint64, len(words))
        own = hashes % np.uint64(slices)
        order = np.lexsort((hashes, own))
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        numbers = np.array([*(known.get(w, RARE) for w in words), 0], np.int64)
        endings = np.fromiter(map(context, words), np.uint16, len(words))
        a, n = np.concatenate(stream), np.array(lengths)
        before = np.empty(len(a), np.int64)
        before[1:] = a[:-1]
        before[np.cumsum(n) - n] = len(words)  # no word
        pairs, at = np.unique(place[a] << 32 | before, return_inverse=True)
        trained = np.bincount(at, np.repeat(~np.array(held), n), len(pairs)).astype(np.int32)
        rows = [{"kind": 0, "block": number, "slice": None, "ids": ids, "held": held, "a": _pack(n.astype(np.int32)),
                 "b": _pack(at.astype(np.uint32)), **dict.fromkeys("cdef")}]
        word, ahead = pairs >> 32, pairs & 0xFFFFFFFF
        cuts = np.flatnonzero(np.diff(own[order][word].astype(np.int64))) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(pairs)], strict=True):
            present, per = np.unique(word[lo:hi], return_counts=True)
            code = numbers[ahead[lo:hi]]
            rare = ahead[lo:hi][code == RARE]
            rows.append({"kind": 1, "block": number, "slice": int(own[order[present[0]]]), "ids": None, "held": None,
                         "a": _pack(hashes[order[present]]), "b": _pack(per.astype(np.int32)),
                         "c": _pack(code.astype(np.uint16)), "d": _pack(trained[lo:hi]), "e": _pack(hashes[rare]), "f": _pack(endings[rare])})
        yield pa.RecordBatch.from_pylist(rows, schema=shape)

    from pyspark.sql.pandas.types import to_arrow_type

    ddl = _TOKENS.format(id=docs.schema["id"].dataType.simpleString())
    shape = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("slice", pa.int32()), ("ids", pa.list_(to_arrow_type(kind))),
                       ("held", pa.list_(pa.bool_())), *((c, pa.binary()) for c in "abcdef")])

    class Numbers(dict):
        def __missing__(self, w: bytes) -> int:
            self[w] = n = len(self)
            return n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, held, lengths, local, stream, size = [], [], [], Numbers({END: 0}), [], 0
        for batch in batches:
            for i, h, text in zip(_column(batch, "id"), _column(batch, held_out), batch.column("text"), strict=True):
                words = text.as_py().translate(_LOWER).split()
                words.append(END)
                stream.append(np.fromiter(map(local.__getitem__, words), np.int32, len(words)))
                ids.append(i)
                held.append(h)
                lengths.append(len(words))
                size += len(words)
                if size >= block:
                    yield from flush(number, ids, held, lengths, local, stream)
                    number += 1
                    ids, held, lengths, local, stream, size = [], [], [], Numbers({END: 0}), [], 0
        if ids:
            yield from flush(number, ids, held, lengths, local, stream)

    return in_batches(docs, run, ddl)


class _Slice:
    """All trained pairs of the words of a slice and endings, with the index structure of the upper three levels of restaurants."""

    def __init__(self, words: np.ndarray, per: np.ndarray, ctx: np.ndarray):
        self.words, self.per, self.ctx = words, per, ctx.astype(np.int64)
        self.word_of = np.repeat(np.arange(len(words)), per)
        self.pair = self.word_of << 16 | self.ctx
        self.group, self.group_of = np.unique(self.pair >> 8, return_inverse=True)
        self.group_word, self.group_ctx = self.group >> 8, COARSE + (self.group & 0xFF)


class _Pairs:
    """All trained pairs of the words of a slice and words before them, the lowest level.

    ``of`` is the place of a pair's ending in the slice, ``ctx`` the number of the word before: those of frequent words, and behind
    them places in ``rare``, the sorted hashes of all others that come before words of the slice, trained or not.
    """

    def __init__(self, per: np.ndarray, ctx: np.ndarray, n: np.ndarray, rare: np.ndarray):
        self.per, self.ctx, self.n, self.rare = per, ctx.astype(np.int64), n, rare
        self.of = np.repeat(np.arange(len(per)), per)
        self.key = self.of << 32 | self.ctx

    def customers(self, s: _Slice, tables: np.ndarray) -> np.ndarray:
        """The tables of pairs are the customers of the endings."""
        return np.bincount(self.of, tables, len(s.pair)).astype(np.int64)

    def totals(self, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of the restaurants of all words before."""
        size = RARE + len(self.rare)
        return tuple(np.bincount(self.ctx, x, size).astype(np.int64) for x in (self.n, tables))


def _totals(s: _Slice, n: np.ndarray, tf: np.ndarray, tc: np.ndarray, tw: np.ndarray) -> dict[str, list]:
    """Customers and tables of each restaurant, and how many dishes have one and two customers by level."""
    cc, cw = np.bincount(s.group_of, tf, len(s.group)), np.bincount(s.group_word, tc, len(s.words))
    code = np.concatenate([s.ctx, s.group_ctx, np.full(len(s.words), ROOT)])
    customers, tables = np.concatenate([n, cc, cw]), np.concatenate([tf, tc, tw])
    found, at = np.unique(code, return_inverse=True)
    extra = [(SIZES, n.sum(), len(s.words))] + [(ONCE + i, (x == 1).sum(), (x == 2).sum()) for i, x in enumerate((n, cc, cw))]
    return {"code": [*found.tolist(), *(e[0] for e in extra)],
            "customers": [*np.bincount(at, customers).astype(int).tolist(), *(int(e[1]) for e in extra)],
            "tables": [*np.bincount(at, tables).astype(int).tolist(), *(int(e[2]) for e in extra)]}


class Totals:
    """What all restaurants of endings and frequent words hold together: at most 131,328 of them, and a few counts."""

    def __init__(self, rows: list, discounts: tuple[float, ...] | None = None):
        self.c, self.t = np.zeros(ROOT + 1), np.zeros(ROOT + 1)
        self.before = np.zeros((2, RARE))
        extra: dict[int, tuple[int, int]] = {}
        for code, c, t in rows:
            if code <= ROOT:
                self.c[code], self.t[code] = c, t
            elif code >= WORD:
                self.before[:, code - WORD] = c, t
            else:
                extra[code] = (c, t)
        self.tokens, self.vocabulary = extra.get(TRAINED, (0, 0))[0], extra.get(SIZES, (0, 0))[1]
        # The usual estimate from the dishes with one and two customers, kept within the range of a discount.
        levels = [extra.get(ONCE + i, (0, 0)) for i in range(4)]
        self.discounts = discounts or tuple(min(0.95, max(0.1, (a + 0.5) / (a + 2 * b + 1))) for a, b in levels)

    def down(self, code: np.ndarray | int, level: int, c: np.ndarray, t: np.ndarray, above: np.ndarray | float) -> np.ndarray:
        """Predictive probability in restaurants of a level, given that of the restaurants above."""
        d, strength = self.discounts[level], STRENGTHS[level]
        return (c - d * t + (strength + d * self.t[code]) * above) / (strength + self.c[code])

    def behind(self, c: np.ndarray, t: np.ndarray, customers: np.ndarray, tables: np.ndarray, above: np.ndarray) -> np.ndarray:
        """Predictive probability in restaurants of words, given all their customers and tables."""
        d, strength = self.discounts[3], STRENGTHS[3]
        return (c - d * t + (strength + d * tables) * above) / (strength + customers)

    def weight(self, code: np.ndarray | int, level: int) -> np.ndarray:
        """Weight of a new table."""
        return STRENGTHS[level] + self.discounts[level] * self.t[code]


def seat(n: np.ndarray, weight: np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """Tables of n customers for one dish each, seated anew one after the other.

    The first opens a table; the next one opens another with odds of ``weight`` against the customers so far less
    a discount for each of their tables. Once a dish has k customers, k / 16 at a time share the odds.
    """
    t = (n > 0).astype(np.int64)
    k, who = 1, np.flatnonzero(n > 1)
    while len(who):
        step = np.minimum(max(1, k // 16), n[who] - k)
        w = weight[who]
        t[who] += random.binomial(step, w / (w + k - discount * t[who]))
        k += max(1, k // 16)
        who = who[n[who] > k]
    return t


def sweep(s: _Slice, n: np.ndarray, tf: np.ndarray, tc: np.ndarray, tw: np.ndarray, all_: Totals, random: np.random.Generator) -> tuple[np.ndarray, ...]:
    """One Gibbs sweep over the dishes of a slice: each restaurant's customers of a dish leave and are seated anew.

    Their tables are customers of the restaurant above, whose tables go further up. The probability above counts
    the tables of the dish's other restaurants only. Totals of restaurants are those after the sweep before.
    """
    base = 1.0 / (all_.vocabulary + 1)
    cc, cw = np.bincount(s.group_of, tf, len(s.group)), np.bincount(s.group_word, tc, len(s.words))
    root = all_.down(ROOT, 2, cw, tw, base)
    others = cc[s.group_of] - tf
    above = all_.down(s.group_ctx[s.group_of], 1, others, tc[s.group_of] * others / np.maximum(cc[s.group_of], 1), root[s.group_word][s.group_of])
    tf = seat(n, all_.weight(s.ctx, 0) * above, all_.discounts[0], random)
    cc = np.bincount(s.group_of, tf, len(s.group)).astype(np.int64)
    others = cw[s.group_word] - tc
    above = all_.down(ROOT, 2, others, tw[s.group_word] * others / np.maximum(cw[s.group_word], 1), base)
    tc = seat(cc, all_.weight(s.group_ctx, 1) * above, all_.discounts[1], random)
    cw = np.bincount(s.group_word, tc, len(s.words)).astype(np.int64)
    tw = seat(cw, np.full(len(cw), all_.weight(ROOT, 2) * base), all_.discounts[2], random)
    return tf, tc, tw


def sweep_pairs(s: _Slice, f: _Pairs, tables: np.ndarray, seats: tuple[np.ndarray, ...], held: np.ndarray, all_: Totals,
                random: np.random.Generator) -> tuple[np.ndarray, ...]:
    """One Gibbs sweep over all four levels: the pairs' customers are seated anew, their tables go up as in ``sweep``.

    ``held`` are the tables of the restaurants of all words before.
    """
    tf, tc, tw = seats
    n = f.customers(s, tables)
    cc, cw = np.bincount(s.group_of, tf, len(s.group)), np.bincount(s.group_word, tc, len(s.words))
    root = all_.down(ROOT, 2, cw, tw, 1.0 / (all_.vocabulary + 1))
    middle = all_.down(s.group_ctx, 1, cc, tc, root[s.group_word])[s.group_of]
    others = n[f.of] - tables
    above = all_.down(s.ctx[f.of], 0, others, tf[f.of] * others / np.maximum(n[f.of], 1), middle[f.of])
    tables = seat(f.n, (STRENGTHS[3] + all_.discounts[3] * held[f.ctx]) * above, all_.discounts[3], random)
    return tables, *sweep(s, f.customers(s, tables), tf, tc, tw, all_, random)


_STATE = ("slice int, words binary, per binary, ctx binary, pairs binary, before binary, n binary, seats array<binary>, "
          "held array<binary>, code array<int>, customers array<long>, tables array<long>, bucket array<int>, up array<binary>")


def _state(number: int, s: _Slice, f: _Pairs, samples: list[tuple[np.ndarray, ...]], held: list[np.ndarray], bits: int) -> dict:
    """A slice with its seatings; ``held`` are the totals of rare words for all but the last. Those for the last are asked for by ranges of hashes."""
    last, *seats = samples[-1]
    totals = _totals(s, f.customers(s, last), *seats)
    c, t = f.totals(last)
    some = np.flatnonzero(c[:RARE])
    extra = [(TRAINED, f.n.sum(), 0), (ONCE + 3, (f.n == 1).sum(), (f.n == 2).sum()), *zip(some + WORD, c[some], t[some])]
    for name, x in zip(("code", "customers", "tables"), zip(*extra)):
        totals[name] += map(int, x)
    bucket = (f.rare >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(f.rare), np.int64)
    lo = np.flatnonzero(np.concatenate((np.ones(min(1, len(bucket)), bool), bucket[1:] != bucket[:-1])))
    up = [_pack(x[i:j].astype(k)) for i, j in zip(lo, [*lo[1:], len(bucket)]) for x, k in ((f.rare, np.uint64), (c[RARE:], np.int32), (t[RARE:], np.int32))]
    return {"slice": number, "words": _pack(s.words), "per": _pack(s.per.astype(np.int32)), "ctx": _pack(s.ctx.astype(np.uint16)),
            "pairs": _pack(f.per.astype(np.int32)), "before": _pack(f.ctx.astype(np.uint32)), "n": _pack(f.n),
            "seats": [_pack(t.astype(np.int32)) for sample in samples for t in sample], "held": [_pack(x) for x in held],
            **totals, "bucket": bucket[lo].tolist(), "up": up}


def _read(row: dict) -> tuple[_Slice, _Pairs, list[tuple[np.ndarray, ...]], list[np.ndarray]]:
    seats = [_unpack(x).astype(np.int64) for x in row["seats"]]
    return (_Slice(_unpack(row["words"]), _unpack(row["per"]), _unpack(row["ctx"])),
            _Pairs(_unpack(row["pairs"]), _unpack(row["before"]), _unpack(row["n"]),
                   np.concatenate([np.empty(0, np.uint64), *map(_unpack, row["up"][::3])])),
            [tuple(seats[i:i + 4]) for i in range(0, len(seats), 4)], [_unpack(x) for x in row["held"]])


def _told(state: DataFrame) -> DataFrame:
    """To every slice and range of hashes the customers (c) and tables (t) of its rare words before in all slices, in the slice's order."""
    asked = state.select("slice", F.posexplode("bucket").alias("i", "bucket"), "up").select(
        "slice", "bucket", *[F.col("up")[F.col("i") * 3 + k].alias(name) for k, name in enumerate("hct")])

    def run(key: tuple, asked: pa.Table) -> pa.Table:
        h, c, t = ([_unpack(x) for x in _column(asked, name)] for name in "hct")
        _, at = np.unique(np.concatenate(h), return_inverse=True)
        cuts = np.cumsum([len(x) for x in h])[:-1]
        told = [[_pack(p.astype(np.int32)) for p in np.split(np.bincount(at, np.concatenate(x))[at], cuts)] for x in (c, t)]
        return pa.Table.from_arrays([asked["slice"], asked["bucket"], pa.array(told[0], pa.binary()), pa.array(told[1], pa.binary())], ["slice", "bucket", "c", "t"])

    return asked.groupBy("bucket").applyInArrow(run, "slice int, bucket int, c binary, t binary")


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("key", F.col("slice").cast("long"))


def _renewed(first: DataFrame, swept: DataFrame) -> DataFrame:
    """The state after a sweep, of which only seatings and totals are new: of rare words, the tables. Both are in buckets by slice."""
    fixed = first.select("key", "slice", "words", "per", "ctx", "pairs", "before", "n", "bucket", "up")
    return fixed.join(swept, "key").withColumn("up", F.expr("transform(up, (x, i) -> if(i % 3 = 2, new[int(i / 3)], x))")).drop("new")


def _joined(buckets: list[int], parts: list[bytes]) -> np.ndarray:
    """The totals of a slice's rare words from the parts told to it."""
    return np.concatenate([np.empty(0, np.int32), *(_unpack(x) for _, x in sorted(zip(buckets, parts)))])


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()),
             "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in ddl.split(", "))])


def _contexts(code: np.ndarray, rare: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Numbers of contexts from their codes and the hashes of the rare ones, given all hashes in order."""
    ctx = code.astype(np.int64)
    ctx[code == RARE] = RARE + np.searchsorted(rare, hashes)
    return ctx


def _merger(endings: np.ndarray, bits: int):
    """The pairs of a slice from all blocks, each dish at first with one table in each restaurant."""

    def run(key: tuple, pieces: pa.Table) -> pa.Table:
        words = [np.repeat(_unpack(a), _unpack(b)) for a, b in zip(_column(pieces, "a"), _column(pieces, "b"), strict=True)]
        code, n, hashes, ends = (np.concatenate([_unpack(x) for x in _column(pieces, name)]) for name in "cdef")
        rare, first = np.unique(hashes, return_index=True)
        ctx, k, w = _contexts(code, rare, hashes), n.astype(np.int64), np.concatenate(words)
        e = np.concatenate([endings, ends[first]])[ctx].astype(np.int64)
        w, e, ctx, k = (x[k > 0] for x in (w, e, ctx, k))
        order = np.lexsort((ctx, e, w))
        w, e, ctx, k = (x[order] for x in (w, e, ctx, k))

        def changes(*columns: np.ndarray) -> np.ndarray:
            return np.flatnonzero(np.concatenate((np.ones(min(1, len(w)), bool), np.any([x[1:] != x[:-1] for x in columns], axis=0))))

        first = changes(w, e, ctx)
        k = np.add.reduceat(k, first) if len(first) else k
        w, e, ctx = w[first], e[first], ctx[first]
        pair = changes(w, e)
        own, per = np.unique(w[pair], return_counts=True)
        s = _Slice(own, per, e[pair])
        f = _Pairs(np.diff(pair, append=len(w)), ctx, k, rare)
        one = tuple(np.ones(m, np.int64) for m in (len(k), len(pair), len(s.group), len(own)))
        return pa.Table.from_pylist([_state(key[0].as_py(), s, f, [one], [], bits)], schema=_arrow(_STATE))

    return run


def _gathered(state: DataFrame, discounts: tuple[float, ...] | None = None) -> Totals:
    sums = state.select(F.explode(F.arrays_zip("code", "customers", "tables")).alias("x")).select("x.*")
    return Totals(sums.groupBy("code").agg(F.sum("customers"), F.sum("tables")).collect(), discounts)


_ANSWER = "block long, slice int, score binary, known binary, per binary"


def _answers(totals: list[Totals], endings: np.ndarray):
    """For each block's pairs of a slice: log10 of the averaged predictive probability, and counts of the words."""

    def run(key: tuple, states: pa.Table, asked: pa.Table) -> pa.Table:
        s, f, samples, held = _read(states.to_pylist()[0])
        told = [r for r in asked.select(["block", "a", "b"]).to_pylist() if r["block"] < 0]
        customers, last = (_joined([-r["block"] for r in told], [r[x] for r in told]) for x in "ab")
        samples, held = samples[-len(totals):], [*held, last][-len(totals):]
        word_count = np.bincount(s.word_of, np.bincount(f.of, f.n, len(s.pair)), len(s.words)).astype(np.int64)

        def place(sorted_: np.ndarray, wanted: np.ndarray) -> np.ndarray:
            """Where the wanted values stand, -1 where they don't."""
            at = np.searchsorted(sorted_, wanted)
            at[at == len(sorted_)] = 0
            return np.where(sorted_[at] == wanted, at, -1) if len(sorted_) else np.full(len(wanted), -1)

        def of(values: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(at >= 0, values[at], 0) if len(values) else np.zeros(len(at))

        levels = []
        for all_, (t, tf, tc, tw), tables in zip(totals, samples, held, strict=True):
            levels.append((all_, t, f.customers(s, t), tf, np.bincount(s.group_of, tf, len(s.group)), tc, np.bincount(s.group_word, tc, len(s.words)), tw,
                           np.concatenate([all_.before[0], customers]), np.concatenate([all_.before[1], tables])))
        out = []
        for number, a, b, *rest in zip(*(_column(asked, x) for x in ("block", "a", "b", "c", "e", "f")), strict=True):
            if number < 0:
                continue
            per, (code, hashes, ends) = _unpack(b), map(_unpack, rest)
            ctx = _contexts(code, f.rare, hashes)
            ending = np.empty(len(code), np.int64)
            ending[code == RARE], ending[code != RARE] = ends, endings[code[code != RARE]]
            found = place(s.words, _unpack(a))
            word = np.repeat(found, per)
            key_ = np.where(word >= 0, word << 16 | ending, -1)
            fine, coarse = place(s.pair, key_), place(s.group, np.where(word >= 0, key_ >> 8, -1))
            pair = place(f.key, np.where(fine >= 0, fine << 32 | ctx, -1))
            p = np.zeros(len(ctx))
            for all_, t, n, tf, cc, tc, cw, tw, c, held_ in levels:
                root = all_.down(ROOT, 2, of(cw, word), of(tw, word), 1.0 / (all_.vocabulary + 1))
                middle = all_.down(COARSE + (ending >> 8), 1, of(cc, coarse), of(tc, coarse), root)
                above = all_.down(ending, 0, of(n, fine), of(tf, fine), middle)
                p += all_.behind(of(f.n, pair), of(t, pair), c[ctx], held_[ctx], above)
            out.append({"block": number, "slice": key[0].as_py(), "score": _pack(np.log10(p / len(totals)).astype(np.float32)),
                        "known": _pack(of(word_count, found).astype(np.int64)), "per": b})
        return pa.Table.from_pylist(out, schema=_arrow(_ANSWER))

    return run


def _hearing(answer):
    """``answer`` for states that bring what ranges of hashes told them: these are rows of negative numbers among the blocks."""

    def run(key: tuple, states: pa.Table, asked: pa.Table) -> pa.Table:
        told = states["told"][0].as_py() or []
        rows = [{"block": -1 - r["bucket"], "a": r["c"], "b": r["t"]} for r in told]
        return answer(key, states.drop_columns("told"), pa.concat_tables([asked, pa.Table.from_pylist(rows, schema=asked.schema)]))

    return run


def _summed(all_: Totals, id_type: pa.DataType):
    """The scores of the texts of a block from the answers of all slices."""
    shape = pa.schema([("id", id_type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                       ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(key: tuple, block: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("slice")
        score = np.concatenate([_unpack(x) for x in _column(answers, "score")]).astype(np.float64)
        counts = np.concatenate([np.repeat(_unpack(k), _unpack(p)) for k, p in zip(_column(answers, "known"), _column(answers, "per"), strict=True)])
        base = np.log10((counts + 1) / (all_.tokens + all_.vocabulary + 1))
        row = block.to_pylist()[0]
        lengths, at = _unpack(row["a"]).astype(np.int64), _unpack(row["b"])
        starts = np.cumsum(lengths) - lengths
        return pa.Table.from_arrays([
            pa.array(row["ids"], id_type), pa.array(row["held"]), pa.array(lengths),
            pa.array(np.add.reduceat((counts > 0).astype(np.int64)[at], starts)),
            pa.array(np.full(len(lengths), int(all_.tokens))),
            pa.array(np.add.reduceat(base[at], starts)), pa.array(np.add.reduceat(score[at], starts))], schema=shape)

    return run


def scored(docs: DataFrame, id_col: str, text_col: str, held_out: Column, burn_in: int = BURN_IN, samples: int = SAMPLES, seed: int = SEED,
           block: int = BLOCK_TOKENS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per row the id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    A token's restaurant is that of the whole word before; its parent is that of this word's last two bytes, whose parent is that
    of its last byte, whose parent is that of all tokens, and above that every word is equally likely. All training tokens are
    customers. Texts become numbers block by block; a slice of the vocabulary holds all pairs that end in its words, so a frequent
    word costs as much as it has different words before it. Slices are seated on their own and exchange only the totals of the
    restaurants, after every sweep: those of endings and of at most 65,534 frequent words by the driver, those of all other words by
    tasks for ranges of their hashes. Probabilities are averaged over ``samples`` seatings after ``burn_in`` sweeps.

    Null texts count as empty and consist of their end. Ids may be null or repeat. Without training texts all tokens are
    equally likely; an empty table gives an empty result. A seed and the same files give the same result.
    """
    rows = docs.select(col(id_col).alias("id"), held_out.alias("held"), body(text_col).cast("binary").alias("text"))
    total = docs.select(F.sum(F.octet_length(body(text_col)))).first()[0] or 0
    slices = 1 + total // slice_bytes
    frequent = frequent_words(rows, FREQUENT_BYTES / max(total, 1))
    endings = np.zeros(RARE, np.uint16)
    endings[1:len(frequent) + 1] = [context(w) for w in frequent]
    # One shuffle brings the pieces of a slice together, and each block to a bucket; from here on only totals and answers are shuffled.
    buckets = min(slices, MOST_BUCKETS)
    numbers = bucketed(tokens(rows, "held", slices, block, frequent).withColumn("key", F.coalesce(F.col("slice").cast("long"), "block")),
                       "tokens", "key", buckets)
    asked = numbers.filter("kind = 1").select("key", "block", *"abcdef")
    # A task for rare words serves about as many numbers as one for a slice.
    bits = max(0, (slices // 8).bit_length() - 1)
    first = state = bucketed(_keyed(asked.groupBy("key").applyInArrow(_merger(endings, bits), _STATE)), "slices", "key", buckets, True)
    totals = [_gathered(state)]
    discounts = totals[0].discounts
    for i in range(burn_in + samples):
        swept = bucketed(_keyed(state.drop("code", "customers", "tables", "bucket").groupBy("key").cogroup(_keyed(_told(state)).groupBy("key")).applyInArrow(
            _sweeper(totals[-1], (seed, i), i > burn_in, bits), _STATE)).select(
            "key", "seats", "held", "code", "customers", "tables", F.expr("filter(up, (x, i) -> i % 3 = 2)").alias("new")), "seating", "key", buckets, True)
        totals.append(_gathered(swept, discounts))
        state = _renewed(first, swept)
    told = _keyed(_told(state)).groupBy("key").agg(F.collect_list(F.struct("bucket", "c", "t")).alias("told"))
    answers = state.drop("code", "customers", "tables", "bucket").join(told, "key", "left").groupBy("key").cogroup(
        asked.select("key", "block", *"abcef").groupBy("key")).applyInArrow(_hearing(_answers(totals[-samples:], endings)), _ANSWER)
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = rows.schema["id"].dataType
    out = (f"id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")
    return numbers.filter("kind = 0").select("key", "ids", "held", "a", "b").groupBy("key").cogroup(
        answers.groupBy("block")).applyInArrow(_summed(totals[-1], to_arrow_type(id_type)), out).withColumnRenamed("id", id_col)


def _sweeper(all_: Totals, seed: tuple[int, ...], keep: bool, bits: int):
    def run(key: tuple, states: pa.Table, told: pa.Table) -> pa.Table:
        s, f, before, held = _read(states.to_pylist()[0])
        last = _joined(_column(told, "bucket"), _column(told, "t"))
        tables, *seats = before[-1]
        new = sweep_pairs(s, f, tables, seats, np.concatenate([all_.before[1], last]), all_, np.random.default_rng([*seed, key[0].as_py()]))
        kept = (before, [*held, last]) if keep else ([], [])
        return pa.Table.from_pylist([_state(key[0].as_py(), s, f, [*kept[0], new], kept[1], bits)], schema=_arrow(_STATE))

    return run


def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scored(docs, "doc_id", "text", remainder("doc_id", 7) == 2)


QUERY = Query("op10_pitman_yor", op10)
