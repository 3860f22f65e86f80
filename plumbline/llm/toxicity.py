"""Toxicity scores of texts whose disguises a noisy-channel model has undone."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from math import log, sqrt

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import Query, body, col, in_batches, packed, remainder, stored, table

#: Production parameters: labelled texts to learn from at most, features of the classifier at most, and the score from
#: which a text counts as toxic.
LABELLED, FEATURES, THRESHOLD = 200_000, 20_000, 0.7
#: How far below the observed share of toxic texts a feature's weight stays, in standard errors.
CAUTION = 2.5
#: Lengths of the beginnings of words that are features, and the least weight that counts as evidence.
BEGINNINGS, LEAST = (4, 5, 6), 0.4
#: Decoded words and other pieces that a task remembers at most.
REMEMBERED = 300_000

#: Letters that signs stand for in leetspeak.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l", "¡": "i", "§": "s",
}
#: Letters of the language model: 0 the edge of a word, 1 to 26 a to z, 27 any other letter.
LETTERS = 28
#: Log probabilities of the channel: a letter as it is, a letter written once more, a sign for a letter, a sign without
#: meaning inside a word, a sign between words, any letter behind a star.
KEEP, AGAIN, SIGN, NOISE, EDGE, STAR = log(0.97), log(0.3), log(0.4), log(0.1), log(0.05), log(0.3 / 26)

_FOLD = regex.compile(r"\p{Mn}+")
#: Readings of a piece that are looked for; longest piece for which it is more than one; letters behind which a reading is settled.
BEST, SEVERAL, SETTLED = 3, 40, 4096
#: Longest piece that may be part of a word written with blanks inside.
SHORT = 4
_EDGES = ".,;:?\"'()[]{}<>*#%&~^=/\\-_`…»«"
#: Signs at the ends that stand for no letter.
_PLAIN = "".join(c for c in _EDGES if c not in LEET and c != "*")
_RUN = re.compile(r"(.)\1+").sub
_DOUBLE, _TRIPLE = re.compile(r"(.)\1").search, re.compile(r"(.)\1\1").search
#: Signs that may stand for letters.
_SIGN = re.compile("[" + re.escape("".join(LEET) + "*") + "]").search


@lru_cache(maxsize=4096)
def letter(c: str) -> int:
    """The number of a lower-case letter, accents dropped."""
    if "a" <= c <= "z":
        return ord(c) - 96
    base = unicodedata.normalize("NFD", c)[0]
    return ord(base) - 96 if "a" <= base <= "z" else 27


#: The last model that this process got, and its readings of ends of pieces.
_LAST: dict = {}


class CharacterModel:
    """Trigrams of letters, mixed with bigrams and single letters."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(LETTERS, LETTERS, LETTERS).astype(float)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + LETTERS)
        p2 = (two + 20 * p1) / (two.sum(axis=1, keepdims=True) + 20)
        self.cost = np.log((three + 20 * p2) / (three.sum(axis=2, keepdims=True) + 20)).tolist()
        self.known: dict[tuple[bool, str, int, int], list[tuple[float, str]]] = {}

    def __getstate__(self) -> dict:
        return {"cost": self.cost}

    def __setstate__(self, state: dict) -> None:
        # A Python worker runs many tasks with the same model; what one has read serves the others.
        if _LAST.get("cost") != state["cost"]:
            _LAST.update(cost=state["cost"], known={})
        self.__dict__.update(_LAST)

    def joins(self, before: str, after: str) -> bool:
        """Whether two pieces of letters are likelier one word than two; only the two letters on either side matter."""
        a, b = ([0, 0] + [letter(c) for c in before[-2:]])[-2:]
        x, *rest = [letter(c) for c in after[:2]]
        one, two = self.cost[a][b][x] - 0.1, self.cost[a][b][0] + self.cost[0][0][x] + EDGE
        for y in rest:
            one, two = one + self.cost[b][x][y], two + self.cost[0][x][y]
        return one > two

    def options(self, c: str, again: bool) -> list[tuple[str, float]]:
        """What a sign may stand for, with the channel's log probability; ``again`` tells that the same sign stands before."""
        if c.isalpha():
            return [(c, KEEP), ("", AGAIN)] if again else [(c, KEEP)]
        out = [(x, SIGN) for x in LEET.get(c, "")]
        out.append(("", NOISE if c in LEET else -0.1))
        if c == "*":
            out += [(chr(x), STAR) for x in range(97, 123)]
        elif c not in LEET:
            out.append((" ", EDGE))
        return out

    def ahead(self, again: bool, rest: str, a: int, b: int) -> list[tuple[float, str]]:
        """The ``BEST`` likeliest readings of what is left of a piece behind the letters ``a`` and ``b``, likeliest first.

        Viterbi from the right: the readings of a rest depend on the two letters before it alone, so they are remembered and
        serve all pieces with that end. A run of k stars thus costs at most k times the pairs of letters, once.
        """
        # Letters that can only be themselves are read at once.
        i, gain = 0, 0.0
        while i < len(rest) and not again and rest[i].isalpha():
            n = letter(rest[i])
            gain += self.cost[a][b][n] + KEEP
            a, b, i = b, n, i + 1
            again = rest[i - 1] == rest[i:i + 1]
        if i:
            return [(p + gain, rest[:i] + t) for p, t in self.ahead(again, rest[i:], a, b)]
        key = again, rest, a, b
        found = self.known.get(key)
        if found is None:
            row = self.cost[a][b]
            if not rest:
                found = [(row[0], "")]
            else:
                c, behind = rest[0], rest[1:]
                next_again = behind[:1] == c
                top: dict[str, float] = {}
                for emitted, channel in self.options(c, again):
                    if emitted == "":
                        gain, tails = channel, self.ahead(next_again, behind, a, b)
                    elif emitted == " ":
                        if b == 0:
                            continue
                        gain, tails = channel + row[0], self.ahead(next_again, behind, 0, 0)
                    else:
                        n = letter(emitted)
                        gain, tails = channel + row[n], self.ahead(next_again, behind, b, n)
                    for p, t in tails:
                        t = emitted + t
                        if p + gain > top.get(t, -1e300):
                            top[t] = p + gain
                found = sorted(((p, t) for t, p in top.items()), key=lambda x: (-x[0], x[1]))[:BEST]
            if len(self.known) >= REMEMBERED // 3:
                self.known.clear()
            self.known[key] = found
        return found

    def decode(self, raw: str) -> list[str]:
        """The most likely readings of a disguised piece, most likely first: ``BEST`` of a short piece, one of a long one."""
        if len(raw) <= SEVERAL:
            return [t for _, t in self.ahead(False, raw, 0, 0)]
        return self.decode_long(raw)

    def decode_long(self, raw: str, best: int = 1) -> list[str]:
        """The ``best`` most likely readings of a piece of any length.

        Viterbi from the left over the lattice of what each sign can stand for; a state is the last two letters. A sign is a
        letter, is left out as a repetition or noise, or separates two words. What lies ``SETTLED`` letters behind is
        settled by the best reading, so that the time grows with the length.
        """
        settled: list[str] = []
        states: dict[tuple[int, int], list[tuple[float, str]]] = {(0, 0): [(0.0, "")]}
        for i, c in enumerate(raw):
            options = self.options(c, i > 0 and raw[i - 1] == c)
            after: dict[tuple[int, int], list[tuple[float, str]]] = {}
            for (a, b), paths in states.items():
                for emitted, channel in options:
                    if emitted == "":
                        key, gain = (a, b), channel
                    elif emitted == " ":
                        if b == 0:
                            continue
                        key, gain = (0, 0), channel + self.cost[a][b][0]
                    else:
                        n = letter(emitted)
                        key, gain = (b, n), channel + self.cost[a][b][n]
                    after.setdefault(key, []).extend((p + gain, t + emitted) for p, t in paths)
            states = {k: _leaders(v, best) for k, v in after.items()}
            if len(states) > 64:
                states = dict(sorted(states.items(), key=lambda x: -x[1][0][0])[:64])
            if i % 64 == 63:
                top = max((paths[0] for paths in states.values()), key=lambda x: x[0])[1]
                if len(top) > 2 * SETTLED:
                    old = top[:-SETTLED]
                    settled.append(old)
                    states = {k: [(p, t[len(old):]) for p, t in paths if t.startswith(old)] for k, paths in states.items()}
                    states = {k: paths for k, paths in states.items() if paths}
        ends = [(p + self.cost[a][b][0], t) for (a, b), paths in states.items() for p, t in paths]
        return ["".join(settled) + t for _, t in _leaders(ends, best)]


def _leaders(paths: list[tuple[float, str]], best: int) -> list[tuple[float, str]]:
    top: dict[str, float] = {}
    for p, t in paths:
        if t not in top or top[t] < p:
            top[t] = p
    return sorted(((p, t) for t, p in top.items()), key=lambda x: (-x[0], x[1]))[:best]


class Joins(dict):
    """Whether two pieces are likelier one word, by the last two letters of the first and the first two of the second."""

    def __init__(self, model: CharacterModel):
        super().__init__()
        self.model = model

    def __missing__(self, ends: tuple[str, str]) -> bool:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[ends] = self.model.joins(*ends)
        return found


class Reader:
    """The words of a text, by the pieces between white space, after undoing disguises."""

    def __init__(self, model: CharacterModel):
        self.model = model
        self.known = Joins(model)

    def readings(self, piece: str) -> list[str]:
        """The words that a piece stands for. Letters alone are not in disguise unless one stands three times."""
        bare = piece.strip(_EDGES).rstrip("!")
        core = piece.strip(_PLAIN)
        if core.isalpha() and not _TRIPLE(core):
            return [core]
        if not any(c.isalpha() or c in LEET for c in core):
            return []
        found = [w for text in self.model.decode(core) for w in text.split()]
        # The signs at the ends may also be just that.
        if bare != core and any(map(str.isalpha, bare)):
            found += [w for w in self.readings(bare) if w not in found]
        return found

    def words(self, piece: str) -> set[str]:
        """The readings with repeated letters written once. Most pieces are letters without any repeated."""
        core = piece.strip(_PLAIN)
        if core.isalpha() and not _DOUBLE(core):
            return {core}
        return {_RUN(r"\1", w) for w in self.readings(piece)}

    @staticmethod
    def pieces(words: list[str]) -> set[str]:
        """The different pieces between white space, and runs of three or more single signs as pieces of their own."""
        out = set(words)
        single = np.fromiter(map(len, words), np.int64, len(words)) == 1
        if (single[2:] & single[1:-1] & single[:-2]).any():
            edges = np.flatnonzero(np.diff(np.concatenate(([0], single.view(np.int8), [0]))))
            out.update(" ".join(words[a:b]) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True) if b - a > 2)
        return out

    def joined(self, words: list[str]) -> set[str]:
        """The words that neighbouring short pieces of a text make, where that is likelier than words of their own.

        Between letters only the blank is open, so that the likelihoods of both cases decide; runs in which other signs can be
        letters go through the lattice.
        """
        short = np.fromiter(map(len, words), np.int64, len(words)) <= SHORT
        out, joins = set(), self.known.__getitem__
        if not (short[1:] & short[:-1]).any():
            return out
        edges = np.flatnonzero(np.diff(np.concatenate(([0], short.view(np.int8), [0]))))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a < 2:
                continue
            run = words[a:b]
            letters = "".join(run)
            if letters.isalpha():
                # Where no two neighbours join, none of them goes on.
                if not any(map(joins, zip([w[-2:] for w in run], [w[:2] for w in run[1:]]))):
                    continue
                made = run[0]
                for before, after in zip(run, run[1:]):
                    if joins((made[-2:], after[:2])):
                        made += after
                    else:
                        if made is not before:
                            out.add(made)
                        made = after
                if made is not run[-1]:
                    out.add(made)
            elif _SIGN(letters) and any(_SIGN(w.strip(_PLAIN)) for w in run):
                out.update(self.readings(" ".join(run)))
        return {_RUN(r"\1", w) for w in out}


def character_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of letter trigrams over all words of all texts; 28^3 numbers at most reach the driver."""
    rows = docs.select(body(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(LETTERS ** 3, np.int64)

        def add(words: Counter) -> None:
            plain = [(w, n) for w, n in zip((w.strip(_EDGES) for w in words), words.values()) if w.isalpha()]
            ascii_ = [(w, n) for w, n in plain if w.isascii()]
            stream, weights, lengths = [], [], []
            for w, n in plain:
                if not w.isascii():
                    stream += [0, 0, *map(letter, w), 0]
                    weights.append(n)
                    lengths.append(len(w) + 3)
            # Words are parted by the sign before "a".
            a = np.frombuffer("".join(["``" + w + "`" for w, _ in ascii_]).encode(), np.uint8).astype(np.int64) - 96
            a = np.concatenate((a, np.array(stream, np.int64)))
            n = np.repeat(np.array([n for _, n in ascii_] + weights, np.int64), np.array([len(w) + 3 for w, _ in ascii_] + lengths, np.int64))
            if len(a):
                codes = (a[:-2] * LETTERS + a[1:-1]) * LETTERS + a[2:]
                inside = a[1:-1] + a[2:] > 0  # not across two words
                sums[:] += np.bincount(codes[inside], n[2:][inside], LETTERS ** 3).astype(np.int64)

        words: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                words.update(text.as_py().lower().split())
                if len(words) > REMEMBERED:
                    add(words)
                    words = Counter()
        add(words)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["code", "n"])

    counts = np.zeros(LETTERS ** 3, np.int64)
    for code, n in in_batches(rows, run, "code long, n long").groupBy("code").agg(F.sum("n")).collect():
        counts[code] = n
    return counts


class Features(dict):
    """Pieces to the features of their words: the words and their beginnings. Pieces are remembered."""

    def __init__(self, reader: Reader):
        super().__init__()
        self.reader = reader

    def __missing__(self, piece: str) -> list[str]:
        words = self.reader.words(piece)
        if len(self) >= REMEMBERED // 2:
            self.clear()
        found = self[piece] = [*words, *[w[:n] + "-" for n in BEGINNINGS for w in words if len(w) > n]]
        return found


def learned(labelled: DataFrame, reader: Reader, features: int = FEATURES) -> tuple[dict[str, float], float]:
    """The weights of the features that speak for toxicity, and the share of toxic texts.

    ``labelled`` has ``text`` and ``toxic``. A word's weight is the lower bound of the share of toxic texts among the
    texts that have it. That of a beginning is at most the same bound for the share of toxic words, those mostly in toxic
    texts, among the different words that begin so, so that one word alone doesn't make its beginning suspicious. At most ``features`` are kept, those in most toxic texts or words first.
    """
    model = reader.model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Features(Reader(model))
        counts = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"].to_pylist(), strict=True):
                pieces = Reader.pieces(text.as_py().lower().split())
                counts[toxic].update(set(chain.from_iterable(map(own.__getitem__, pieces))))
                counts[toxic][""] += 1
            if sum(map(len, counts)) > 2 * REMEMBERED:
                yield from out(*counts)
                counts = Counter(), Counter()
        yield from out(*counts)

    def out(clean: Counter, toxic: Counter) -> Iterator[pa.RecordBatch]:
        for c, name in ((clean, 0), (toxic, 1)):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array([0 if name else n for n in c.values()], pa.int64()),
                                              pa.array([n if name else 0 for n in c.values()], pa.int64())], ["feature", "clean", "toxic"])

    # Written once: read by words and by beginnings, whose filters would keep Spark from sharing the pass over the texts.
    sums = stored(in_batches(
        labelled.select(body("text").alias("text"), F.col("toxic").cast("int").alias("toxic")), run, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxicity-features")

    def bounded(df: DataFrame, name: str) -> DataFrame:
        n, z = F.col("clean") + F.col("toxic"), CAUTION
        share = F.col("toxic") / n
        return df.withColumn(name, (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n))

    # Only what is in some toxic texts can be evidence; the words of a beginning are all counted before.
    mostly = (F.col("toxic") >= F.col("clean")).cast("long")
    begins = sums.filter("feature not like '%-' and feature <> ''").select(
        F.explode(F.array(*[F.when(F.length("feature") > n, F.concat(F.left("feature", F.lit(n)), F.lit("-"))) for n in BEGINNINGS])).alias("feature"),
        mostly.alias("toxic"), (1 - mostly).alias("clean")).filter("feature is not null").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    of_words = bounded(begins.filter("toxic >= 3"), "of_words").select("feature", "of_words")
    of_texts = bounded(sums, "weight").filter(f"feature = '' or (weight >= {LEAST} and toxic >= 3)")
    chosen = of_texts.join(of_words, "feature", "left").withColumn(
        "weight", F.when(F.col("feature").endswith("-"), F.least("weight", F.coalesce("of_words", F.lit(0.0)))).otherwise(F.col("weight"))).filter(
        f"feature = '' or weight >= {LEAST}").orderBy(F.col("feature") != "", F.desc("toxic"), F.desc("weight"), "feature").limit(features + 1).collect()
    weights = {r.feature: r.weight for r in chosen if r.feature}
    prior = next(((r.toxic + 1) / (r.clean + r.toxic + 2) for r in chosen if not r.feature), 0.5)
    return weights, prior


class Scorer(dict):
    """Texts to scores: the strongest evidence of each piece, combined as independent causes. Pieces are remembered."""

    def __init__(self, reader: Reader, weights: dict[str, float], prior: float):
        super().__init__()
        self.reader, self.weights, self.prior = reader, weights, prior
        self.begins = frozenset(w[:-1] for w in weights if w[-1] == "-")

    def __missing__(self, piece: str) -> float:
        weights, begins, found = self.weights, self.begins, 0.0
        for w in self.reader.words(piece):
            if w in weights:
                found = max(found, weights[w])
            for n in BEGINNINGS:
                if len(w) <= n:
                    break
                if w[:n] in begins:
                    found = max(found, weights[w[:n] + "-"])
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = found
        return found

    def score(self, text: str) -> float:
        words = text.lower().split()
        pieces = self.reader.pieces(words)
        left = 1.0
        # A word over blanks counts as a whole word only: beginnings would take in what neighbours make by chance.
        over = [self.weights.get(w, 0.0) for w in self.reader.joined(words) if w not in pieces]
        for w in sorted(filter(None, [*map(self.__getitem__, pieces), *over]), reverse=True):
            left *= 1 - w
        # Without evidence the score falls with the number of clean words, from the share of toxic texts.
        return 1 - left * (1 - self.prior * 0.5 / (1 + sqrt(len(pieces))))


def fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, train: Column, most: int = LABELLED) -> Scorer:
    """A scorer from the documents (all of them for the characters) and the labels of the rows that ``train`` admits.

    Of the labelled ids at most ``most``, in the order of a hash, are learned from; they have a bounded size and
    are broadcast. An id with several labels counts as toxic if one says so; null labels and null ids are left out.
    """
    model = CharacterModel(character_counts(docs, text_col))
    chosen = labels.select(col("doc_id").alias("key"), col("toxic").alias("toxic")).filter(
        "key is not null and toxic is not null").groupBy("key").agg(F.max("toxic").alias("toxic")).orderBy(
        F.xxhash64("key"), "key").limit(most)
    rows = docs.select(col(id_col).alias("key"), col(text_col).alias("text"), train.alias("train")).filter("train")
    weights, prior = learned(rows.join(F.broadcast(chosen), "key").select("text", "toxic"), Reader(model))
    return Scorer(Reader(model), weights, prior)


def scored(docs: DataFrame, scorer: Scorer, text_col: str = "text", carry: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``carry`` (all if not given) with ``score`` and ``predicted``, in one pass without shuffle.

    Null texts count as empty and get the least evidence; ids play no part. Clashing columns give way to the results.
    """
    carry = [c for c in carry or docs.columns if c.lower() not in ("score", "predicted")]
    rows = docs.select(F.struct(*[col(c).alias(c) for c in carry]).alias("row"), body(text_col).alias("text"))
    out = rows.select("row").schema.add("score", "double")
    model, weights, prior = scorer.reader.model, scorer.weights, scorer.prior

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(Reader(model), weights, prior)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["row"], pa.array([own.score(t.as_py()) for t in b["text"]], pa.float64())], ["row", "score"])

    return in_batches(rows, run, out).select("row.*", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that are not toxic, with the columns of ``docs``; the scorer is learned from all labels."""
    scorer = fitted(docs, labels, id_col, text_col, F.lit(True))
    whole = packed(docs, **{"text": text_col})
    return scored(whole, scorer, "text", ["row"], threshold).filter("predicted = 0").select("row.*")


def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 3) == 1
    scorer = fitted(docs, table(spark, folder, "labels"), "doc_id", "text", ~held_out)
    return scored(docs.withColumn("held_out", held_out), scorer, "text", ["doc_id", "held_out"])


QUERY = Query("op9_toxicity", op9)
