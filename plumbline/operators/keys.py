"""Rules that look at a key across rows or tables: uniqueness, references, two-cycles.

Each of them is answered from *key groups*: the rows are first grouped by the key with a count,
which the map side combines, so a key that holds a third of all rows reaches the shuffle as a few
partial counts per task. Joins happen between groups, where every key occurs once on each side.
The number of failing rows is then the sum of the counts of the failing groups, without joining
anything back to the rows. Only the row-level outputs need ``mark_rows``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import is_blank, name, stripped_text

# Upper bound on the rows of the broadcast side that isolates heavy keys. Any key outside the
# HOT_KEYS largest groups holds at most 1/HOT_KEYS of the rows.
HOT_KEYS = 1000

# 64-bit words of the Bloom filter of failing keys and bits that each key sets in its word: two million rows
# of two numbers at most, under 64 MB. Ten million failing keys leave about 2 % false hits; more of them cost
# time, not correctness.
BLOOM_WORDS = 1 << 21
BLOOM_BITS = 3


class KeyCheck:
    """A rule decided per key group.

    ``keys`` are the grouping expressions; rows outside ``scope`` pass.
    """

    def keys(self) -> list[str]:
        raise NotImplementedError

    def scope(self) -> str:
        return "true"

    def reads(self) -> list[str]:
        """The columns of the checked table that the rule needs."""
        raise NotImplementedError

    def judged_groups(self, df: DataFrame, refs: dict[str, DataFrame]) -> DataFrame:
        """All key groups, every key once: ``__k0 … __kn``, ``__rows`` and the verdict ``__bad``."""
        raise NotImplementedError

    def key_names(self) -> list[str]:
        return [f"__k{i}" for i in range(len(self.keys()))]

    def _groups(self, df: DataFrame, *aggregates: str) -> DataFrame:
        scoped = df if self.scope() == "true" else df.where(self.scope())
        keyed = scoped.selectExpr(
            *[f"{k} AS {n}" for k, n in zip(self.keys(), self.key_names())], *map(name, self.reads())
        )
        return keyed.groupBy(*self.key_names()).agg(F.expr("count(*) AS __rows"), *map(F.expr, aggregates))


@dataclass(frozen=True)
class UniqueKey(KeyCheck):
    """Every row of a key that occurs more than once fails; missing keys are equal to each other.

    ``strip`` compares stripped texts, ``ignore_blank`` exempts rows whose key is blank.
    """

    columns: tuple[str, ...]
    strip: bool = False
    ignore_blank: bool = False

    def keys(self):
        return [stripped_text(name(c)) if self.strip else name(c) for c in self.columns]

    def scope(self):
        if not self.ignore_blank:
            return "true"
        return " AND ".join(f"NOT {is_blank(name(c))}" for c in self.columns)

    def reads(self):
        return list(self.columns)

    def judged_groups(self, df, refs):
        return self._groups(df).selectExpr(*self.key_names(), "__rows", "__rows > 1 AS __bad")


@dataclass(frozen=True)
class ForeignKey(KeyCheck):
    """The key must exist in the referenced table; a null fails unless the key is optional."""

    column: str
    table: str
    table_column: str
    optional: bool = False

    def keys(self):
        return [name(self.column)]

    def scope(self):
        return f"{name(self.column)} IS NOT NULL" if self.optional else "true"

    def reads(self):
        return [self.column]

    def judged_groups(self, df, refs):
        known = distinct_keys(refs[self.table], self.table_column)
        judged = self._groups(df).join(known, F.expr("__k0 = __known"), "left")
        return judged.selectExpr("__k0", "__rows", "__known IS NULL AS __bad")


@dataclass(frozen=True)
class NoTwoCycle(KeyCheck):
    """An edge fails when the opposite edge exists too; an edge to itself is its own opposite.

    Both directions of a pair fall into one group, so a single aggregation decides it and no
    self join is needed.
    """

    child: str
    parent: str

    def keys(self):
        pair = f"{name(self.child)}, {name(self.parent)}"
        return [f"least({pair})", f"greatest({pair})"]

    def scope(self):
        return f"{name(self.child)} IS NOT NULL AND {name(self.parent)} IS NOT NULL"

    def reads(self):
        return [self.child, self.parent]

    def judged_groups(self, df, refs):
        c, p = name(self.child), name(self.parent)
        pairs = self._groups(df, f"count_if({c} < {p}) AS __up", f"count_if({c} > {p}) AS __down")
        return pairs.selectExpr(
            "__k0", "__k1", "__rows", "(__k0 = __k1 OR (__up > 0 AND __down > 0)) AS __bad"
        )


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    """The non-null values of a column, each once, as ``__known``."""
    return df.selectExpr(f"{name(column)} AS __known").where("__known IS NOT NULL").distinct()


def failing_row_count(check: KeyCheck, df: DataFrame, refs: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows that fail a key rule."""
    groups = check.judged_groups(df.select(*check.reads()), refs)
    return groups.agg(F.expr("coalesce(sum(CASE WHEN __bad THEN __rows END), 0L) AS failed_count"))


def _digests(keys: list[str]) -> list[str]:
    """Two independent 64-bit hashes of a key; null parts are told apart from absent ones."""
    parts = ", ".join(f"{k} IS NULL, {k}" for k in keys)
    return [f"xxhash64({parts})", f"xxhash64(1L, {parts})"]


def _bloom_place(digests: list[str]) -> tuple[str, str]:
    """The word of a key, and the bits that it sets there."""
    bits = " | ".join(f"shiftleft(1L, CAST(shiftright({digests[1]}, {6 * i}) & 63 AS INT))" for i in range(BLOOM_BITS))
    return f"pmod({digests[0]}, {BLOOM_WORDS}L)", f"({bits})"


def bloom_filter(keys: DataFrame, names: list[str]) -> DataFrame:
    """A Bloom filter of keys as a table of ``__word`` and ``__bits``; absent words hold no key.

    It has ``BLOOM_WORDS`` rows at most, however many keys there are, and tasks combine their words before the shuffle.
    """
    word, bits = _bloom_place(_digests(names))
    return keys.selectExpr(f"{word} AS __word", f"{bits} AS __bit").groupBy("__word").agg(F.expr("bit_or(__bit) AS __bits"))


def mark_rows(df: DataFrame, check: KeyCheck, refs: dict[str, DataFrame], flag: str) -> DataFrame:
    """Add a boolean column telling which rows fail a key rule.

    A Bloom filter of the failing keys, a value of fixed size, decides at once for the rows whose key it does not
    hold: they pass and are not shuffled. The ``HOT_KEYS`` largest groups are broadcast with their verdict, as pairs
    of 64-bit hashes and so of proven size; rows of those keys are decided by that. Only the rows left, whose key
    may fail and holds at most one ``HOT_KEYS``-th of all rows, meet the failing groups in a join.
    """
    names = check.key_names()
    judged = check.judged_groups(df.select(*check.reads()), refs)
    first, second = _digests(names)
    hot = judged.orderBy(F.desc("__rows"), *names).limit(HOT_KEYS).selectExpr(
        f"{first} AS __h0", f"{second} AS __h1", "__bad AS __hot"
    )
    bad = judged.where("__bad").selectExpr(*names, "true AS __hit")
    keys = [f"__r{i}" for i in range(len(names))]
    own = _digests(keys)
    word, bits = _bloom_place(own)
    keyed = df.selectExpr(
        "*", *[f"{k} AS {r}" for r, k in zip(keys, check.keys())], f"coalesce({check.scope()}, false) AS __in"
    )
    probed = keyed.join(F.broadcast(bloom_filter(bad, names)), F.expr(f"{word} = __word"), "left")
    may_fail = F.expr(f"__in AND coalesce(__bits & {bits} = {bits}, false)")
    hot_match = F.expr(f"{own[0]} = __h0 AND {own[1]} = __h1")
    decided = probed.withColumn("__may", may_fail).join(F.broadcast(hot), hot_match, "left")
    out = list(map(name, df.columns))
    at_once = decided.where("NOT __may OR __hot IS NOT NULL").selectExpr(*out, f"(__may AND __hot) AS {name(flag)}")
    match = " AND ".join(f"{r} <=> {n}" for r, n in zip(keys, names))
    by_join = decided.where("__may AND __hot IS NULL").join(bad, F.expr(match), "left").selectExpr(
        *out, f"coalesce(__hit, false) AS {name(flag)}")
    return at_once.unionAll(by_join)


def fan_out_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that keeps the multiplication of rows by duplicate keys on the right.

    Written as an inner join plus the unmatched rows: a heavy partition of an inner join can be
    split on either side at run time, that of a left join only on the left.
    """
    right_only = [f for f in right.schema.fields if f.name != key]
    matched = left.join(right, key, "inner").select(*left.columns, *[f.name for f in right_only])
    unmatched = left.join(distinct_keys(right, key), F.expr(f"{name(key)} = __known"), "left_anti").selectExpr(
        *map(name, left.columns), *[f"CAST(NULL AS {f.dataType.simpleString()}) AS {name(f.name)}" for f in right_only]
    )
    return matched.unionByName(unmatched)
