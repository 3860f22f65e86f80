"""Anomaly ranking of entities with an isolation forest.

Fitting needs few rows at any size: each tree sees at most 256. The work that grows with the data is
counting equal feature rows, sampling from the counts, and scoring, all of it in parallel.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.dates import as_of_sql, parse_date
from plumbline.functions.numbers import round_even_sql
from plumbline.operators.evaluate import AsOf
from plumbline.session import fresh_path

# Features, forest size and cut-off.
KEY_FIELDS = (
    "legal_name", "country_code", "registration_number", "entity_type", "sector", "status", "last_verified_date",
)
NUMERIC = ("legal_name_length", "has_registration_number", "days_since_verified", "missing_field_count")
CATEGORICAL = ("country_code", "entity_type", "status", "source_system")
TREES = 150
SAMPLE = 256
CONTAMINATION = 0.03
SEED = 42

FEATURES = (*NUMERIC, *CATEGORICAL)

# The few functions of this module that run in tasks travel with them, so that the package need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
_PREFIX = "__x_"


def feature_expressions(as_of: AsOf = None) -> dict[str, str]:
    missing = " + ".join(f"CAST({c} IS NULL AS INT)" for c in KEY_FIELDS[:-1])
    verified = parse_date("last_verified_date")
    return {
        "legal_name_length": "length(coalesce(legal_name, ''))",
        "has_registration_number": "CAST(registration_number IS NOT NULL AS INT)",
        "days_since_verified": f"datediff({as_of_sql(as_of)}, {verified})",
        "missing_field_count": f"{missing} + CAST(last_verified_date IS NULL AS INT)",
        **{c: f"coalesce({c}, 'MISSING')" for c in CATEGORICAL},
    }


def entity_features(entities: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Four numeric and four categorical features per entity row."""
    return entities.selectExpr("entity_id", *[f"{e} AS {n}" for n, e in feature_expressions(as_of).items()])


def median_days(features: DataFrame, column: str = "days_since_verified") -> DataFrame:
    """The exact median of the only numeric feature that can be missing, as one row.

    Days are counted per value first. There are no more values than days in the calendar, so the final
    step is small whatever the number of rows.
    """
    counts = features.where(f"{column} IS NOT NULL").groupBy(column).agg(F.expr("count(*) AS n"))
    return counts.agg(F.expr(f"percentile({column}, 0.5D, n) AS median_days"))


def _median(features: DataFrame) -> float | None:
    return median_days(features).first()["median_days"]


def _filled_days(days: str, median: float | None) -> str:
    fallback = 0.0 if median is None else median
    return f"coalesce(CAST({days} AS DOUBLE), {fallback!r}D)"


def impute(features: DataFrame) -> DataFrame:
    """Missing days replaced by their median. Categories are complete, MISSING being one of them."""
    days = "days_since_verified"
    filled = f"{_filled_days(days, _median(features))} AS {days}"
    return features.selectExpr(*[filled if c == days else c for c in features.columns])


def one_hot(features: DataFrame) -> DataFrame:
    """One-hot encoding in long form: a line per row and categorical feature, naming the column that is 1."""
    pairs = ", ".join(f"named_struct('feature', '{c}', 'category', {c})" for c in CATEGORICAL)
    return features.selectExpr("entity_id", f"inline(array({pairs}))")


def one_hot_totals(features: DataFrame) -> DataFrame:
    """The sum of every one-hot column."""
    return one_hot(features).groupBy("feature", "category").agg(F.expr("count(*) AS rows"))


def average_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree over n values."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def grow_tree(numeric: np.ndarray, categories: np.ndarray, rng: np.random.Generator, depth_limit: int) -> list[tuple]:
    """One isolation tree as a node list (feature, threshold, category, left, right, path length).

    The candidates of a split are the numeric features and the one-hot columns that vary in the node; a
    one-hot column splits its category from the rest. Leaves have feature -1.
    """
    nodes: list[list] = []
    width = numeric.shape[1]

    def build(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, "", -1, -1, depth + average_path(len(rows))])
        if depth >= depth_limit or len(rows) <= 1:
            return at
        low, high = numeric[rows].min(axis=0), numeric[rows].max(axis=0)
        candidates: list[tuple[int, str]] = [(j, "") for j in range(width) if low[j] < high[j]]
        for j in range(categories.shape[1]):
            present = sorted(set(categories[rows, j]))
            if len(present) > 1:
                candidates += [(width + j, value) for value in present]
        if not candidates:
            return at
        feature, category = candidates[int(rng.integers(len(candidates)))]
        threshold = 0.0
        if feature < width:
            threshold = float(rng.uniform(low[feature], high[feature]))
            right = numeric[rows, feature] > threshold
        else:
            right = categories[rows, feature - width] == category
        if right.all() or not right.any():
            return at
        nodes[at][:3] = [feature, threshold, category]
        nodes[at][3] = build(rows[~right], depth + 1)
        nodes[at][4] = build(rows[right], depth + 1)
        return at

    build(np.arange(len(numeric)), 0)
    return [tuple(n) for n in nodes]


@dataclass(frozen=True)
class Forest:
    """Fitted trees as plain arrays, small enough for every task: at most 2 * SAMPLE nodes per tree."""

    tables: list[tuple[np.ndarray, ...]]
    codes: list[dict[str, int]]
    sample_size: int


def compile_forest(trees: list[list[tuple]], sample_size: int) -> Forest:
    """Turn node lists into arrays, the categories of each feature into numbers."""
    first = len(NUMERIC)
    codes: list[dict[str, int]] = [{} for _ in CATEGORICAL]
    tables = []
    for nodes in trees:
        feature, threshold, category, left, right, path = zip(*nodes)
        numbers = [
            codes[f - first].setdefault(c, len(codes[f - first])) if f >= first else -1
            for f, c in zip(feature, category)
        ]
        tables.append((
            np.array(feature), np.array(threshold, dtype=float), np.array(numbers), np.array(left),
            np.array(right), np.array(path, dtype=float),
        ))
    return Forest(tables, codes, sample_size)


def score_rows(tables: list, codes: list, sample_size: int, columns: list[pd.Series]) -> np.ndarray:
    """Anomaly score of each row, in (-1, 0]; the lower, the easier a row is isolated."""
    first, n = len(NUMERIC), len(columns[0])
    values = np.empty((n, len(columns)))
    for j, column in enumerate(columns):
        known = column if j < first else column.map(codes[j - first]).fillna(-2.0)
        values[:, j] = known.to_numpy(dtype=float)
    total = np.zeros(n)
    for feature, threshold, code, left, right, path in tables:
        at = np.zeros(n, dtype=int)
        active = np.flatnonzero(feature[at] >= 0)
        while len(active):
            node = at[active]
            split = feature[node]
            x = values[active, split]
            goes_right = np.where(split < first, x > threshold[node], x == code[node])
            at[active] = np.where(goes_right, right[node], left[node])
            active = active[feature[at[active]] >= 0]
        total += path[at]
    return -np.power(2.0, -(total / len(tables)) / max(average_path(sample_size), 1e-12))


def feature_groups(features: DataFrame) -> DataFrame:
    """Equal feature rows counted, so that copies cost nothing from here on."""
    return features.groupBy(*FEATURES).agg(F.expr("count(*) AS n"))


def fit_forest(groups: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> Forest:
    """Fit the trees on samples drawn from counted feature rows.

    A pool of about ``trees * sample`` rows is drawn first: a group of n equal rows contributes n times
    the sampling rate, rounded up or down by a hash of its features. Each tree then takes the ``sample``
    pool rows that come first in a hash order of its own. Hashes rather than random numbers make the
    forest the same for any partitioning and after lost tasks.
    """
    total = groups.agg(F.expr("sum(n) AS n")).first()["n"]
    if not total:
        raise ValueError("no rows to fit a forest on")
    size = min(sample, total)
    pool_size = min(total, trees * sample)
    rate = pool_size / total
    columns = ", ".join(FEATURES)
    fraction = f"pmod(xxhash64({seed}, {columns}), 1048576) / 1048576.0D"
    copies = f"CAST(floor(n * {rate!r}D + {fraction}) AS BIGINT)" if rate < 1 else "n"
    pool = (
        groups.selectExpr(*FEATURES, f"{copies} AS copies")
        .where("copies > 0")
        .selectExpr(*FEATURES, "explode(sequence(1L, copies)) AS copy")
    )
    # Four times the sample size per tree leaves no realistic chance of falling short.
    keep = min(1.0, 4.0 * size / pool_size)
    order = f"pmod(xxhash64({seed}, tree, copy, {columns}), 1073741824)"
    candidates = (
        pool.selectExpr(*FEATURES, "copy", f"explode(sequence(0, {trees - 1})) AS tree")
        .selectExpr("tree", f"{order} AS place", "copy", *FEATURES)
        .where(f"place < {math.ceil(keep * 1073741824)}")
    )
    depth_limit = max(1, math.ceil(math.log2(max(size, 2))))

    def fit_one(frame: pd.DataFrame) -> pd.DataFrame:
        tree = int(frame["tree"].iloc[0])
        chosen = frame.sort_values(["place", "copy", *FEATURES]).head(size)
        nodes = grow_tree(
            chosen[list(NUMERIC)].to_numpy(dtype=float), chosen[list(CATEGORICAL)].to_numpy(dtype=object),
            np.random.default_rng([seed, tree]), depth_limit,
        )
        out = pd.DataFrame(nodes, columns=["feature", "threshold", "category", "left_node", "right_node", "path"])
        out.insert(0, "node", range(len(out)))
        out.insert(0, "tree", tree)
        return out

    schema = ("tree int, node int, feature int, threshold double, category string, left_node int, right_node int, "
              "path double")
    fitted = candidates.groupBy("tree").applyInPandas(fit_one, schema).collect()
    nodes: dict[int, list] = {}
    for r in sorted(fitted, key=lambda r: (r["tree"], r["node"])):
        nodes.setdefault(r["tree"], []).append(
            (r["feature"], r["threshold"], r["category"], r["left_node"], r["right_node"], r["path"])
        )
    return compile_forest([nodes[t] for t in sorted(nodes)], size)


def add_score(df: DataFrame, forest: Forest, columns: list[str], name: str) -> DataFrame:
    """Score rows in Arrow batches; every task holds the whole forest."""
    shared = df.sparkSession.sparkContext.broadcast((forest.tables, forest.codes, forest.sample_size))

    @F.pandas_udf(T.DoubleType())
    def score(*series: pd.Series) -> pd.Series:
        return pd.Series(score_rows(*shared.value, list(series)))

    return df.withColumn(name, score(*[F.col(c) for c in columns]))


def weighted_percentile(scored: DataFrame, fraction: float, buckets: int = 4096) -> float:
    """Exact percentile, linearly interpolated, of scores in [-1, 0] that occur ``n`` times each.

    The two neighbouring ranks are found by histograms over ever smaller ranges, until one value is left. Only
    the counts of ``buckets`` buckets reach the driver at a time.
    """
    total = scored.agg(F.expr("sum(n) AS n")).first()["n"]
    position = (total - 1) * fraction
    ranks = [math.floor(position), min(math.floor(position) + 1, total - 1)]
    found = [_value_at(scored, r, buckets) for r in ranks]
    return found[0] + (found[1] - found[0]) * (position - ranks[0])


def _value_at(scored: DataFrame, rank: int, buckets: int) -> float:
    low, high, before = -1.0, 0.0, 0
    part = scored
    while True:
        bucket = f"CAST(least(floor((score - ({low!r}D)) / {(high - low) / buckets!r}D), {buckets - 1}) AS INT)"
        lines = part.groupBy(F.expr(f"{bucket} AS b")).agg(
            F.expr("sum(n) AS n"), F.expr("min(score) AS least"), F.expr("max(score) AS most")
        ).collect()
        for line in sorted(lines, key=lambda r: r["b"]):
            if before + line["n"] > rank:
                break
            before += line["n"]
        if line["least"] == line["most"]:
            return line["least"]
        part = part.where(f"score BETWEEN {line['least']!r}D AND {line['most']!r}D")
        low, high = line["least"], line["most"]


def score_entities(entities: DataFrame, as_of: AsOf = None, contamination: float = CONTAMINATION,
                   trees: int = TREES, seed: int = SEED) -> DataFrame:
    """Entity rows with ``anomaly_label`` and ``anomaly_score``, negative scores being anomalies.

    Fitting happens here; the returned frame scores the rows in a single pass without a shuffle. The
    counted feature rows and their scores are written below the shared folder, as each is read more
    than once.
    """
    spark = entities.sparkSession
    filled = feature_expressions(as_of)
    filled["days_since_verified"] = _filled_days(
        filled["days_since_verified"], _median(entity_features(entities, as_of))
    )
    featured = entities.selectExpr("*", *[f"{e} AS {_PREFIX}{n}" for n, e in filled.items()])

    groups_path = fresh_path(spark, "anomaly-groups")
    feature_groups(featured.selectExpr(*[f"{_PREFIX}{n} AS {n}" for n in FEATURES])).write.parquet(groups_path)
    groups = spark.read.parquet(groups_path)
    forest = fit_forest(groups, trees=trees, seed=seed)

    scores_path = fresh_path(spark, "anomaly-scores")
    add_score(groups, forest, list(FEATURES), "score").select("score", "n").write.parquet(scores_path)
    offset = weighted_percentile(spark.read.parquet(scores_path), contamination)

    scored = add_score(featured, forest, [f"{_PREFIX}{n}" for n in FEATURES], f"{_PREFIX}score")
    decision = f"({_PREFIX}score - ({offset!r}D))"
    return scored.selectExpr(
        *entities.columns,
        f"CASE WHEN {decision} < 0 THEN 'Anomaly' ELSE 'Normal' END AS anomaly_label",
        f"{round_even_sql(decision, 5)} AS anomaly_score",
    )


def anomalies(scored: DataFrame) -> DataFrame:
    """All anomalies, most anomalous first."""
    found = scored.where("anomaly_label = 'Anomaly'")
    return found.orderBy("anomaly_score", *[c for c in scored.columns if c != "anomaly_score"])
