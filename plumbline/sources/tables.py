"""Table sources: CSV files and folders, registered datasets, typed staging."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.numbers import nan_to_null
from plumbline.functions.text import literals, name
from plumbline.model import DatasetSpec
from plumbline.rules.trades import TRADES
from plumbline.rules.vocabulary import NA_TOKENS
from plumbline.schemas import TABLES
from plumbline.sources.records import csv_records, one_line_each

REGISTRY: dict[str, DatasetSpec] = {TRADES.name: TRADES}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    na_tokens: tuple[str, ...] = NA_TOKENS,
    mode: str = "PERMISSIVE",
    multi_line: bool = True,
) -> DataFrame:
    """A CSV file with header, every column as text and the NA tokens as null.

    Text first: a value of the wrong type is something to report. With a schema the file is not
    scanned for column types; without one the header gives the column names. Quoted line breaks are part of a value,
    and a file is still read by as many tasks as it has splits; ``multi_line`` off takes every line as a record. Files without
    such breaks, which one scan of their lines shows, are left to Spark's reader, which parses only columns that are used.
    """
    reader = spark.read.option("header", True).option("mode", mode).option("escape", '"').option("multiLine", multi_line)
    names = reader.csv(path).columns if schema is None else schema.fieldNames()
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if multi_line and names and mode == "PERMISSIVE" and one_line_each(spark, path):
        return null_tokens(reader.option("multiLine", False).option("lineSep", "\n").schema(text).csv(path), na_tokens)
    if multi_line and names:
        ddl = ", ".join(f"{name(n)} STRING" for n in names)
        parsed = F.from_csv("record", ddl, {"escape": '"', "mode": mode}).alias("__row")
        return null_tokens(csv_records(spark, path).select(parsed).select("__row.*"), na_tokens)
    return null_tokens(reader.schema(text).csv(path), na_tokens)


def null_tokens(df: DataFrame, tokens: tuple[str, ...]) -> DataFrame:
    """Turn the given texts into null in every text column."""
    if not tokens:
        return df
    listed = literals(tokens)
    return df.selectExpr(*[
        f"CASE WHEN {name(f.name)} NOT IN ({listed}) THEN {name(f.name)} END AS {name(f.name)}"
        if isinstance(f.dataType, T.StringType) else name(f.name)
        for f in df.schema.fields
    ])


def null_nans(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column; Spark orders NaN above all numbers."""
    return df.selectExpr(*[
        f"{nan_to_null(name(f.name))} AS {name(f.name)}"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else name(f.name)
        for f in df.schema.fields
    ])


def read_tolerant(spark: SparkSession, path: str, schema: T.StructType, view: str) -> DataFrame:
    """A typed CSV scan that drops rows which do not parse, registered as a view.

    Every row is parsed whole, whatever columns are selected later, so that all queries see the same rows.
    """
    whole = T.StructType([*schema.fields, T.StructField("_malformed", T.StringType())])
    df = (
        spark.read.schema(whole).option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
        .option("columnNameOfCorruptRecord", "_malformed").option("columnPruning", False).csv(path)
        # Only columns that a plan needs are parsed, so the condition, true for every hash, needs them all.
        .where(f"_malformed IS NULL AND hash({', '.join(map(name, schema.fieldNames()))}) >= -2147483648").drop("_malformed")
    )
    df.createOrReplaceTempView(view)
    return df


def read_folder(spark: SparkSession, folder: str, suffix: str = ".csv") -> dict[str, DataFrame]:
    """One table per file or folder with the suffix, by name. Works on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(s.getPath().getName() for s in found if s.getPath().getName().endswith(suffix))
    if not names:
        raise FileNotFoundError(f"no {suffix} file in {folder}")
    read = spark.read.parquet if suffix == ".parquet" else (lambda p: read_csv(spark, p))
    return {n.removesuffix(suffix): read(f"{folder}/{n}") for n in names}


def load_registry(spark: SparkSession, path: str) -> dict[str, DatasetSpec]:
    """The datasets of a registry file, JSON or, where PyYAML is installed, YAML, on any file system that Spark reads.

    The file holds ``datasets``, a mapping from name to ``file_path``, ``primary_key`` and optionally ``description``,
    ``required_columns``, ``date_columns``, ``numeric_columns`` and ``allowed_values``. Anything else is an error: a
    misspelt field would silently check less.
    """
    try:
        text = spark.read.text(path, wholetext=True).first()
    except AnalysisException as problem:
        raise FileNotFoundError(f"no registry at {path}") from problem
    try:
        content = json.loads(text.value if text else "")
    except json.JSONDecodeError:
        try:
            import yaml
        except ImportError as problem:
            raise ValueError(f"{path} is no JSON, and YAML needs PyYAML") from problem
        content = yaml.safe_load(text.value if text else "")
    if not isinstance(content, dict) or not isinstance(content.get("datasets"), dict):
        raise ValueError(f"{path} has no datasets")
    return {n: _spec(n, facts) for n, facts in content["datasets"].items()}


def _spec(dataset: str, facts: dict) -> DatasetSpec:
    lists = ("required_columns", "date_columns", "numeric_columns")
    if not isinstance(facts, dict):
        raise ValueError(f"dataset {dataset!r} is no mapping")
    unknown = sorted(set(facts) - {"description", "file_path", "primary_key", "allowed_values", *lists})
    missing = [k for k in ("file_path", "primary_key") if not facts.get(k)]
    if unknown or missing:
        raise ValueError(f"dataset {dataset!r} lacks {missing} and has unknown {unknown}")

    def texts(field: str, values) -> tuple[str, ...]:
        # YAML reads some bare words, such as NO, as truth values.
        if not isinstance(values or [], list) or any(not isinstance(v, str) for v in values or []):
            raise ValueError(f"{field} of dataset {dataset!r} is no list of texts: {values}")
        return tuple(values or [])

    return DatasetSpec(
        name=dataset, path=facts["file_path"], primary_key=facts["primary_key"], description=facts.get("description") or "",
        allowed_values={c: texts(c, v) for c, v in (facts.get("allowed_values") or {}).items()},
        **{k: texts(k, facts.get(k)) for k in lists},
    )


def dataset_spec(dataset: str, registry: dict[str, DatasetSpec] | None = None) -> DatasetSpec:
    known = REGISTRY if registry is None else registry
    if dataset not in known:
        raise ValueError(f"dataset {dataset!r} is not registered; registered are {', '.join(known)}")
    return known[dataset]


def read_dataset(spark: SparkSession, spec: DatasetSpec, root: str) -> DataFrame:
    """A registered dataset, all columns as text."""
    path = f"{root}/{spec.path}"
    try:
        return read_csv(spark, path)
    except AnalysisException as problem:
        raise FileNotFoundError(f"dataset {spec.name} not found at {path}") from problem


def stage(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Narrow a text table to its declared types; values that do not parse become null."""
    return df.selectExpr(*[
        f"try_cast({name(f.name)} AS {f.dataType.simpleString()}) AS {name(f.name)}" for f in schema.fields
    ])


def stage_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staged tables as session views named ``stg_…``."""
    staged = {}
    for table, df in tables.items():
        staged[table] = stage(df, TABLES[table])
        staged[table].createOrReplaceTempView(f"stg_{table}")
    return staged
