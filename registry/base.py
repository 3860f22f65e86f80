"""How a query is registered: a Spark callable and, where SQL can express it, a checking statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from registry.domain import AS_OF, common_tables, domain_table, domain_tables

AS_OF_SQL = f"DATE '{AS_OF}'"
TRADE_TABLE = "counterparty_trade_links"


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def with_tables(names: tuple[str, ...] | list[str], body: str, *extra: tuple[str, str]) -> str:
    """Checking SQL over the named projections, with further named steps."""
    steps = "".join(f",\n{n} AS ({s})" for n, s in extra)
    return f"{common_tables(*names)}{steps}\n{body}"


def core(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return domain_tables(spark, folder)


def trades(spark: SparkSession, folder: str) -> DataFrame:
    return domain_table(spark, folder, TRADE_TABLE)
