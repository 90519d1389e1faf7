"""Registry of the library's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from codexlake.session import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int | float):
        return repr(value)
    if isinstance(value, list | tuple):
        return f"[{', '.join(map(_literal, value))}]"
    return "'" + str(value).replace("'", "''") + "'"


def values(columns: str, rows: list[tuple]) -> str:
    """SQL for rows written out, ``columns`` as ``a::INT, b::VARCHAR``."""
    names = [c.split("::")[0].strip() for c in columns.split(",")]
    body = ", ".join(f"({', '.join(map(_literal, r))})" for r in rows)
    return f"SELECT {', '.join(f'{c.strip()} AS {n}' for c, n in zip(columns.split(','), names, strict=True))} FROM (VALUES {body}) AS t({', '.join(names)})"


def fixture(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows written out as a DataFrame."""
    ship(spark)
    return spark.createDataFrame(rows, schema)
