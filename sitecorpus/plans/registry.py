"""Query registry: one entry per operator, with the equivalent DuckDB SQL where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sitecorpus.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}

_INT = (T.ByteType, T.ShortType, T.IntegerType)


def _widen(df: DataFrame) -> DataFrame:
    """Report integers as BIGINT, so both engines agree on the type."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("bigint").alias(f.name) if isinstance(f.dataType, _INT) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return _widen(fn(Tables(spark, sf_dir)))

        run.__doc__ = fn.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


class Tables:
    """The given parquet tables of one scale-factor folder, read lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


_ARROWS = re.compile(
    r"\b((?:\w+\.)?[A-Za-z_]\w*)((?:->>?(?:'(?:[^']|'')*'|\((?:[^()]|\([^()]*\))*\)(?:::INT)?|\d+|i::INT))+)"
)


def ora(main: str) -> str:
    """Prefix `main` with the common table expressions it reads, dependencies first.

    JSON arrows get parentheses, since they bind more loosely than comparisons.
    """
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
                visit(CTES[name])
                ordered.append(name)

    visit(main)
    if not ordered:
        return _ARROWS.sub(r"(\1\2)", main)
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered)
    return _ARROWS.sub(r"(\1\2)", f"WITH {head}\n{main}")
