"""Where queries and the SQL they are held against are collected, and what they share."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def held(sql: str) -> Callable[[Query], Query]:
    """Registers a query with its SQL."""

    def add(f: Query) -> Query:
        SQL[f.__name__] = sql
        return query(f)

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def long(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


class Part:
    """A piece of a text, as a column (made when a session is there) and as SQL."""

    def __init__(self, column: Callable[[], Column], sql: str) -> None:
        self._column, self.sql = column, sql

    @property
    def column(self) -> Column:
        return self._column()


class Text(Part):
    """A text made of parts; plain strings stand for themselves."""

    def __init__(self, *parts: str | Part) -> None:
        made = [Part(lambda p=p: F.lit(p), literal(p)) if isinstance(p, str) else p for p in parts]
        super().__init__(lambda: F.concat(*(p.column for p in made)), "(" + " || ".join(p.sql for p in made) + ")")


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def choose(*cases: tuple[str, str], other: str = "") -> Part:
    """The text of the first condition that holds; conditions are SQL that both engines read alike."""

    def column() -> Column:
        return reduce(lambda c, x: c.when(F.expr(x[0]), F.lit(x[1])), cases[1:], F.when(F.expr(cases[0][0]), F.lit(cases[0][1]))).otherwise(F.lit(other))

    return Part(column, "(CASE " + " ".join(f"WHEN {when} THEN {literal(then)}" for when, then in cases) + f" ELSE {literal(other)} END)")


BODY = Part(lambda: F.coalesce(F.col("text"), F.lit("")), "coalesce(text, '')")
ID = Part(lambda: F.col("doc_id").cast("string"), "CAST(doc_id AS VARCHAR)")
