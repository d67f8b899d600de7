"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.session import tune

from .tables import DERIVED, GIVEN

_SCHEMAS: dict[str, T.StructType] = {}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given Parquet tables and the procurement tables Spark derives from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name in GIVEN:
            path = f"{self.sf_dir}/{name}.parquet"
            if path not in _SCHEMAS:
                _SCHEMAS[path] = self.spark.read.parquet(path).schema
            return self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        if name not in DERIVED:
            raise AttributeError(name)
        text = DERIVED[name]
        parts = {n: getattr(self, n) for n in [*GIVEN, *DERIVED] if f"{{{n}}}" in text}
        return self.spark.sql(text, **parts)

    @cached_property
    def per_cig(self) -> DataFrame:
        from tenderlake.plans.tenders import tenders_per_cig

        return tenders_per_cig(self.bandi)


def plain(df: DataFrame) -> DataFrame:
    """Days as ISO text, so that both engines compare the same value."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, (T.DateType, T.TimestampType))
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def _needed(sql: str) -> list[str]:
    """Derived tables an SQL text refers to as {name}, dependencies first."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name, body in DERIVED.items():
            if f"{{{name}}}" in text and name not in found:
                visit(body)
                found.append(name)

    visit(sql)
    return found


def with_tables(sql: str) -> str:
    names = [*GIVEN, *DERIVED]
    bind = {n: n for n in names}

    def fill(text: str) -> str:
        for name in names:
            text = text.replace(f"{{{name}}}", bind[name])
        return text

    ctes = [f"{name} AS ({fill(DERIVED[name])})" for name in _needed(sql)]
    body = fill(sql).strip()
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {', '.join(ctes)}, {body[5:]}"
    return f"WITH {', '.join(ctes)} {body}"


def query(name: str, sql: str | None = None, dates: bool = False):
    """Register a function of `Tables` under a name, with its SQL where there is one.

    With `dates` days are compared as days, else as ISO text.
    """

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        shown = (lambda df: df) if dates else plain
        QUERIES[name] = lambda spark, sf_dir: shown(fn(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return wrap
