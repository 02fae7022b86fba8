"""Named queries: a function from views to a DataFrame, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.plans.views import Views, with_views


@dataclass(frozen=True)
class Query:
    build: Callable[[Views], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Views(spark, sf_dir))


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may name the views, they become its CTEs."""

    def keep(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        if name in CATALOG:
            raise ValueError(f"query {name} exists already")
        CATALOG[name] = Query(build, with_views(sql) if sql else None)
        return build

    return keep


def rounded(df: DataFrame, digits: int = 4, names: Iterable[str] | None = None) -> DataFrame:
    """Double columns rounded, since sums of doubles depend on the order of addition."""
    picked = list(names) if names is not None else [n for n, k in df.dtypes if k == "double"]
    return df.withColumns({n: F.round(n, digits) for n in picked})


def sql_rounded(names: Iterable[str], digits: int = 4) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)
