"""JDBC tables. Credentials come from the caller's `props`, never from this package."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 10_000
FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Partitioning:
    """Splits a table scan into `parts` range queries; rows outside the bounds fall into the outer ones."""

    column: str
    lower: int | str
    upper: int | str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def split_points(landed: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[Any]:
    """Values of `column` that cut its rows into about equal parts, in order, from a table that was landed before.

    Even ranges between the smallest and the largest id leave some tasks with nearly all rows when ids are dense in one
    place. Quantiles follow the rows; their error is 1 / `accuracy` of them. The day before is near enough for today, and the
    scan reads one column. Points that coincide (one value with very many rows) are merged, so parts can be fewer.
    """
    shares = [k / parts for k in range(1, parts)]
    found = landed.agg(F.percentile_approx(column, shares, accuracy).alias("points")).first()["points"] if shares else None
    return sorted(set(found or []))


def range_predicates(column: str, points: Sequence[Any]) -> list[str]:
    """Conditions between the points: every row, one with a NULL too, meets exactly one of them."""

    def literal(value: Any) -> str:
        return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"

    if not points:
        return ["1 = 1"]
    texts = [literal(p) for p in points]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:])]
    return [f"({column} < {texts[0]} OR {column} IS NULL)", *inner, f"{column} >= {texts[-1]}"]


def jdbc_options(url: str, table: str, props: Mapping[str, str]) -> dict[str, str]:
    """`props` takes user, password, driver and any further JDBC option of Spark."""
    return {**props, "url": url, "dbtable": table}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    props: Mapping[str, str],
    partition: Partitioning | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A full table scan: a task per predicate (see `range_predicates`), or `partition.parts` tasks, or one."""
    if predicates:
        if partition:
            raise ValueError("either a partitioning or predicates")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties={"fetchsize": str(FETCH_ROWS), **props})
    options = {"fetchsize": str(FETCH_ROWS), **jdbc_options(url, table, props)}
    if partition:
        options |= partition.options()
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    props: Mapping[str, str],
    batchsize: int = BATCH_ROWS,
    connections: int | None = None,
) -> None:
    """Appends in batches; `connections` bounds the tasks that write at the same time."""
    options = {"batchsize": str(batchsize), **jdbc_options(url, table, props)}
    if connections:
        options["numPartitions"] = str(connections)
    df.write.format("jdbc").options(**options).mode("append").save()
