"""Distinct counts that can be added up: a sketch per day, longer periods from the days without the fact.

An exact count of distinct values cannot be summed over days, so a month needs the fact again. A HyperLogLog sketch of a
day is a few kilobytes, sketches of days merge into that of any period, and the error stays the same (`LG_K`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2**14 registers: a standard error of about 0.7 %.
LG_K = 14


def daily_sketches(fact: DataFrame, day_col: str, value_col: str, by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """`day_col`, the `by` columns, `sketch`. NULL values are not counted."""
    return fact.groupBy(day_col, *by).agg(F.hll_sketch_agg(value_col, F.lit(lg_k)).alias("sketch"))


def distinct_over(sketches: DataFrame, period: Column, by: Sequence[str] = (), name: str = "period") -> DataFrame:
    """The estimated number of distinct values per period, from the sketches of its days."""
    merged = sketches.groupBy(period.alias(name), *by).agg(F.hll_union_agg("sketch").alias("_sketch"))
    return merged.select(name, *by, F.hll_sketch_estimate("_sketch").alias("n"))


def replace_days(sketches: DataFrame, fresh: DataFrame, day_col: str) -> DataFrame:
    """The sketches with those of some days replaced. Days are bounded by the calendar, hence the broadcast."""
    kept = sketches.join(F.broadcast(fresh.select(day_col).distinct()), day_col, "left_anti")
    return kept.unionByName(fresh)
