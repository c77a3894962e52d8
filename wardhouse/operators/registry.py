"""Run log and champion/challenger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.operators.forecast import ORDERS
from wardhouse.operators.merge import upsert_by_key

RUN_COLUMNS = ("run_id", "series_id", *ORDERS, "season", "mae", "rmse")


def run_id(run_date: str) -> Column:
    """Named by day and series, so a repeated day has the same runs."""
    return F.sha2(F.concat_ws("|", F.lit(run_date), "series_id"), 256)


def run_rows(best: DataFrame, scores: DataFrame, run_date: str) -> DataFrame:
    """Seven parameters and two metrics per series."""
    return best.join(scores, "series_id").select(run_id(run_date).alias("run_id"), *RUN_COLUMNS[1:])


def promote(champions: DataFrame, challengers: DataFrame) -> DataFrame:
    """The verdict per challenger: all its columns, `old_mae` and `promoted`.

    `champions` has `series_id` and `mae`, the champion's error on the challenger's test days. A challenger wins
    with an error not above it, or when there is no champion or no score for it.
    """
    old = champions.select("series_id", F.col("mae").alias("old_mae"))
    wins = F.col("old_mae").isNull() | F.isnan("old_mae") | (F.col("mae") <= F.col("old_mae"))
    return challengers.join(old, "series_id", "left").withColumn("promoted", F.coalesce(wins, F.lit(False)))


def crown(champions: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The champions table after the promoted challengers replaced their predecessors."""
    winners = verdicts.where("promoted").select(*champions.columns)
    return upsert_by_key(champions, winners, ["series_id"])
