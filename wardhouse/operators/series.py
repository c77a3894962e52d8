"""Daily series: building, gap filling, interpolation, hold-out, accuracy.

Frames have the columns `series_id`, `ds` (date) and `y`. After the first aggregation a series has one row per
day, so a window over one series is bounded by the calendar however large the fact is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardhouse.functions.dates import date_from_key

SEGMENTS = ("train", "validation", "test")


def daily_series(
    fact: DataFrame,
    date_key_col: str,
    measure: Column,
    by: Sequence[str] = (),
    name: str = "all",
) -> DataFrame:
    """The aggregate `measure` per day, and per `by` columns (joined to the series id)."""
    series = F.concat_ws("|", F.lit(name), *[F.col(c).cast("string") for c in by])
    return (
        fact.groupBy(date_key_col, *by)
        .agg(measure.alias("y"))
        .select(series.alias("series_id"), date_from_key(date_key_col).alias("ds"), "y")
    )


# Up to so many days are written into the condition, where the scan can use them.
LISTED_DAYS = 1_000


def refresh_days(previous: DataFrame, fact: DataFrame, touched: DataFrame, day_col: str, totals: Sequence[Column]) -> DataFrame:
    """The daily totals of `fact` (`day_col` and the aggregates), made anew for the `touched` days only.

    The other days are taken from `previous`. A touched day without rows any more disappears. Days are bounded by the
    calendar, so they may be broadcast; few of them become a condition on the scan.
    """
    days = touched.select(day_col).distinct()
    few = [r[0] for r in days.limit(LISTED_DAYS + 1).collect()]
    if len(few) <= LISTED_DAYS:
        again = fact.where(F.col(day_col).isin(few)) if few else fact.limit(0)
    else:
        again = fact.join(F.broadcast(days), day_col, "left_semi")
    fresh = again.groupBy(day_col).agg(*totals)
    return previous.join(F.broadcast(days), day_col, "left_anti").select(*fresh.columns).unionByName(fresh)


def fill_gaps(series: DataFrame) -> DataFrame:
    """A row for every day between the first and the last of each series; `y` is NULL on added days.

    Each known day is expanded up to the day before the next known one: no calendar join.
    """
    following = F.lead("ds").over(Window.partitionBy("series_id").orderBy("ds"))
    last = F.greatest(F.col("ds"), F.date_sub(F.coalesce("_next", "ds"), 1))
    return (
        series.select("series_id", "ds", "y", following.alias("_next"))
        .select("series_id", "ds", "y", F.explode(F.sequence(F.col("ds"), last)).alias("_day"))
        .select("series_id", F.col("_day").alias("ds"), F.when(F.col("_day") == F.col("ds"), F.col("y")).alias("y"))
    )


def interpolate_linear(series: DataFrame) -> DataFrame:
    """Inner NULLs on the straight line between their neighbours, trailing NULLs as the last value.

    Leading NULLs stay. Both windows run forward from an unbounded start (one ascending, one descending), which
    costs one pass each; a frame that ends in unbounded following would be recomputed for every row.
    """
    point = F.when(F.col("y").isNotNull(), F.struct("ds", F.col("y").cast("double").alias("y")))
    part = Window.partitionBy("series_id")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    before = F.last(point, ignorenulls=True).over(part.orderBy("ds").rowsBetween(*so_far))
    after = F.last(point, ignorenulls=True).over(part.orderBy(F.desc("ds")).rowsBetween(*so_far))
    rows = series.select("series_id", "ds", F.col("y").cast("double").alias("y"), before.alias("_b"), after.alias("_a"))
    done = F.datediff("ds", "_b.ds")
    span = F.datediff("_a.ds", "_b.ds")
    line = F.col("_b.y") + (F.col("_a.y") - F.col("_b.y")) * done / span
    value = F.coalesce("y", F.when(F.col("_a").isNull(), F.col("_b.y")).otherwise(line))
    return rows.select("series_id", "ds", value.alias("y"))


def round_counts(series: DataFrame) -> DataFrame:
    """Whole numbers, halves to the even neighbour."""
    return series.withColumn("y", F.bround("y", 0))


def holdout_split(series: DataFrame, val: int = 15, test: int = 15, check: bool = True) -> DataFrame:
    """Adds `segment` by position from the end. A series of `val + test` days or fewer is an error."""
    part = Window.partitionBy("series_id")
    from_end = F.row_number().over(part.orderBy(F.desc("ds")))
    days = F.count(F.lit(1)).over(part)
    train, validation, held_out = SEGMENTS
    segment = (
        F.when(F.col("_from_end") <= test, F.lit(held_out))
        .when(F.col("_from_end") <= val + test, F.lit(validation))
        .otherwise(F.lit(train))
    )
    if check:
        short = F.concat(F.lit(f"a series needs more than {val + test} days: "), F.col("series_id"))
        segment = F.when(F.col("_days") <= val + test, F.raise_error(short)).otherwise(segment)
    return series.select("*", from_end.alias("_from_end"), days.alias("_days")).select(
        *series.columns, segment.alias("segment")
    )


def split_short(series: DataFrame, val: int = 15, test: int = 15) -> tuple[DataFrame, DataFrame]:
    """(series that can be split, one row per series that cannot: `series_id`, `days`, `error_reason`).

    With these taken out, `holdout_split` meets no error, and one short series does not stop the others.
    """
    days = F.count(F.lit(1)).over(Window.partitionBy("series_id"))
    counted = series.withColumn("_days", days)
    short = series.groupBy("series_id").agg(F.count(F.lit(1)).alias("days")).where(F.col("days") <= val + test)
    reason = F.lit(f"series_of_{val + test}_days_or_fewer").alias("error_reason")
    return counted.where(F.col("_days") > val + test).drop("_days"), short.select("series_id", "days", reason)


def seasonal_naive(series: DataFrame, season: int = 7, val: int = 15, test: int = 15) -> DataFrame:
    """Forecast of the test days by the last known value of the same weekday before them.

    `series` carries `segment`. The steps of a season repeat its last known days.
    """
    part = Window.partitionBy("series_id")
    from_end = F.row_number().over(part.orderBy(F.desc("ds")))
    rows = series.select("series_id", "ds", "y", "segment", from_end.alias("_from_end"))
    known = rows.where(F.col("_from_end").between(test + 1, test + season)).select(
        "series_id", (F.lit(test + season) - F.col("_from_end")).alias("_slot"), F.col("y").alias("yhat")
    )
    held_out = rows.where(F.col("segment") == SEGMENTS[2]).select(
        "series_id", "ds", "y", ((F.lit(test) - F.col("_from_end")) % season).alias("_slot")
    )
    return held_out.join(known, ["series_id", "_slot"]).select("series_id", "ds", "y", "yhat")


def accuracy(scored: DataFrame, actual: str = "y", predicted: str = "yhat", by: Sequence[str] = ("series_id",)) -> DataFrame:
    """MAE and RMSE per group."""
    error = F.col(actual) - F.col(predicted)
    return scored.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse")
    )
