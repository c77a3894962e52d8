"""Autoregressive orders fitted from sums of products: least squares without Python.

The coefficients of a least-squares fit need only the sums of products of the lagged values. One pass over the days makes
them for all candidates of a difference; the small systems are then solved by higher-order functions, a row per candidate.
Orders with moving-average terms need residuals of a first fit, which is why they stay with `operators.forecast`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardhouse.operators.forecast import ORDERS, pack
from wardhouse.operators.series import SEGMENTS
from wardhouse.operators.state import difference_factors, forecast_from, forecasts, lags_of

# A pivot that lost so much of its size says that the lags depend on each other.
SINGULAR = 1e-10


def _all_lags(values: int, season: int) -> list[int]:
    return lags_of(values - 1, values - 1, season)


def _reach(values: int, season: int) -> int:
    """How far the widest difference looks back."""
    return (values - 1) * (1 + season)


def _doubles(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values]) if values else F.array().cast("array<double>")


def _ints(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)) for v in values]) if values else F.array().cast("array<int>")


def _differences(values: int, season: int) -> Column:
    return F.array(*[
        F.struct(F.lit(d).alias("d"), F.lit(sd).alias("sd"), _doubles(difference_factors(d, sd, season)).alias("difference"))
        for d in range(values) for sd in range(values)
    ])


def _terms(values: int, season: int) -> Column:
    """The (p, sp) pairs with their lags, the places of these among all lags, and how many lags must be known."""
    every = _all_lags(values, season)
    rows = []
    for p in range(values):
        for sp in range(values):
            lags = lags_of(p, sp, season)
            need = every.index(lags[-1]) + 1 if lags else 0
            rows.append(F.struct(
                F.lit(p).alias("p"), F.lit(sp).alias("sp"), _ints(lags).alias("ar_lags"),
                _ints([every.index(k) for k in lags]).alias("places"), F.lit(need).alias("need"),
            ))
    return F.array(*rows)


def differenced(series: DataFrame, values: int = 3, season: int = 7) -> DataFrame:
    """`series_id`, `ds`, `d`, `sd`, `w`: the series under each difference, from the first day that has one.

    Values follow each other by day; days without a value are left out, as in `pack`.
    """
    known = series.where(F.col("y").isNotNull()).select("series_id", "ds", F.col("y").cast("double").alias("y"))
    by_day = Window.partitionBy("series_id").orderBy("ds")
    past = F.collect_list("y").over(by_day.rowsBetween(-_reach(values, season), Window.currentRow))
    rows = known.select("series_id", "ds", past.alias("_past")).select("*", F.explode(_differences(values, season)).alias("_by"))
    rows = rows.where(F.size("_past") >= F.size("_by.difference"))
    parts = F.transform(F.col("_by.difference"), lambda c, k: c * F.element_at("_past", -k - 1))
    w = F.aggregate(parts, F.lit(0.0), lambda total, x: total + x)
    return rows.select("series_id", "ds", "_by.d", "_by.sd", w.alias("w"))


def sums_of_products(series: DataFrame, values: int = 3, season: int = 7) -> DataFrame:
    """`series_id`, `d`, `sd`, `p`, `sp`, `ar_lags`, `places`, `n` and `gram`: the sums of products of all lags and, as
    the last row and column, the value itself, over the days on which the candidate's lags are all known.

    Days are added up once per difference, by how many of the lags they have; only these few sums are dealt to the candidates.
    Everything is grouped by series, so one shuffle serves the windows and both aggregates.
    """
    lags = _all_lags(values, season)
    by_day = Window.partitionBy("series_id", "d", "sd").orderBy("ds")
    shifted = [F.lag("w", k).over(by_day).alias(f"x{i}") for i, k in enumerate(lags)]
    rows = differenced(series, values, season).select("series_id", "d", "sd", F.col("w").alias(f"x{len(lags)}"), *shifted)
    known = sum((F.col(f"x{i}").isNotNull().cast("int") for i in range(len(lags))), F.lit(0))
    pairs = [(i, j) for i in range(len(lags) + 1) for j in range(i + 1)]
    product = lambda i, j: F.coalesce(F.sum(F.col(f"x{i}") * F.col(f"x{j}")), F.lit(0.0)).alias(f"g{i}_{j}")
    classes = rows.groupBy("series_id", "d", "sd", known.alias("known")).agg(F.count(F.lit(1)).alias("n"), *[product(i, j) for i, j in pairs])
    dealt = classes.select("*", F.explode(_terms(values, season)).alias("t")).where(F.col("known") >= F.col("t.need"))
    summed = dealt.groupBy("series_id", "d", "sd", "t.p", "t.sp").agg(
        F.first("t.ar_lags").alias("ar_lags"), F.first("t.places").alias("places"), F.sum("n").alias("n"),
        *[F.sum(f"g{i}_{j}").alias(f"g{i}_{j}") for i, j in pairs],
    )
    cell = lambda i, j: F.col(f"g{max(i, j)}_{min(i, j)}")
    gram = F.array(*[F.array(*[cell(i, j) for j in range(len(lags) + 1)]) for i in range(len(lags) + 1)])
    return summed.select("series_id", "d", "sd", "p", "sp", "ar_lags", "places", "n", gram.alias("gram"))


def solve(matrix: Column, size: Column) -> Column:
    """The solution of a symmetric positive system given as rows with the right side as last entry; NULL if it is singular.

    Gauss and Jordan's elimination: each turn makes one column a unit column. Sizes are those of the lags, a handful.
    """
    diagonal = F.transform(matrix, lambda row, i: F.get(row, i))

    def turn(rows: Column, j: Column) -> Column:
        own = F.get(rows, j)
        pivot = F.get(own, j)
        sure = F.when(pivot > SINGULAR * F.get(diagonal, j), pivot)
        unit = F.transform(own, lambda x: x / sure)
        return F.transform(rows, lambda row, i: F.when(i == j, unit).otherwise(F.zip_with(row, unit, lambda a, b: a - F.get(row, j) * b)))

    done = F.aggregate(F.sequence(F.lit(0), size - 1), matrix, turn)
    solution = F.transform(done, lambda row: F.element_at(row, -1))
    sound = F.forall(solution, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(size > 0, F.when(F.coalesce(sound, F.lit(False)), solution)).otherwise(F.array().cast("array<double>"))


def fit_states(series: DataFrame, values: int = 3, season: int = 7) -> DataFrame:
    """The state of every candidate without moving-average terms: `series_id`, `pos`, orders, `season`, `last_ds`, the state.

    `pos` is the candidate's place in the whole grid. `ar_coef` is NULL where the series is too short or the lags
    depend on each other.
    """
    sums = sums_of_products(series, values, season)
    last = _all_lags(values, season)
    picked = lambda i: F.concat(
        F.transform("places", lambda j: F.get(F.get("gram", i), j)), F.array(F.get(F.get("gram", i), F.lit(len(last))))
    )
    k = F.size("places")
    fitted = sums.select(
        "series_id", "d", "sd", "p", "sp", "ar_lags",
        F.when(F.col("n") > k + 1, solve(F.transform("places", picked), k)).alias("ar_coef"),
    )

    ends = pack(series).select("series_id", "last_ds", F.reverse("ys").alias("_back"))
    by = ends.select("series_id", "last_ds", "_back", F.explode(_differences(values, season)).alias("_by"))
    value = lambda k: F.aggregate(
        F.transform(F.col("_by.difference"), lambda c, m: c * F.get("_back", k + m)), F.lit(0.0), lambda total, x: total + x
    )
    tail = F.reverse(F.transform(F.sequence(F.lit(0), F.lit(last[-1] - 1)), value))
    by = by.select(
        "series_id", "last_ds", F.col("_by.d").alias("_d"), F.col("_by.sd").alias("_sd"), "_by.difference", tail.alias("w_tail"),
        F.reverse(F.slice("_back", 1, _reach(values, season))).alias("y_tail"),
    ).withColumnRenamed("series_id", "_series")
    same = (F.col("series_id") == F.col("_series")) & (F.col("d") == F.col("_d")) & (F.col("sd") == F.col("_sd"))
    place = sum((F.col(name) * values ** (5 - ORDERS.index(name)) for name in ("p", "d", "sp", "sd")), F.lit(0))
    zero = F.lit(0)
    return fitted.join(by, same).select(
        "series_id", place.cast("int").alias("pos"), "p", "d", zero.alias("q"), "sp", "sd", zero.alias("sq"), F.lit(season).alias("season"),
        "last_ds", "ar_lags", "ar_coef", _ints([]).alias("ma_lags"), _doubles([]).alias("ma_coef"), "difference", "w_tail",
        _doubles([]).alias("noise_tail"), "y_tail",
    )


def grid_search_exact(series: DataFrame, values: int = 3, season: int = 7) -> DataFrame:
    """`forecast.grid_search` over the candidates with q = sq = 0: the same columns and scores, no Python.

    `series` carries `segment`. A candidate that cannot be fitted has a NULL score.
    """
    train, validation, _ = SEGMENTS
    states = fit_states(series.where(F.col("segment") == train), values, season)
    actual = pack(series.where(F.col("segment") == validation)).select(F.col("series_id").alias("_series"), F.col("ys").alias("_actual"))
    rows = states.join(actual, F.col("series_id") == F.col("_series"))
    steps = F.size("_actual")
    errors = F.zip_with(forecasts(steps), "_actual", lambda a, b: F.abs(a - b))
    mean = F.aggregate(errors, F.lit(0.0), lambda total, x: total + x) / F.when(steps > 0, steps)
    sound = F.when(~F.isnan(mean) & (mean < float("inf")), mean)
    return rows.select("series_id", "pos", *ORDERS, "season", sound.alias("val_mae"))


def states_of(series: DataFrame, best: DataFrame, values: int = 3, season: int = 7) -> DataFrame:
    """The states of the chosen candidates (`series_id`, `pos`), fitted on all of `series`."""
    chosen = best.select(F.col("series_id").alias("_series"), F.col("pos").alias("_pos"))
    states = fit_states(series, values, season)
    return states.join(chosen, (F.col("series_id") == F.col("_series")) & (F.col("pos") == F.col("_pos")), "left_semi")


def forecast_exact(series: DataFrame, best: DataFrame, test: int = 15, future: int = 30, values: int = 3, season: int = 7) -> DataFrame:
    """`forecast.forecast` for candidates without moving-average terms."""
    train, validation, held_out = SEGMENTS
    states = states_of(series.where(F.col("segment").isin(train, validation)), best, values, season)
    said = forecast_from(states, F.lit(test + future))
    segment = F.when(F.col("_step") < test, F.lit(held_out)).otherwise(F.lit("future"))
    return said.select("series_id", "ds", "yhat", segment.alias("segment"))
