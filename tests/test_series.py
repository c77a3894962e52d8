import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wardhouse.operators import exact, registry, series, sketches, state
from wardhouse.operators import forecast as fc
from wardhouse.plans import forecasting

START = dt.date(2026, 1, 1)


def frame(spark, values, name="s"):
    days = [(name, START + dt.timedelta(days=i), y) for i, y in values]
    return spark.createDataFrame(days, "series_id string, ds date, y double")


def wave(n):
    t = np.arange(n)
    return 100 + 0.5 * t + 20 * np.sin(2 * np.pi * t / 7) + np.random.default_rng(7).normal(0, 1, n)


def test_gaps_and_lines_match_pandas(spark):
    rng = np.random.default_rng(3)
    values = [(int(i), float(rng.integers(0, 100))) for i in sorted(rng.choice(200, 60, replace=False))]
    out = series.interpolate_linear(series.fill_gaps(frame(spark, values))).orderBy("ds").toPandas()
    want = pd.Series([y for _, y in values], index=pd.to_datetime([START + dt.timedelta(days=i) for i, _ in values])).asfreq("D").interpolate()
    assert list(pd.to_datetime(out.ds)) == list(want.index)
    np.testing.assert_allclose(out.y, want.values)


def test_leading_null_stays_and_trailing_null_takes_the_last_value(spark):
    df = frame(spark, [(0, None), (1, 2.0), (2, None), (3, 4.0), (4, None)])
    assert [r.y for r in series.interpolate_linear(df).orderBy("ds").collect()] == [None, 2.0, 3.0, 4.0, 4.0]


def test_counts_round_half_to_even(spark):
    assert [r.y for r in series.round_counts(frame(spark, [(0, 2.5), (1, 3.5), (2, 2.4)])).orderBy("ds").collect()] == [2.0, 4.0, 2.0]


def test_history_counts_patients_once_a_day(spark):
    fact = spark.createDataFrame([(20260101, 1, 10.0), (20260101, 1, 5.0), (20260103, 1, 1.0), (20260103, 2, 2.0)], "DateKey int, PatientKey int, RevenueAmount double")
    got = {(r.series_id, r.ds.day): r.y for r in forecasting.history(fact).collect()}
    assert got == {("revenue", 1): 15.0, ("revenue", 2): 9.0, ("revenue", 3): 3.0,
                   ("user_count", 1): 1.0, ("user_count", 2): 2.0, ("user_count", 3): 2.0}


def test_holdout_by_position_and_error_on_short_series(spark):
    labels = [r.segment for r in series.holdout_split(frame(spark, [(i, 1.0) for i in range(31)])).orderBy("ds").collect()]
    assert labels == ["train"] + ["validation"] * 15 + ["test"] * 15
    with pytest.raises(PySparkException, match="more than 30 days"):
        series.holdout_split(frame(spark, [(i, 1.0) for i in range(30)])).collect()


def test_accuracy(spark):
    df = spark.createDataFrame([("s", 1.0, 2.0), ("s", 5.0, 2.0)], "series_id string, y double, yhat double")
    assert tuple(series.accuracy(df).first()) == ("s", 2.0, pytest.approx(5 ** 0.5))


def test_grid_has_729_candidates_in_search_order(spark):
    grid = [tuple(r) for r in fc.candidate_grid(spark).orderBy("pos").collect()]
    want = [(i, *o, 7) for i, o in enumerate((p, d, q, sp, sd, sq) for p in range(3) for d in range(3) for q in range(3)
                                             for sp in range(3) for sd in range(3) for sq in range(3))]
    assert grid == want


def test_fit_differences_only():
    y = np.array([3.0, 1, 4, 1, 5, 9, 2] * 4)
    np.testing.assert_allclose(fc.fit_forecast(y, (0, 0, 0, 0, 1, 0, 7), 9), np.r_[y[:7], y[:2]])
    np.testing.assert_allclose(fc.fit_forecast(np.arange(20.0), (0, 2, 0, 0, 0, 0, 7), 3), [20, 21, 22])
    np.testing.assert_allclose(fc.fit_forecast(np.arange(20.0), (0, 0, 0, 0, 0, 0, 7), 2), [0, 0])


def test_fit_recovers_an_autoregression():
    rng, y = np.random.default_rng(1), [0.0]
    for _ in range(4000):
        y.append(0.8 * y[-1] + rng.normal())
    np.testing.assert_allclose(fc.fit_forecast(np.array(y), (1, 0, 0, 0, 0, 0, 7), 2), [0.8 * y[-1], 0.64 * y[-1]], rtol=0.05)


def test_fit_recovers_a_moving_average():
    rng = np.random.default_rng(2)
    e = rng.normal(size=6001)
    y = e[1:] + 0.6 * e[:-1]
    assert fc.fit_forecast(y, (0, 0, 1, 0, 0, 0, 7), 2) == pytest.approx([0.6 * e[-1], 0.0], abs=0.15)


def test_fit_refuses_short_series():
    with pytest.raises(ValueError):
        fc.fit_forecast(np.arange(12.0), (2, 0, 2, 2, 0, 2, 7), 3)


def test_search_equals_a_plain_loop(spark):
    y = wave(120)
    split = series.holdout_split(frame(spark, [(i, float(v)) for i, v in enumerate(y)]))
    got = {r.pos: r.val_mae for r in fc.grid_search(split, values=2).collect()}
    want = {}
    for pos in range(64):
        order = tuple(pos // 2 ** (5 - i) % 2 for i in range(6)) + (7,)
        try:
            want[pos] = float(np.abs(y[90:105] - fc.fit_forecast(y[:90], order, 15)).mean())
        except ValueError:
            want[pos] = None
    assert got.keys() == want.keys()
    assert all(got[k] == (want[k] if want[k] is None else pytest.approx(want[k])) for k in want)


def test_failed_fits_give_null_and_ties_go_to_the_first(spark):
    def fit(y, order, steps):
        if order[0] == 0:
            raise ValueError("no fit")
        return np.full(steps, 1.0)

    split = series.holdout_split(frame(spark, [(i, 2.0) for i in range(40)]))
    scores = fc.grid_search(split, values=2, fit_fn=fit)
    assert scores.where("val_mae IS NULL").count() == 32
    best = fc.select_best(scores).first()
    assert (best.pos, best.p, best.val_mae) == (32, 1, 1.0)


def test_forecast_and_contest(spark):
    y = [(i, float(v)) for i, v in enumerate(wave(120))]
    split = series.holdout_split(frame(spark, y, "a").union(frame(spark, y, "b")))
    trained = forecasting.train(split, values=2)
    days = trained.predictions.where("series_id = 'a'").orderBy("ds").collect()
    assert [r.segment for r in days] == ["test"] * 15 + ["future"] * 30
    assert days[0].ds == START + dt.timedelta(days=105) and days[-1].ds == START + dt.timedelta(days=149)
    scores = {r.series_id: r.mae for r in trained.scores.collect()}
    assert scores["a"] == scores["b"] < 5
    rivals = forecasting.challengers(split, trained).cache()
    assert rivals.first().train_end == START + dt.timedelta(days=104)
    runs = registry.run_rows(trained.best, trained.scores, "r1")
    assert tuple(runs.columns) == registry.RUN_COLUMNS and runs.count() == 2

    # The champion of "a" is the rival itself (a draw promotes); "b" has a champion that cannot be scored.
    champions = rivals.where("series_id = 'a'").union(rivals.where("series_id = 'b'").withColumn("train_end", F.lit(START)))
    verdicts = {r.series_id: r for r in forecasting.contest(split, champions, rivals).collect()}
    assert verdicts["a"].old_mae == pytest.approx(scores["a"]) and verdicts["a"].promoted
    assert verdicts["b"].old_mae is None and verdicts["b"].promoted


def test_champion_stays_when_better(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("d", 9.0)], "series_id string, mae double")
    new = spark.createDataFrame([("a", 2.0), ("b", 3.0), ("c", 5.0)], "series_id string, mae double")
    verdicts = registry.promote(old, new)
    assert {r.series_id: r.promoted for r in verdicts.collect()} == {"a": False, "b": True, "c": True}
    assert sorted(map(tuple, registry.crown(old, verdicts).collect())) == [("a", 1.0), ("b", 3.0), ("c", 5.0), ("d", 9.0)]


def test_exact_search_equals_the_fits(spark):
    """Every order without moving-average terms, for a long, a short and a constant series."""
    y = wave(150)
    rows = frame(spark, [(i, float(v)) for i, v in enumerate(y)], "a").union(frame(spark, [(i, float(v)) for i, v in enumerate(y[:52])], "b"))
    split = series.holdout_split(rows)
    got = {(r.series_id, r.pos): r for r in exact.grid_search_exact(split).collect()}
    want = [r for r in fc.grid_search(split).collect() if r.q == 0 and r.sq == 0]
    assert len(got) == sum(r.series_id == "a" for r in want) + sum(k[0] == "b" for k in got) and len(want) == 162
    for r in want:
        found = got.get((r.series_id, r.pos))
        if r.val_mae is None:
            assert found is None or found.val_mae is None
        elif r.series_id == "a":
            assert found.val_mae == pytest.approx(r.val_mae, rel=1e-6) and tuple(found[1:9]) == tuple(r[1:9])
    best = fc.select_best(exact.grid_search_exact(split).where("series_id = 'a'"))
    said = {r.ds: (r.yhat, r.segment) for r in exact.forecast_exact(split, best).collect()}
    plain = {r.ds: (r.yhat, r.segment) for r in fc.forecast(split, best).collect()}
    assert said.keys() == plain.keys() and len(said) == 45
    assert all(said[k] == (pytest.approx(plain[k][0], rel=1e-6), plain[k][1]) for k in said)


def test_lags_that_depend_on_each_other_have_no_fit(spark):
    split = series.holdout_split(frame(spark, [(i, 5.0) for i in range(120)]))
    got = {r.pos: r.val_mae for r in exact.grid_search_exact(split, values=2).collect()}
    assert got[2**5] == pytest.approx(0.0) and got[2**5 + 2**2] is None and got[0] == 5.0


def test_solve(spark):
    a = np.array([[4.0, 1, 0.5], [1, 3, 0.2], [0.5, 0.2, 2]])
    b = np.array([1.0, -2, 3])
    rows = [[*map(float, r), float(v)] for r, v in zip(a, b)]
    df = spark.createDataFrame([(rows,), ([[1.0, 1.0, 2.0], [1.0, 1.0, 2.0]],), ([[2.0, 4.0]],), ([],)], "m array<array<double>>")
    found = [r[0] for r in df.select(exact.solve(F.col("m"), F.size("m"))).collect()]
    np.testing.assert_allclose(found[0], np.linalg.solve(a, b))
    assert found[1:] == [None, [2.0], []]


def test_states_forecast_without_python(spark):
    """Rolled in the engine and in numpy, with moving-average terms as well."""
    y, steps = wave(140), 20
    orders = [(1, 0, 1, 1, 0, 1, 7), (2, 1, 2, 0, 1, 1, 7), (0, 0, 0, 0, 1, 0, 7), (0, 2, 0, 0, 0, 0, 7), (0, 0, 0, 0, 0, 0, 7), (0, 1, 2, 2, 2, 0, 7)]
    states = [fc.fit_state(y, order) for order in orders]
    rows = [(str(i), START, *[s[name] for name in state.STATE_TYPES]) for i, s in enumerate(states)]
    df = spark.createDataFrame(rows, f"series_id string, last_ds date, {state.STATE}")
    out = state.forecast_from(df, F.lit(steps))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
    got = {}
    for r in sorted(out.collect(), key=lambda r: r.ds):
        got.setdefault(int(r.series_id), []).append(r.yhat)
    for i, order in enumerate(orders):
        np.testing.assert_allclose(got[i], fc.fit_forecast(y, order, steps), rtol=1e-9)
    assert state.forecast_from(df, F.lit(0)).count() == 0


def test_each_series_comes_back_once(spark):
    y = [(i, float(v)) for i, v in enumerate(wave(120))]
    frames = [frame(spark, y, name) for name in ("good", "next", "bad", "none")] + [frame(spark, y[:30], "short")]
    rows = frames[0]
    for more in frames[1:]:
        rows = rows.union(more)
    long, short = series.split_short(rows)
    assert [tuple(r) for r in short.collect()] == [("short", 30, "series_of_30_days_or_fewer")]
    split = series.holdout_split(long, check=False)
    orders = {name: 0 for name in fc.ORDERS}
    scored = [(s, pos, *[{**orders, "p": pos}[n] for n in fc.ORDERS], 7, None if s == "none" else float(mae)) for s in ("good", "next", "bad", "none")
              for pos, mae in ((0, 3), (1, 1), (2, float("nan")), (3, 2))]
    schema = "series_id string, pos int, " + ", ".join(f"{n} int" for n in fc.ORDERS) + ", season int, val_mae double"
    ranked = fc.ranked_candidates(spark.createDataFrame(scored, schema), most=2)
    assert {r.series_id: [c.pos for c in r.ranked] for r in ranked.collect()} == {"good": [1, 3], "next": [1, 3], "bad": [1, 3], "none": []}

    known = split.where("segment <> 'test'").withColumn("y", F.when(F.col("series_id") == "bad", -F.col("y")).when(F.col("series_id") == "next", F.col("y") + 1e6).otherwise(F.col("y")))

    def fit(values, order, steps):
        if values[0] < 0:
            raise RuntimeError("never")
        if values[0] > 1e5 and order[0] == 1:
            raise KeyError("not this one")
        return np.full(steps, float(order[0]))

    fits = {r.series_id: r for r in fc.fit_in_turn(known, ranked, 3, fit).collect()}
    assert {k: (r.status, r.pos, len(r.errors)) for k, r in fits.items()} == {
        "good": ("fitted", 1, 0), "next": ("fallback", 3, 1), "bad": ("failed", None, 2), "none": ("no_candidate", None, 0)}
    assert fits["next"].yhats == [3.0] * 3 and "not this one" in fits["next"].errors[0] and fits["bad"].yhats is None
    status = {r.series_id: r.status for r in forecasting.status(spark.createDataFrame(fits.values(), fc.fit_in_turn(known, ranked, 3, fit).schema), short).collect()}
    assert status == {"good": "fitted", "next": "fallback", "bad": "failed", "none": "no_candidate", "short": "too_short"}


def test_a_champion_speaks_from_its_state(spark):
    y = [(i, float(v)) for i, v in enumerate(wave(120))]
    split = series.holdout_split(frame(spark, y, "a").union(frame(spark, y, "b")))
    order = dict(zip((*fc.ORDERS, "season"), (1, 0, 1, 1, 1, 0, 7)))
    plain = spark.createDataFrame([(s, START + dt.timedelta(days=80), *order.values()) for s in "ab"], "series_id string, train_end date, " + ", ".join(f"{n} int" for n in order))
    want = {(r.series_id, r.ds): r.yhat for r in fc.champion_forecast(split, plain).collect()}
    found = fc.fit_state(np.array([v for _, v in y[:81]]), tuple(order.values()))
    kept = spark.createDataFrame([("a", *[found[n] for n in state.STATE_TYPES])], f"series_id string, {state.STATE}")
    # "a" has a state, "b" none and is refitted.
    got = fc.champion_forecast(split, plain.join(kept, "series_id", "left"))
    assert {(r.series_id, r.ds): r.yhat for r in got.collect()} == {k: pytest.approx(v) for k, v in want.items()} and len(want) == 30


def test_work_is_dealt_by_cost(spark):
    costs = [fc.fit_cost(tuple(r)[1:]) for r in fc.candidate_grid(spark).orderBy("pos").collect()]
    assert max(costs) > 50 * min(costs)
    hands = fc.deal(costs, 27)
    assert sorted(i for h in hands for i in h) == list(range(729))
    sums = [sum(costs[i] for i in h) for h in hands]
    assert max(sums) <= 1.05 * min(sums) and fc.deal([1.0, 2.0], 27) == [[1], [0]] and fc.deal([], 5) == [[]]
    # Two series or many of different length: tasks within a factor of two.
    for lengths, tasks in (([900, 900], 32), ([40 + 10 * i for i in range(100)], 32)):
        packed = spark.createDataFrame([(f"s{i}", [0.0] * n) for i, n in enumerate(lengths)], "series_id string, ys array<double>")
        work = fc.dealt_work(packed, 27, tasks)
        loads = [r[0] for r in work.groupBy(F.spark_partition_id()).agg(F.sum(F.size("ys"))).select("sum(size(ys))").collect()]
        assert len(loads) == tasks and max(loads) <= 2 * min(loads)


def test_refreshed_days(spark):
    totals = [F.sum("v").alias("v")]
    old = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "day int, v long")
    fact = spark.createDataFrame([(1, 1), (2, 5), (2, 6), (4, 7)], "day int, v long")
    touched = spark.createDataFrame([(2,), (3,), (4,), (4,)], "day int")
    out = series.refresh_days(old, fact, touched, "day", totals)
    assert sorted(map(tuple, out.collect())) == [(1, 10), (2, 11), (4, 7)]
    assert sorted(map(tuple, series.refresh_days(old, fact, touched.limit(0), "day", totals).collect())) == [(1, 10), (2, 20), (3, 30)]


def test_only_touched_days_are_read(spark, tmp_path):
    spark.range(0, 100_000, 1, 1).select((F.col("id") / 100).cast("int").alias("day"), "id").write.parquet(f"{tmp_path}/fact", mode="overwrite")
    fact = spark.read.parquet(f"{tmp_path}/fact")
    touched = spark.createDataFrame([(5,), (7,)], "day int")
    out = series.refresh_days(fact.groupBy("day").agg(F.sum("id").alias("v")), fact, touched, "day", [F.sum("id").alias("v")])
    assert "PushedFilters: [In(day, [5,7])]" in out._jdf.queryExecution().executedPlan().toString()
    before = series.LISTED_DAYS
    series.LISTED_DAYS = 1
    try:
        joined = series.refresh_days(fact.groupBy("day").agg(F.sum("id").alias("v")), fact, touched, "day", [F.sum("id").alias("v")])
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, out.collect()))
    finally:
        series.LISTED_DAYS = before


def test_sketches_add_up(spark):
    fact = spark.range(60_000).select((F.col("id") % 30).cast("int").alias("day"), (F.col("id") % 7_001).alias("who"))
    days = sketches.daily_sketches(fact.union(spark.createDataFrame([(1, None)], "day int, who long")), "day", "who")
    assert days.count() == 30
    whole = sketches.distinct_over(days, F.lit("all")).first().n
    assert abs(whole - 7_001) < 0.03 * 7_001
    fresh = sketches.daily_sketches(spark.createDataFrame([(3, 1), (3, 2)], "day int, who long"), "day", "who")
    replaced = {r.period: r.n for r in sketches.distinct_over(sketches.replace_days(days, fresh, "day"), F.col("day")).collect()}
    assert replaced[3] == 2 and len(replaced) == 30
