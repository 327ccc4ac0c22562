import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from sluice.operators import forecast as fc


def _monthly(spark, values, start=(2020, 1), region=None):
    y, m = start
    rows = []
    for v in values:
        rows.append((region, f"{y:04d}-{m:02d}", float(v)))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return spark.createDataFrame(rows, "region string, year_month string, monthly_revenue double")


def _lines(spark, n, slope=2.0, base=100.0, regions=("A", "B")):
    dfs = [_monthly(spark, [base + slope * i for i in range(n)], region=r) for r in regions]
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def test_series_drops_partial_last_month_and_null(spark):
    m = _monthly(spark, [1e7, 2e7, 3e7]).unionByName(
        spark.createDataFrame([(None, None, 5.0)], "region string, year_month string, monthly_revenue double"))
    s = fc.forecast_series(m).orderBy("month").collect()
    assert [(r.month, r.y) for r in s] == [(dt.date(2020, 1, 1), 1.0), (dt.date(2020, 2, 1), 2.0)]


def test_series_per_key(spark):
    s = fc.forecast_series(_lines(spark, 5), ["region"], scale=1.0)
    assert s.count() == 8 and s.filter("region = 'A'").agg(F.max("month")).first()[0] == dt.date(2020, 4, 1)


def test_holdout_split(spark):
    s = fc.holdout_split(fc.forecast_series(_monthly(spark, range(1, 8)), scale=1.0), holdout=2)
    tests = [r.month for r in s.filter("split = 'test'").orderBy("month").collect()]
    assert tests == [dt.date(2020, 5, 1), dt.date(2020, 6, 1)]
    with pytest.raises(ValueError):
        fc.holdout_split(s, holdout=0)


def test_trend_fit_recovers_known_line(spark):
    split = fc.holdout_split(fc.forecast_series(_lines(spark, 20, slope=3.0), ["region"], 1.0), ["region"], 2)
    for r in fc.trend_fit(split, ["region"]).collect():
        assert math.isclose(r.slope, 3.0, rel_tol=1e-9) and r.train_months == 17


def test_trend_forecast_shape_and_flags(spark):
    split = fc.holdout_split(fc.forecast_series(_lines(spark, 20), ["region"], 1.0), ["region"], 2)
    pred = fc.predict_trend(split, ["region"], horizon=6)
    table = fc.forecast_table(pred, ["region"]).filter("region = 'A'")
    # 17 training months + 6 months after the last one (2 of them are holdout months with actuals)
    assert table.count() == 23
    assert table.filter("is_forecast").count() == 4
    last = table.orderBy(F.desc("month")).first()
    # exact line: y = 100 + 2 * i, month index 22 -> 144
    assert last.month == "2021-11" and last.forecast_revenue == 144.0 and last.forecast_lower == 144.0


def test_accuracy_zero_on_exact_line(spark):
    split = fc.holdout_split(fc.forecast_series(_lines(spark, 12), ["region"], 1.0), ["region"], 3)
    acc = fc.forecast_accuracy(fc.predict_trend(split, ["region"]), ["region"]).collect()
    assert all(r.mae == 0.0 and r.mape_pct == 0.0 and r.test_months == 3 and r.train_months == 8 for r in acc)


def test_accuracy_formula(spark):
    pred = spark.createDataFrame(
        [(dt.date(2020, 1, 1), 10.0, 8.0, "test"), (dt.date(2020, 2, 1), 20.0, 25.0, "test"), (dt.date(2019, 12, 1), 1.0, 1.0, "train")],
        "month date, actual double, yhat double, split string")
    r = fc.forecast_accuracy(pred).first()
    assert r.mae == 3.5 and r.mape_pct == 22.5 and r.train_months == 1


def test_seasonal_model_follows_trend_and_season(spark):
    vals = [50 + 1.5 * i + 5 * math.sin(2 * math.pi * i / 3) for i in range(36)]
    split = fc.holdout_split(fc.forecast_series(_monthly(spark, vals, region="A"), ["region"], 1.0), ["region"], 3)
    pred = fc.predict_seasonal(split, ["region"], horizon=6)
    acc = fc.forecast_accuracy(pred, ["region"]).first()
    assert acc.mape_pct < 5.0 and acc.test_months == 3 and acc.train_months == 32
    table = fc.forecast_table(pred, ["region"])
    assert table.count() == 32 + 6
    assert table.filter("forecast_lower <= forecast_revenue AND forecast_revenue <= forecast_upper").count() == 38


def test_seasonal_short_series_gives_nulls(spark):
    split = fc.holdout_split(fc.forecast_series(_monthly(spark, [1, 2, 3, 4], region="A"), ["region"], 1.0), ["region"], 1)
    pred = fc.predict_seasonal(split, ["region"])
    assert pred.filter("yhat IS NOT NULL").count() == 0 and pred.count() > 0


def test_global_series_seasonal_and_runs(spark):
    vals = [1e7 * (1 + 0.05 * i) for i in range(24)]
    table, runs = fc.forecast_revenue(_monthly(spark, vals).drop("region"), (), horizon=6, holdout=2)
    assert table.count() == 21 + 6  # 24 months - partial last - 2 holdout, + horizon
    r = runs.first()
    assert r.model == "seasonal" and r.train_months == 21 and r.test_months == 2 and r.fourier_order == 3


def test_anchor_data_forecasts_after_last_month(spark):
    split = fc.holdout_split(fc.forecast_series(_lines(spark, 20), ["region"], 1.0), ["region"], 2)
    for model in (fc.predict_trend, fc.predict_seasonal):
        table = fc.forecast_table(model(split, ["region"], 6, anchor="data"), ["region"]).filter("region = 'A'")
        # 17 training + 2 holdout months + 6 months after the last month with data
        assert table.count() == 25 and table.filter("is_forecast").count() == 6
    with pytest.raises(ValueError):
        fc.predict_trend(split, ["region"], anchor="later")


def test_short_series_reported_in_runs(spark):
    split = fc.holdout_split(fc.forecast_series(_monthly(spark, [1, 2, 3, 4], region="A"), ["region"], 1.0), ["region"], 1)
    acc = fc.forecast_accuracy(fc.predict_seasonal(split, ["region"]), ["region"])
    r = fc.forecast_runs(acc, "seasonal", 6, 1).first()
    assert r.fit_status == "too_short" and r.mae is None


def test_no_training_months_gives_nulls_not_errors(spark):
    split = fc.holdout_split(fc.forecast_series(_lines(spark, 4), ["region"], 1.0), ["region"], 5)
    for model in (fc.predict_trend, fc.predict_seasonal):
        pred = model(split, ["region"])
        assert pred.filter("yhat IS NOT NULL").count() == 0
        acc = fc.forecast_accuracy(pred, ["region"]).collect()
        assert all(r.train_months == 0 and r.mae is None for r in acc)


def test_null_series_key_is_its_own_series(spark):
    m = _lines(spark, 10, regions=("A",)).unionByName(_monthly(spark, [5.0 + i for i in range(10)], region=None))
    split = fc.holdout_split(fc.forecast_series(m, ["region"], 1.0), ["region"], 2)
    for model in (fc.predict_trend, fc.predict_seasonal):
        t = fc.forecast_table(model(split, ["region"], 3), ["region"])
        assert t.filter("region IS NULL").count() == 7 + 3


def test_a_series_that_ended_early_keeps_its_last_month(spark):
    m = _monthly(spark, [1, 2, 3], region="gone").unionByName(_monthly(spark, [1, 2, 3, 4, 5], region="here"))
    s = {(r.region, r.month.month) for r in fc.forecast_series(m, ["region"], 1.0).collect()}
    assert s == {("gone", 1), ("gone", 2), ("gone", 3), ("here", 1), ("here", 2), ("here", 3), ("here", 4)}


def test_a_month_without_a_value_is_left_out(spark):
    vals = [100.0 + 2 * i for i in range(20)]
    m = _monthly(spark, vals, region="A").withColumn(
        "monthly_revenue", F.when(F.col("year_month") != "2020-05", F.col("monthly_revenue")))
    split = fc.holdout_split(fc.forecast_series(m, ["region"], 1.0), ["region"], 2)
    for model in (fc.predict_trend, fc.predict_seasonal):
        pred = model(split, ["region"])
        assert pred.filter("yhat IS NULL").count() == 0
        acc = fc.forecast_accuracy(pred, ["region"]).first()
        assert acc.train_months == 16 and acc.mape_pct < 2.0


def test_one_length_rule_for_both_models(spark):
    split = fc.holdout_split(fc.forecast_series(_lines(spark, 4), ["region"], 1.0), ["region"], 1)  # two training months
    for model, name in ((fc.predict_trend, "trend"), (fc.predict_seasonal, "seasonal")):
        pred = model(split, ["region"])
        assert pred.filter("yhat IS NOT NULL").count() == 0
        runs = fc.forecast_runs(fc.forecast_accuracy(pred, ["region"]), name, 6, 1).collect()
        assert {r.fit_status for r in runs} == {"too_short"}


def test_the_trend_may_bend(spark):
    vals = [100.0 + 5 * i for i in range(20)] + [195.0 - 4 * i for i in range(1, 41)]
    split = fc.holdout_split(fc.forecast_series(_monthly(spark, vals, region="A"), ["region"], 1.0), ["region"], 3)
    bent = fc.forecast_accuracy(fc.predict_seasonal(split, ["region"]), ["region"]).first()
    straight = fc.forecast_accuracy(fc.predict_trend(split, ["region"]), ["region"]).first()
    assert bent.mae < straight.mae / 2


def test_seasonal_fit_satisfies_its_equations(spark):
    vals = [50 + 1.5 * i + 5 * math.sin(2 * math.pi * i / 3) for i in range(30)]
    both = _monthly(spark, vals, region="A").unionByName(_monthly(spark, [1, 2, 3], region="B"))
    split = fc.holdout_split(fc.forecast_series(both, ["region"], 1.0), ["region"], 2)
    pred = fc.predict_seasonal(split, ["region"], with_fit=True)
    gaps = {r.region: r for r in fc.fit_gap(pred, ["region"]).collect()}
    assert gaps["A"].equation_gap < 1e-8 and gaps["A"].forecast_gap < 1e-8
    assert gaps["B"].equation_gap is None
    # the check sees a wrong coefficient
    wrong = pred.withColumn("beta", F.transform("beta", lambda b, i: F.when(i == 1, b * 1.01).otherwise(b)))
    off = {r.region: r for r in fc.fit_gap(wrong, ["region"]).collect()}["A"]
    assert off.equation_gap > 1e-3 and off.forecast_gap > 1e-4


def test_one_bend_is_found_as_one_and_none_as_none(spark):
    bent = [100.0 + 5 * i for i in range(30)] + [245.0 - 4 * i for i in range(1, 41)]
    straight = [100.0 + 3 * i for i in range(70)]
    both = _monthly(spark, bent, region="bent").unionByName(_monthly(spark, straight, region="straight"))
    split = fc.holdout_split(fc.forecast_series(both, ["region"], 1.0), ["region"], 3)
    pred = fc.predict_seasonal(split, ["region"], with_fit=True)
    gaps = {r.region: r for r in fc.fit_gap(pred, ["region"]).collect()}
    assert gaps["bent"].bends == 1 and gaps["straight"].bends == 0
    assert max(g.equation_gap for g in gaps.values()) < 1e-9
    fit = pred.where("region = 'bent'").first()
    changes = list(zip(fit.knots, fit.beta[2:]))
    assert sum(c != 0 for _, c in changes) <= 3  # neighbouring places share one change
    where = sum(k * c for k, c in changes) / sum(c for _, c in changes) * fit.span / 30.44
    assert abs(where - 29) < 3  # months after the first


def test_a_bend_that_is_zero_breaks_its_condition_when_the_prior_is_wider(spark):
    """The check sees a fit made under another prior."""
    vals = [100.0 + 5 * i for i in range(30)] + [245.0 - 4 * i for i in range(1, 41)]
    split = fc.holdout_split(fc.forecast_series(_monthly(spark, vals, region="A"), ["region"], 1.0), ["region"], 3)
    pred = fc.predict_seasonal(split, ["region"], with_fit=True, change_scale=0.0005)
    assert fc.fit_gap(pred, ["region"], change_scale=0.0005).first().equation_gap < 1e-9
    assert fc.fit_gap(pred, ["region"]).first().equation_gap > 1e-4


def _noisy(seed, n=60, bends=((0.4, 1.5), (0.6, -2.0)), sd=0.03):
    import numpy as np

    r = np.random.default_rng(seed)
    t = np.arange(n) / n
    y = 1 + 0.5 * t + sum(c * np.maximum(0, t - at) for at, c in bends) + sd * r.standard_normal(n)
    return (100 * y).tolist()


def test_the_band_widens_after_the_training_months(spark):
    split = fc.holdout_split(fc.forecast_series(_monthly(spark, _noisy(1), region="A"), ["region"], 1.0), ["region"], 3)
    rows = fc.predict_seasonal(split, ["region"], horizon=24).orderBy("month").collect()
    widths = [(r.split, r.upper - r.lower) for r in rows]
    train = {round(w, 9) for s, w in widths if s == "train"}
    assert len(train) == 1  # noise alone
    after = [w for s, w in widths if s != "train"]
    assert after[-1] > 1.5 * max(train) and all(b > 0.97 * a for a, b in zip(after, after[1:]))
    assert all(abs((r.upper - r.yhat) - (r.yhat - r.lower)) < 1e-6 * r.upper for r in rows)


def test_the_band_does_not_depend_on_partitions(spark):
    both = _monthly(spark, _noisy(2), region="A").unionByName(_monthly(spark, _noisy(3), region="B"))
    results = []
    for n in (1, 7):
        split = fc.holdout_split(fc.forecast_series(both.repartition(n), ["region"], 1.0), ["region"], 3)
        results.append(sorted(map(tuple, fc.predict_seasonal(split.repartition(n, "month"), ["region"]).collect())))
    assert results[0] == results[1]
    alone = fc.holdout_split(fc.forecast_series(both.where("region = 'B'"), ["region"], 1.0), ["region"], 3)
    assert sorted(map(tuple, fc.predict_seasonal(alone, ["region"]).collect())) == [r for r in results[0] if r[0] == "B"]


def test_the_band_covers_known_series(spark):
    """Straight lines with noise: about 80% of the holdout lies in an 80% band, about half in a 50% one."""
    parts = [_monthly(spark, _noisy(100 + i, 48, bends=()), region=f"s{i:02d}") for i in range(40)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    split = fc.holdout_split(fc.forecast_series(whole.coalesce(4), ["region"], 1.0), ["region"], 6).cache()
    for interval, low, high in ((0.8, 0.68, 0.92), (0.5, 0.36, 0.66)):
        test = fc.predict_seasonal(split, ["region"], interval=interval).where("split = 'test'")
        share = test.select(F.avg(F.col("actual").between(F.col("lower"), F.col("upper")).cast("double"))).first()[0]
        assert low < share < high, (interval, share)


def test_one_place_and_no_season_has_a_closed_form(spark):
    """Soft threshold of the hinge, cleared of level and slope."""
    import numpy as np

    vals = _noisy(9, 50)
    split = fc.holdout_split(fc.forecast_series(_monthly(spark, vals, region="A"), ["region"], 1.0), ["region"], 2)
    for noise in (1e-4, 10.0):
        fit = fc.predict_seasonal(split, ["region"], order=0, changepoints=1, noise=noise, with_fit=True).orderBy("month").collect()
        train = [r for r in fit if r.split == "train"]
        t = np.array([(r.month - fit[0].origin).days / fit[0].span for r in train])
        y = np.array([r.actual for r in train]) / fit[0].scale
        h = np.maximum(0, t - fit[0].knots[0])
        line = np.column_stack([np.ones_like(t), t])
        rest = h - line @ np.linalg.lstsq(line, h, rcond=None)[0]
        pull = rest @ y
        change = np.sign(pull) * max(abs(pull) - noise / fc.CHANGEPOINT_PRIOR_SCALE, 0) / (rest @ rest)
        level, slope = np.linalg.lstsq(line, y - change * h, rcond=None)[0]
        np.testing.assert_allclose(fit[0].beta, [level, slope, change], atol=1e-10)
        assert (change == 0) == (noise == 10.0)


def test_an_interval_must_be_a_share(spark):
    split = fc.holdout_split(fc.forecast_series(_monthly(spark, _noisy(1), region="A"), ["region"], 1.0), ["region"], 3)
    with pytest.raises(ValueError):
        fc.predict_seasonal(split, ["region"], interval=1.0)
