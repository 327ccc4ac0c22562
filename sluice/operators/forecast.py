"""Monthly revenue forecasting for many series at once.

Both models write the same *prediction frame*, one row per series and month:

    keys..., month DATE, actual DOUBLE, yhat, lower, upper DOUBLE,
    split STRING ('train' | 'test' | 'future'), in_frame BOOLEAN

``in_frame`` marks the rows of the forecast table: the training months plus
``horizon`` months after the last training month (so holdout months inside
the horizon are forecast *and* have actuals, as in the reference).

* ``predict_trend``: least-squares line per series from ``regr_*`` window
  aggregates (plain SQL, checkable against another engine).
* ``predict_seasonal``: trend with sparse changepoints + Fourier terms of a 91.25-day
  season, fitted per series with ``applyInPandas`` (``trend.py``); each series is one
  small group, so series fit in parallel and never meet on the driver.

Series are monthly aggregates (one row per month), so a window over one series
holds at most a few hundred rows whatever the size of the order table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DateType, DoubleType, StringType, StructField, StructType

from sluice.functions import month_start
from sluice.operators import trend

# Fixed values of the reference model set-up.
SCALE_CRORE = 1e7
SEASON_PERIOD_DAYS = 91.25
FOURIER_ORDER = 3
INTERVAL_WIDTH = 0.80
SEASONALITY_PRIOR_SCALE = 10.0
MAPE_EPS = 1e-9
CHANGEPOINT_PRIOR_SCALE = 0.05
MAX_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
Z80 = 1.2815515655446004  # two-sided 80% normal quantile
#: Fewer training months than this leave a series without a forecast, in every model.
MIN_TRAIN_MONTHS = 3


def _w(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys)


# --- F1 / F2 ------------------------------------------------------------------

def forecast_series(monthly: DataFrame, keys: Sequence[str] = (), scale: float = SCALE_CRORE) -> DataFrame:
    """``(keys..., month DATE, y)`` with ``y = monthly_revenue / scale``.

    NULL months are dropped first, then the latest month of the whole data set
    (it is still running); a series that ended earlier keeps its last month.
    """
    s = monthly.filter(F.col("year_month").isNotNull()).select(
        *keys, month_start("year_month").alias("month"), (F.col("monthly_revenue") / F.lit(scale)).alias("y")
    )
    # The maximum is taken over whole rows, so the subquery keeps the columns of the main query,
    # and the comparison names y, so it is not pushed below the monthly aggregate: both sides
    # then hold the same shuffle, which Spark runs once. (month, y) < (last, NULL) is month < last.
    last = s.agg(F.max(F.struct("month", "y", *keys))).scalar().getField("month")
    return s.filter(F.struct("month", "y") < F.struct(last.alias("month"), F.lit(None).cast("double").alias("y")))


def holdout_split(series: DataFrame, keys: Sequence[str] = (), holdout: int = 3) -> DataFrame:
    """the last ``holdout`` months of each series are 'test', the rest 'train'."""
    if holdout < 1:
        raise ValueError("holdout must be at least 1 month")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("month")))
    return series.withColumn("split", F.when(rank <= holdout, F.lit("test")).otherwise(F.lit("train")))


def month_index(month: Column) -> Column:
    """x = year * 12 + month (consecutive integers for consecutive months)."""
    return F.year(month) * 12 + F.month(month)


# --- F3: trend fit --------------------------------------------------------------

def trend_fit(split: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """per series slope, intercept, training months and residual sd of y on x."""
    train = split.filter(F.col("split") == "train").withColumn("x", month_index(F.col("month")))
    return train.groupBy(*keys).agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.count(F.lit(1)).alias("train_months"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
    )


def _masked(c: str) -> Column:
    return F.when(F.col("split") == "train", F.col(c))


def _check_anchor(anchor: str) -> None:
    if anchor not in ("train", "data"):
        raise ValueError("anchor must be 'train' or 'data'")


def predict_trend(
    split: DataFrame, keys: Sequence[str] = (), horizon: int = 6, z: float = Z80, anchor: str = "train"
) -> DataFrame:
    """F3 + F5: prediction frame of the straight-line model.

    Coefficients are window aggregates over each series' training rows, so
    history and future rows get them without a join. Band: yhat +- z * s with
    s the residual standard error (n - 2 degrees of freedom). Training months
    without a value are left out; a series with fewer than ``MIN_TRAIN_MONTHS``
    of them gets NULL predictions.

    ``anchor='train'`` (the reference) counts the horizon from the last
    training month, so holdout months fall inside it; ``anchor='data'``
    counts it from the last month with data (a true "next N months").
    """
    _check_anchor(anchor)
    w = _w(keys)
    s = split.withColumn("x", month_index(F.col("month")))
    tx, ty = F.when(F.col("split") == "train", F.col("x")), _masked("y")
    coef = s.select(
        *keys, "month", "y", "split",
        F.regr_slope(ty, tx).over(w).alias("slope"),
        F.regr_intercept(ty, tx).over(w).alias("intercept"),
        F.regr_sxx(ty, tx).over(w).alias("sxx"),
        F.regr_sxy(ty, tx).over(w).alias("sxy"),
        F.regr_syy(ty, tx).over(w).alias("syy"),
        F.regr_count(ty, tx).over(w).alias("n"),
        F.max(F.when(F.col("split") == "train", F.col("month"))).over(w).alias("last_train"),
        F.max("month").over(w).alias("last_month"),
    )
    sse = F.greatest(F.lit(0.0), F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx"))
    coef = coef.withColumn(
        "sigma", F.when(F.col("n") > 2, F.sqrt(sse / (F.col("n") - 2))).otherwise(F.lit(None).cast("double"))
    )
    long_enough = F.col("n") >= MIN_TRAIN_MONTHS
    coef = coef.withColumns({c: F.when(long_enough, F.col(c)) for c in ("slope", "intercept")})
    coef = coef.withColumn("anchor", F.col("last_train") if anchor == "train" else F.col("last_month"))
    known = coef.select(*keys, "month", F.col("y").alias("actual"), "split", "slope", "intercept", "sigma", "anchor")
    # future months come from each series' last training row
    future = (
        coef.filter(F.col("month") == F.col("last_train"))
        .select(*keys, "slope", "intercept", "sigma", "anchor", "last_month",
                F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_i"))
        .withColumn("month", F.add_months("anchor", F.col("_i")))
        .filter(F.col("month") > F.col("last_month"))
        .select(*keys, "month", F.lit(None).cast("double").alias("actual"), F.lit("future").alias("split"),
                "slope", "intercept", "sigma", "anchor")
    )
    frame = known.unionByName(future)
    yhat = F.col("intercept") + F.col("slope") * month_index(F.col("month"))
    return frame.select(
        *keys, "month", "actual",
        yhat.alias("yhat"),
        (yhat - F.lit(z) * F.col("sigma")).alias("lower"),
        (yhat + F.lit(z) * F.col("sigma")).alias("upper"),
        "split",
        ((F.col("split") == "train") | (F.col("month") <= F.add_months("anchor", horizon))).alias("in_frame"),
    )


# --- F4: seasonal model (applyInPandas) ----------------------------------------

def _seed(key_values: Sequence) -> int:
    """The same for a series wherever it is fitted."""
    return zlib.crc32(repr([None if pd.isna(v) else str(v) for v in key_values]).encode())


def _seasonal_group(keys, horizon, period, order, prior_scale, changepoints, change_scale, noise, interval, anchor, with_fit):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(month=pd.to_datetime(pdf["month"])).sort_values("month")
        key_vals = {k: pdf[k].iloc[0] for k in keys}
        train = pdf[(pdf["split"] == "train")]
        last_train = train["month"].max() if len(train) else pdf["month"].max()
        last_month = pdf["month"].max()
        start = last_train if anchor == "train" else last_month
        fut = [start + pd.DateOffset(months=i) for i in range(1, horizon + 1)]
        fut = [m for m in fut if m > last_month]
        months = list(pdf["month"]) + fut
        actual = np.array(list(pdf["y"]) + [np.nan] * len(fut), dtype=float)
        split = list(pdf["split"]) + ["future"] * len(fut)
        used = np.array([s == "train" for s in split]) & ~np.isnan(actual)
        yhat, fitted = np.full(len(months), np.nan), {}
        low = high = np.full(len(months), np.nan)
        if used.sum() >= MIN_TRAIN_MONTHS:
            origin = min(m for m, u in zip(months, used) if u)
            days = np.array([(m - origin).days for m in months], dtype=float)
            span = max(float(days[used].max()), 1.0)
            scale = float(np.max(np.abs(actual[used]))) or 1.0
            knots = trend.knots_of(days[used] / span, changepoints, CHANGEPOINT_RANGE)
            x = trend.design(days, span, knots, period, order)
            xt, y = x[used], actual[used] / scale
            beta, used_noise = trend.fit(xt, y, len(knots), order, change_scale, prior_scale, noise)
            yhat = x @ beta * scale
            l2 = trend.weights(len(knots), order, change_scale, prior_scale, used_noise)[1]
            sd, changes = trend.spread(xt, y, beta, l2), beta[2 : 2 + len(knots)]
            low, high = (yhat + o * scale for o in trend.band(days / span, changes, sd, interval, _seed(key_vals.values())))
            fitted = {"origin": origin.date(), "span": span, "scale": scale, "noise": used_noise, "knots": knots.tolist(), "beta": beta.tolist()}
        limit = start + pd.DateOffset(months=horizon)
        out = pd.DataFrame(
            {
                "month": [m.date() for m in months],
                "actual": pd.array(actual, dtype="float64"),
                "yhat": yhat,
                "lower": low,
                "upper": high,
                "split": split,
                "in_frame": [(s == "train") or (m <= limit) for s, m in zip(split, months)],
            }
        )
        for k, v in key_vals.items():
            out.insert(0, k, v)
        columns = [*keys, "month", "actual", "yhat", "lower", "upper", "split", "in_frame"]
        if with_fit:
            for name in (f.name for f in FIT_FIELDS):
                out[name] = [fitted.get(name)] * len(out)
                columns.append(name)
        return out[columns]

    return fit


PRED_FIELDS = [
    StructField("month", DateType()),
    StructField("actual", DoubleType()),
    StructField("yhat", DoubleType()),
    StructField("lower", DoubleType()),
    StructField("upper", DoubleType()),
    StructField("split", StringType()),
    StructField("in_frame", BooleanType()),
]
FIT_FIELDS = [
    StructField("origin", DateType()),
    StructField("span", DoubleType()),
    StructField("scale", DoubleType()),
    StructField("noise", DoubleType()),
    StructField("knots", ArrayType(DoubleType())),
    StructField("beta", ArrayType(DoubleType())),
]


def predict_seasonal(
    split: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = 6,
    period: float = SEASON_PERIOD_DAYS,
    order: int = FOURIER_ORDER,
    prior_scale: float = SEASONALITY_PRIOR_SCALE,
    anchor: str = "train",
    with_fit: bool = False,
    changepoints: int = MAX_CHANGEPOINTS,
    change_scale: float = CHANGEPOINT_PRIOR_SCALE,
    noise: float | None = None,
    interval: float = INTERVAL_WIDTH,
) -> DataFrame:
    """additive piecewise-linear trend + quarterly Fourier season, one fit per series.

    The trend may bend at up to ``changepoints`` months of the first 80% of the
    training months. Each bend has a Laplace prior of scale ``change_scale`` on y
    scaled by its maximum, so most are exactly zero; each season term has a
    normal prior of scale ``prior_scale`` (about three monthly samples per
    91.25-day cycle make the harmonics alias). Level and slope are free. The
    noise variance that weighs the priors is estimated unless ``noise`` gives it.
    Training months without a value are left out; a series with fewer than
    ``MIN_TRAIN_MONTHS`` of them gets NULL predictions.

    The band holds a share ``interval`` of simulated values: noise within the
    training months, and after them also future bends, as frequent and as large
    as the fitted ones, so it widens with the horizon. Draws are seeded by the
    series' key and do not depend on partitioning. ``with_fit`` adds the fit
    itself (``FIT_FIELDS``), as ``fit_gap`` needs it.
    """
    if not 0.0 < interval < 1.0:
        raise ValueError("interval must lie between 0 and 1")
    key_fields = [f for f in split.schema.fields if f.name in keys]
    key_fields = sorted(key_fields, key=lambda f: list(keys).index(f.name))
    schema = StructType(key_fields + PRED_FIELDS + (FIT_FIELDS if with_fit else []))
    data = split.select(*keys, "month", "y", "split")
    _check_anchor(anchor)
    fn = _seasonal_group(list(keys), horizon, period, order, prior_scale, changepoints, change_scale, noise, interval, anchor, with_fit)
    if keys:
        return data.groupBy(*keys).applyInPandas(fn, schema)
    # one global series: group on a constant so it still runs as one grouped task
    return data.withColumn("_g", F.lit(0)).groupBy("_g").applyInPandas(fn, schema)


def fit_gap(
    pred: DataFrame,
    keys: Sequence[str] = (),
    period: float = SEASON_PERIOD_DAYS,
    order: int = FOURIER_ORDER,
    prior_scale: float = SEASONALITY_PRIOR_SCALE,
    change_scale: float = CHANGEPOINT_PRIOR_SCALE,
) -> DataFrame:
    """How far a seasonal fit is from its definition, recomputed in SQL from its coefficients.

    Per series: ``equation_gap`` is the largest error of the conditions that hold
    at the minimum and nowhere else. With the pull g = X'(y - Xb) (y scaled): for
    level, slope and season terms g is the penalty times b; for a bend that is
    not zero g is the L1 weight with b's sign; for one that is zero g lies within
    the weight. ``forecast_gap`` is the largest scaled difference between the
    forecasts and Xb. Both are 0 up to rounding for a right fit and NULL without
    one. ``bends`` is the number of slope changes, neighbouring ones of one sign
    counted once.
    """
    days = F.date_diff("month", "origin").cast("double")
    t = days / F.col("span")
    waves = [f(F.lit(2.0 * math.pi * k / period) * days) for k in range(1, order + 1) for f in (F.sin, F.cos)]
    bends = F.transform("knots", lambda c: F.greatest(F.lit(0.0), t - c))
    rows = pred.withColumn("x", F.concat(F.array(F.lit(1.0), t), bends, F.array(*waves).cast("array<double>")))
    signs = F.transform(F.slice("beta", F.lit(3), F.size("knots")), lambda v: F.signum(v))
    starts = F.filter(F.zip_with(signs, F.concat(F.array(F.lit(0.0)), signs), lambda v, before: (v != 0) & (v != before)), lambda new: new)
    rows = rows.withColumn("bends", F.when(F.col("beta").isNotNull(), F.size(starts)))
    dot = F.aggregate(F.zip_with("x", "beta", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    rows = rows.withColumn("off", F.abs(dot - F.col("yhat") / F.col("scale"))).withColumn(
        "left", F.when((F.col("split") == "train") & F.col("actual").isNotNull(), F.col("actual") / F.col("scale") - dot)
    )
    bends_at = F.size("knots")
    l2 = F.concat(F.array_repeat(F.lit(0.0), bends_at + 2), F.array_repeat(F.col("noise") / F.lit(prior_scale**2), 2 * order))
    l1 = F.concat(F.array(F.lit(0.0), F.lit(0.0)), F.array_repeat(F.col("noise") / F.lit(change_scale), bends_at), F.array_repeat(F.lit(0.0), 2 * order))
    terms = rows.select(*keys, "off", "left", "bends", F.posexplode_outer(F.arrays_zip("x", "beta", l1.alias("l1"), l2.alias("l2"))).alias("j", "c"))
    b = F.max("c.beta")
    pull = F.sum(F.col("left") * F.col("c.x")) - F.max("c.l2") * b
    bound = F.max("c.l1")
    gap = F.when(b == 0, F.greatest(F.abs(pull) - bound, F.lit(0.0))).otherwise(F.abs(pull - F.signum(b) * bound))
    each = terms.groupBy(*keys, "j").agg(F.max("off").alias("off"), gap.alias("gap"), F.max("bends").alias("bends"))
    return each.groupBy(*keys).agg(F.max("gap").alias("equation_gap"), F.max("off").alias("forecast_gap"), F.max("bends").alias("bends"))


# --- F6 / F7 -------------------------------------------------------------------

def forecast_table(pred: DataFrame, keys: Sequence[str] = (), clock: Column | None = None) -> DataFrame:
    """the stored forecast: training months + horizon, 'yyyy-MM' months,
    rounded forecast and band, unrounded actuals, ``is_forecast`` where no
    actual exists."""
    return pred.filter("in_frame").select(
        *keys,
        F.date_format("month", "yyyy-MM").alias("month"),
        F.round("yhat", 2).alias("forecast_revenue"),
        F.round("lower", 2).alias("forecast_lower"),
        F.round("upper", 2).alias("forecast_upper"),
        F.col("actual").alias("actual_revenue"),
        F.col("actual").isNull().alias("is_forecast"),
        (clock if clock is not None else F.current_timestamp()).alias("created_at"),
    )


def forecast_accuracy(pred: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """MAE and MAPE (percent) on the holdout months, both rounded to 2,
    with the real numbers of test and training months."""
    test = F.col("split") == "test"
    err = F.col("actual") - F.col("yhat")
    return pred.groupBy(*keys).agg(
        F.round(F.avg(F.when(test, F.abs(err))), 2).alias("mae"),
        F.round(F.avg(F.when(test, F.abs(err / (F.col("actual") + F.lit(MAPE_EPS))))) * 100, 2).alias("mape_pct"),
        F.count_if(test).alias("test_months"),
        F.count_if((F.col("split") == "train") & F.col("actual").isNotNull()).alias("train_months"),
    )


# --- F8 / F9 -------------------------------------------------------------------

def forecast_runs(accuracy: DataFrame, model: str, horizon: int, holdout: int, clock: Column | None = None) -> DataFrame:
    """F8: one run record per series: parameters actually used + metrics.

    ``fit_status`` is 'too_short' for a series with fewer than 3 training
    months that have a value (its forecasts are NULL, whatever the model), else 'ok'.
    """
    seasonal = model == "seasonal"
    return accuracy.select(
        "*",
        F.when(F.col("train_months") < MIN_TRAIN_MONTHS, F.lit("too_short")).otherwise(F.lit("ok")).alias("fit_status"),
        F.lit(model).alias("model"),
        F.lit(horizon).alias("horizon_months"),
        F.lit(holdout).alias("holdout_months"),
        F.lit("additive").alias("seasonality_mode"),
        F.lit(SEASON_PERIOD_DAYS if seasonal else None).cast("double").alias("season_period_days"),
        F.lit(FOURIER_ORDER if seasonal else None).cast("int").alias("fourier_order"),
        F.lit(INTERVAL_WIDTH).alias("interval_width"),
        (clock if clock is not None else F.current_timestamp()).alias("run_at"),
    )


def forecast_revenue(
    monthly: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = 6,
    holdout: int = 3,
    model: str = "seasonal",
    scale: float = SCALE_CRORE,
    clock: Column | None = None,
    anchor: str = "train",
) -> tuple[DataFrame, DataFrame]:
    """monthly trend -> (forecast table, run records)."""
    split = holdout_split(forecast_series(monthly, keys, scale), keys, holdout)
    if model == "seasonal":
        pred = predict_seasonal(split, keys, horizon, anchor=anchor)
    elif model == "trend":
        pred = predict_trend(split, keys, horizon, anchor=anchor)
    else:
        raise ValueError(f"unknown model {model!r}")
    return forecast_table(pred, keys, clock), forecast_runs(forecast_accuracy(pred, keys), model, horizon, holdout, clock)
