"""Daily revenue forecasts per tax type, with accuracy, summary and alerts."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revenuelake.functions.dates import days_after, in_period, months_before
from revenuelake.functions.ratios import pct_change, ratio
from revenuelake.operators.staging import stg_payments

TOTAL = "Total"
# (period in days, number of sine and cosine pairs) of the seasonal terms.
SEASONS = [(365.25, 10), (7.0, 3), (30.5, 5)]
INTERVAL_Z = 1.2816  # 80 % interval
RIDGE = 1.0
CHANGE_POINTS = 25  # days on which the trend may bend
CHANGE_RANGE = 0.8  # share of the history in which they lie
MOST_BENDS = 12


def revenue_history(payments: DataFrame, as_of: dt.date) -> DataFrame:
    """Completed revenue of two years per day and tax type, and per day in total."""
    recent = stg_payments(in_period(payments, start=months_before(as_of, 24)))
    sums = (
        recent.select(F.col("payment_date").alias("ds"), "tax_type", "amount")
        .groupingSets([["ds", "tax_type"], ["ds"]], "ds", "tax_type")
        .agg(F.sum("amount").alias("y"), F.grouping("tax_type").alias("is_total"))
    )
    name = F.when(F.col("is_total") == 1, TOTAL).otherwise(F.col("tax_type"))
    return sums.select("ds", name.alias("tax_type"), "y")


def _design(days: np.ndarray, span: float) -> np.ndarray:
    """Intercept, trend and the seasonal sine and cosine terms."""
    columns = [np.ones_like(days), days / span]
    for period, order in SEASONS:
        for k in range(1, order + 1):
            angle = 2 * np.pi * k * days / period
            columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack(columns)


def _bends(days: np.ndarray, span: float, at: np.ndarray) -> np.ndarray:
    """One column for each change point: zero before it, then rising with the time since."""
    return np.maximum(days[:, None] - at[None, :], 0.0) / span


def sparse_bends(quadratic: np.ndarray, linear: np.ndarray, strength: float, start: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Coordinate descent for the least ``d'Qd / 2 - c'd + strength * |d|``, the changes of slope under an L1 penalty."""
    change = start.copy()
    for _ in range(rounds):
        before = change.copy()
        for k in range(len(change)):
            pull = linear[k] - quadratic[k] @ change + quadratic[k, k] * change[k]
            change[k] = np.sign(pull) * max(abs(pull) - strength, 0.0) / max(quadratic[k, k], 1e-12)
        if np.abs(change - before).max() < 1e-9:
            break
    return change


def _ridge(x: np.ndarray, target: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and the inverse of the penalised normal matrix; the last ``free`` and the first two columns are not penalised."""
    penalty = np.full(x.shape[1], RIDGE)
    penalty[:2] = 1e-6
    if free:
        penalty[-free:] = 1e-6
    inverse = np.linalg.inv(x.T @ x + np.diag(penalty))
    return inverse @ (x.T @ target), inverse


def change_points(days: np.ndarray, target: np.ndarray, span: float) -> np.ndarray:
    """Days on which the trend bends: few of ``CHANGE_POINTS`` evenly spaced ones, often none.

    The L1 penalty is lowered step by step; each set of bends that comes up is fitted anew without the penalty, and the set of
    least information criterion (two parameters for each bend, its day and its size) stays.
    """
    last = days.max() * CHANGE_RANGE
    spread = np.linspace(0.0, last, CHANGE_POINTS + 2)[1:-1]
    n = len(days)
    if n < 4 * CHANGE_POINTS:
        return np.zeros(0)
    base = _design(days, span)
    smooth = base @ _ridge(base, np.eye(n), 0)[0]  # what the other terms explain of each column
    columns = _bends(days, span, spread)
    rest = columns - smooth @ columns
    quadratic, linear = columns.T @ rest, rest.T @ target

    def criterion(at: np.ndarray) -> float:
        x = np.column_stack([base, _bends(days, span, at)])
        residual = target - x @ _ridge(x, target, len(at))[0]
        return n * np.log(max(float(residual @ residual), 1e-12) / n) + 2 * len(at) * np.log(n)

    change, seen = np.zeros(CHANGE_POINTS), {(): criterion(np.zeros(0))}
    for strength in np.abs(linear).max() * np.geomspace(1.0, 1e-3, 25):
        change = sparse_bends(quadratic, linear, strength, change)
        chosen = tuple(np.flatnonzero(np.abs(change) > 1e-9).tolist())
        if chosen not in seen and len(chosen) <= MOST_BENDS:
            seen[chosen] = criterion(spread[list(chosen)])
    # Neighbouring candidates share one bend between two days; each is tried without the other.
    best = min(seen, key=lambda c: seen[c])
    while best:
        fewer = {tuple(k for k in best if k != out): criterion(spread[[k for k in best if k != out]]) for out in best}
        least = min(fewer, key=lambda c: fewer[c])
        if fewer[least] > seen[best]:
            break
        seen[least], best = fewer[least], least
    return spread[list(best)]


def _fit_predict(series: pd.DataFrame, future: pd.DatetimeIndex, bending: bool = True) -> pd.DataFrame:
    """Least squares on the logarithm, so that season and trend multiply; the trend is straight between change points.

    The interval covers the noise, the uncertainty of the weights and, after the last day, that the trend may bend again as
    often and as much as it did, so it widens with the horizon.
    """
    start = series["ds"].min()
    days = (series["ds"] - start).dt.days.to_numpy(dtype=float)
    span = max(days.max(), 1.0)
    target = np.log(np.maximum(series["y"].to_numpy(dtype=float), 0.01))
    at = change_points(days, target, span) if bending else np.zeros(0)
    x = np.column_stack([_design(days, span), _bends(days, span, at)])
    weights, inverse = _ridge(x, target, len(at))
    sigma = float(np.std(target - x @ weights))
    coming = (future - start).days.to_numpy(dtype=float)
    shown = np.column_stack([_design(coming, span), _bends(coming, span, at)])
    yhat = shown @ weights
    variance = sigma**2 * (1.0 + np.einsum("ij,jk,ik->i", shown, inverse, shown))
    if len(at):
        size = float(np.abs(weights[-len(at) :]).mean()) / span  # of the slope a day
        ahead = np.maximum(coming - days.max(), 0.0)
        variance += len(at) / span * 2 * size**2 * ahead**3 / 3
    wide = INTERVAL_Z * np.sqrt(variance)
    return pd.DataFrame({"ds": future, "yhat": np.exp(yhat), "yhat_lower": np.exp(yhat - wide), "yhat_upper": np.exp(yhat + wide)})


def _series(history: DataFrame) -> DataFrame:
    """One group per series; a group holds at most one row per day of the two years."""
    return history.select("ds", "tax_type", F.col("y").cast("double").alias("y"))


def train_forecast(history: DataFrame, horizon: int = 90) -> DataFrame:
    """Fitted values of the history and ``horizon`` further days, with an 80 % interval that widens with the horizon."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        series = pdf.assign(ds=pd.to_datetime(pdf["ds"])).sort_values("ds")
        last = series["ds"].max()
        future = pd.DatetimeIndex(series["ds"]).append(pd.date_range(last + pd.Timedelta(days=1), periods=horizon))
        out = _fit_predict(series, future)
        out["ds"] = out["ds"].dt.date
        return out.assign(tax_type=pdf["tax_type"].iloc[0])

    schema = "ds date, yhat double, yhat_lower double, yhat_upper double, tax_type string"
    return _series(history).groupBy("tax_type").applyInPandas(run, schema)


def forecast_holdout_mape(history: DataFrame, holdout: int = 30, bending: bool = True) -> DataFrame:
    """Mean absolute percentage error on the last ``holdout`` rows of each series; with a straight trend unless ``bending``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        series = pdf.assign(ds=pd.to_datetime(pdf["ds"])).sort_values("ds")
        train, test = series.iloc[:-holdout], series.iloc[-holdout:]
        if train.empty:
            return pd.DataFrame({"tax_type": [], "y": [], "yhat": []})
        predicted = _fit_predict(train, pd.DatetimeIndex(test["ds"]), bending)
        return pd.DataFrame({"tax_type": pdf["tax_type"].iloc[0], "y": test["y"].to_numpy(), "yhat": predicted["yhat"]})

    tested = _series(history).groupBy("tax_type").applyInPandas(run, "tax_type string, y double, yhat double")
    error = F.abs((F.col("y") - F.col("yhat")) / F.nullif(F.col("y"), F.lit(0.0)))
    return tested.groupBy("tax_type").agg((F.avg(error) * 100).alias("mape"), F.count(F.lit(1)).alias("test_rows"))


def forecast_summary(forecast: DataFrame, as_of: dt.date, rows: int = 30) -> DataFrame:
    """Total, mean, range and direction of the next rows of each series."""
    nearest = Window.partitionBy("tax_type").orderBy("ds")
    coming = (
        forecast.filter(F.col("ds") > F.lit(as_of))
        .withColumn("place", F.row_number().over(nearest))
        .filter(F.col("place") <= rows)
    )
    rises = F.max_by("yhat", "ds") > F.min_by("yhat", "ds")
    return coming.groupBy("tax_type").agg(
        F.sum("yhat").alias("next_30_days_total"),
        F.avg("yhat").alias("next_30_days_avg"),
        F.min("yhat_lower").alias("next_30_days_min"),
        F.max("yhat_upper").alias("next_30_days_max"),
        F.when(rises, "increasing").otherwise("decreasing").alias("trend_direction"),
    )


def to_forecast_table(forecast: DataFrame) -> DataFrame:
    """Columns of the stored forecast table."""
    return forecast.select(
        F.col("ds").alias("forecast_date"),
        "tax_type",
        F.col("yhat").alias("predicted_revenue"),
        F.col("yhat_lower").alias("lower_bound"),
        F.col("yhat_upper").alias("upper_bound"),
    )


def forecast_deviation_alerts(forecasts: DataFrame, payments: DataFrame, as_of: dt.date) -> DataFrame:
    """Forecasts of the next seven days that differ by more than 20 % from the mean payment.

    The base is the mean of single payments of the last 30 days, as in the source rule, although the
    forecast is a daily total.
    """
    recent = in_period(payments, start=days_after(as_of, -30), before=as_of)
    mean = recent.groupBy("tax_type").agg(ratio(F.sum("amount"), F.count("amount")).alias("historical_avg"))
    coming = forecasts.filter(F.col("forecast_date").between(F.lit(as_of), F.lit(days_after(as_of, 7))))
    return (
        coming.select("tax_type", "forecast_date", F.col("predicted_revenue").alias("current_forecast"))
        .join(mean, "tax_type")
        .withColumn("variance_pct", pct_change(F.col("current_forecast"), F.col("historical_avg")))
        .filter(F.abs("variance_pct") > 20)
    )
