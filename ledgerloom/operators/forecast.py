"""Monthly forecasts, one additive Holt-Winters model per series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

SEASON = 12
MIN_MONTHS = 2 * SEASON
SCHEMA = "series string, ym date, revenue double, type string, note string"


def smooth(y: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Run the recursion for many (alpha, beta, gamma) rows at once.

    Returns the squared one-step errors and the final level, trend and seasons of each row.
    """
    alpha, beta, gamma = weights.T
    year1, year2 = y[:SEASON].mean(), y[SEASON:2 * SEASON].mean()
    rows, slope = len(weights), (year2 - year1) / SEASON
    centre = (SEASON - 1) / 2
    # start one step before the first month, with the trend taken out of the first year
    level, trend = np.full(rows, year1 - slope * (centre + 1)), np.full(rows, slope)
    seasons = np.tile(y[:SEASON] - year1 - slope * (np.arange(SEASON) - centre), (rows, 1))
    errors = np.zeros(rows)
    for t, value in enumerate(y):
        s = t % SEASON
        errors += (value - level - trend - seasons[:, s]) ** 2
        old = level
        level = alpha * (value - seasons[:, s]) + (1 - alpha) * (level + trend)
        trend = beta * (level - old) + (1 - beta) * trend
        seasons[:, s] = gamma * (value - level) + (1 - gamma) * seasons[:, s]
    return errors, level, trend, seasons


def project(y: np.ndarray, horizon: int, rounds: int = 6) -> np.ndarray:
    """Fit by a coarse grid refined around its best point, then extend by ``horizon`` months."""
    centre, reach = np.full(3, 0.5), 0.5
    for _ in range(rounds):
        axes = [np.clip(np.linspace(c - reach, c + reach, 7), 0.0, 1.0) for c in centre]
        grid = np.stack(np.meshgrid(*axes), axis=-1).reshape(-1, 3)
        errors, level, trend, seasons = smooth(y, grid)
        best = int(np.argmin(errors))
        centre, reach = grid[best], reach / 3
    steps = np.arange(1, horizon + 1)
    return level[best] + steps * trend[best] + seasons[best][(len(y) + steps - 1) % SEASON]


def forecast_series(frame: pd.DataFrame, horizon: int) -> pd.DataFrame:
    """One series, at most one row per month."""
    frame = frame.sort_values("ym")
    name, last = frame["series"].iloc[0], pd.Timestamp(frame["ym"].iloc[-1])
    enough = len(frame) >= MIN_MONTHS
    values = project(frame["revenue"].to_numpy(float), horizon) if enough else np.full(horizon, np.nan)
    ahead = pd.DataFrame({
        "series": name, "ym": [(last + pd.DateOffset(months=i)).date() for i in range(1, horizon + 1)],
        "revenue": values, "type": "forecast", "note": None if enough else f"needs {MIN_MONTHS} months"})
    return ahead.astype({"revenue": object}).where(ahead.notna(), None)


def revenue_forecast(monthly: DataFrame, horizon: int = 12) -> DataFrame:
    """Actual months and ``horizon`` forecast months per series of (series, ym, revenue).

    Months are summed before they get here, so a series is as long as the calendar, never
    as long as the fact.
    """
    series = monthly.select("series", "ym", F.col("revenue").cast("double").alias("revenue"))
    ahead = series.groupBy("series").applyInPandas(lambda frame: forecast_series(frame, horizon), SCHEMA)
    actual = series.select("*", F.lit("actual").alias("type"), F.lit(None).cast("string").alias("note"))
    return actual.unionByName(ahead)
