"""Deterministic ensemble forecasts of monthly, quarterly and yearly series. A series, which is short, is one group's work."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .model import run

#: 80 % of a normal distribution lie within so many deviations.
Z80 = 1.2815515655446004
# The rates of level, trend and damping that are tried, in this order
_LEVEL, _TREND, _DAMPING = (0.2, 0.4, 0.6, 0.8), (0.05, 0.1, 0.2), (0.8, 0.9, 0.98)
_RATES = np.array([(a, b, c) for a in _LEVEL for b in _TREND for c in _DAMPING])
A_YEAR = {"month": 12, "quarter": 4, "year": 1}


def number(period: str) -> tuple[int, str]:
    """(periods since year 0, kind) of 2024, 2024-Q3 or 2024-07."""
    if re.fullmatch(r"\d{4}", period):
        return int(period), "year"
    if m := re.fullmatch(r"(\d{4})-Q([1-4])", period):
        return int(m[1]) * 4 + int(m[2]) - 1, "quarter"
    return int(period[:4]) * 12 + int(period[5:7]) - 1, "month"


def period(at: int, kind: str) -> str:
    if kind == "year":
        return str(at)
    year, part = divmod(at, A_YEAR[kind])
    return f"{year}-Q{part + 1}" if kind == "quarter" else f"{year}-{part + 1:02d}"


def regular(periods: list[int], values: list[float]) -> tuple[list[int], np.ndarray, int]:
    """(periods, values, step): the last run without gaps of the positive values, by the commonest step (the smaller of equals)."""
    pairs = sorted((p, v) for p, v in zip(periods, values, strict=True) if v is not None and v > 0)
    at, held = np.array([p for p, _ in pairs], int), np.array([v for _, v in pairs], float)
    steps = np.diff(at)
    if not len(steps):
        return at.tolist(), held, 1
    sizes, times = np.unique(steps, return_counts=True)
    step = int(sizes[np.argmax(times)])  # sizes rise, and the first of equals holds
    odd = np.flatnonzero(steps != step)
    first = odd[-1] + 1 if len(odd) else 0
    return at[first:].tolist(), held[first:], step


class Series:
    """A series in logarithms, and forecasts of it from any of its beginnings."""

    def __init__(self, logs: np.ndarray) -> None:
        self.z = logs
        self._states: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def drift(self, n: int, horizon: int, window: int) -> np.ndarray:
        """The mean step of the last ones goes on."""
        w = min(window, n - 1)
        slope = (self.z[n - 1] - self.z[n - 1 - w]) / w if w > 0 else 0.0
        return self.z[n - 1] + slope * np.arange(1, horizon + 1)

    def flat(self, n: int, horizon: int) -> np.ndarray:
        return np.full(horizon, self.z[n - 1])

    def damped(self, n: int, horizon: int) -> np.ndarray:
        """Level and damped trend by the rates with the least one-step error so far; the first of those that are equal to 1e-15."""
        if n < 4:
            return self.drift(n, horizon, 12)
        if not self._states:
            alpha, beta, phi = _RATES.T
            level, trend, error = np.full(len(_RATES), self.z[0]), np.full(len(_RATES), self.z[1] - self.z[0]), np.zeros(len(_RATES))
            self._states.append((level, trend, error))
            for y in self.z[1:]:  # all rates at once; every beginning of the series is a state on the way
                guess = level + phi * trend
                after = alpha * y + (1 - alpha) * guess
                level, trend, error = after, beta * (after - level) + (1 - beta) * phi * trend, error + (y - guess) ** 2
                self._states.append((level, trend, error))
        level, trend, error = self._states[n - 1]
        best = 0
        for i in range(1, len(error)):
            if error[i] < error[best] - 1e-15:
                best = i
        return level[best] + trend[best] * np.cumsum(_RATES[best, 2] ** np.arange(1, horizon + 1))

    def seasonal(self, n: int, horizon: int, m: int) -> np.ndarray:
        """The same season of last year, grown as the last year has over the one before."""
        if n < 2 * m:
            return self.drift(n, horizon, m)
        year = self.z[n - m : n]
        growth = year.mean() - self.z[n - 2 * m : n - m].mean()
        k = np.arange(horizon)
        return year[k % m] + growth * (k // m + 1)

    def seasonal_drift(self, n: int, horizon: int, m: int) -> np.ndarray:
        """The mean seasons of three years taken out, two years' drift of what is left, and the seasons put back, counted from the series' first value."""
        if n < 3 * m:
            return self.seasonal(n, horizon, m)
        years = self.z[n - 3 * m : n].reshape(3, m)
        season = np.roll(years.mean(axis=0) - years.mean(), -(n % m))
        rest = Series((years - season).reshape(-1))
        return rest.drift(3 * m, horizon, 2 * m) + season[np.arange(horizon) % m]


Model = Callable[[Series, int, int], np.ndarray]


def models(kind: str, step: int, seasonal: bool) -> dict[str, Model]:
    """The models of a frequency: drifts over two windows, the damped trend, the last value, and, for counts with four periods a year or more, two
    seasonal ones."""
    a_year = A_YEAR[kind] // (step if kind == "month" else 1) or 1
    short, long = (5, 10) if kind == "year" else (max(1, a_year), max(2, 3 * a_year))
    out: dict[str, Model] = {
        f"drift_{short}": lambda s, n, h: s.drift(n, h, short),
        f"drift_{long}": lambda s, n, h: s.drift(n, h, long),
        "damped_trend": Series.damped,
        "flat": Series.flat,
    }
    if seasonal and a_year >= 4 and kind != "year":
        out |= {"seasonal": lambda s, n, h: s.seasonal(n, h, a_year), "seasonal_drift": lambda s, n, h: s.seasonal_drift(n, h, a_year)}
    return out


@dataclass
class Forecast:
    middle: np.ndarray
    low: np.ndarray
    high: np.ndarray
    weights: dict[str, float]
    errors: dict[int, float]  #: mean absolute error of the ensemble in logarithms, by steps ahead


def ensemble(values: np.ndarray, horizon: int, kind: str = "month", step: int = 1, seasonal: bool = False) -> Forecast:
    """Models weighed by the inverse of their mean absolute errors in a backtest with rolling origins; the band of 80 % comes from the ensemble's own errors
    there where eight or more are known for a horizon, else from the spread of its first step, and never narrows. At least six values."""
    if len(values) < 6:
        raise ValueError(f"a forecast needs six periods without gaps, not {len(values)}")
    series, held = Series(np.log(values)), models(kind, step, seasonal)
    z, n = series.z, len(values)
    least = max(6, min(n // 2, 36 // step if kind == "month" else n // 2))
    reach = max(1, min(horizon, n - least)) if n - least >= 1 else 1
    backtest = [(o, min(reach, n - o), {name: f(series, o, min(reach, n - o)) for name, f in held.items()}) for o in range(least, n - 1)]
    means = {name: float(np.mean(np.abs(np.concatenate([found[name] - z[o : o + h] for o, h, found in backtest])))) if backtest else math.inf for name in held}
    inverse = {name: 1 / max(x, 1e-6) for name, x in sorted(means.items()) if math.isfinite(x)}
    if not inverse:  # nothing to test on: all alike
        inverse = dict.fromkeys(sorted(held), 1.0)
    weights = {name: x / sum(inverse.values()) for name, x in inverse.items()}
    blend = lambda found: sum(w * found[name] for name, w in weights.items())
    errors: dict[int, list[float]] = {}
    for o, h, found in backtest:
        for k, e in enumerate(blend(found) - z[o : o + h], 1):
            errors.setdefault(k, []).append(float(e))
    middle = blend({name: held[name](series, n, horizon) for name in weights})
    first = errors.get(1, [])
    spread = float(np.std(first, ddof=1)) if len(first) > 1 else 0.0
    below, above = [], []
    for k in range(1, horizon + 1):
        if len(errors.get(k, ())) >= 8:
            over, under = np.quantile(errors[k], [0.9, 0.1])  # an error is forecast less truth
            below.append(over)
            above.append(-under)
        else:
            below.append(Z80 * (spread or 0.02) * math.sqrt(k))
            above.append(below[-1])
    below, above = (np.maximum.accumulate(np.maximum(x, 0.0)) for x in (below, above))
    return Forecast(np.exp(middle), np.exp(middle - below), np.exp(middle + above), weights, {k: float(np.mean(np.abs(e))) for k, e in errors.items()})


_SCHEMA = "geo_id string, step int, period string, forecast double, low double, high double"


def forecast(series: DataFrame, horizon: int = 12, seasonal: bool = False) -> DataFrame:
    """(geo_id, step, period, forecast, low, high) of (geo_id, period, v). Series of under six usable values give nothing; nulls and values that aren't
    positive are left out."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        index = [number(p) for p in pdf["period"]]
        at, values, step = regular([i for i, _ in index], [None if pd.isna(v) else v for v in pdf["v"]])
        if len(values) < 6:
            return pd.DataFrame(columns=["geo_id", "step", "period", "forecast", "low", "high"])
        kind = index[0][1]
        found = ensemble(values, horizon, kind, step, seasonal and kind == "month" and step == 1)
        steps = range(1, horizon + 1)
        return pd.DataFrame({"geo_id": pdf["geo_id"].iloc[0], "step": list(steps), "period": [period(at[-1] + k * step, kind) for k in steps], "forecast": found.middle, "low": found.low, "high": found.high})

    return series.select("geo_id", "period", "v").where("period is not null").groupBy("geo_id").applyInPandas(one, _SCHEMA)


def real_terms(forecasts: DataFrame, inflation: dict[str, float]) -> DataFrame:
    """forecasts with real: each in prices of the last measured period, by yearly inflation in percent, a twelfth root of it for each month; null from the
    first year on that isn't given."""
    rate = F.coalesce(*(F.when(F.substring("period", 1, 4) == y, F.lit(1 + p / 100)) for y, p in inflation.items()), F.lit(None).cast("double"))
    a_month = F.pow(rate, F.when(F.length("period") == 4, 1.0).otherwise(1 / 12))
    from pyspark.sql import Window as W

    upto = W.partitionBy("geo_id").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    known = F.min(a_month.isNotNull()).over(upto)
    return forecasts.withColumn("real", F.when(known, F.col("forecast") / F.exp(F.sum(F.log(a_month)).over(upto))))


def evaluated(series: DataFrame, last: str, horizon: int, seasonal: bool = False, least: int = 24) -> DataFrame:
    """(n, median_error, naive_error, covered): series cut after a period, forecast, and held against what came: median absolute errors in percent, of the
    forecast and of the last value, and the part of truths within the band."""
    target = period(number(last)[0] + horizon, number(last)[1])
    train = series.where((F.col("period") <= last) & (F.col("v") > 0))
    fit = train.groupBy("geo_id").agg(F.count("*").alias("n"), F.max("period").alias("last"), F.max_by("v", "period").alias("naive")).where((F.col("n") >= least) & (F.col("last") == last)).select("geo_id", "naive")
    truth = series.where((F.col("period") == target) & (F.col("v") > 0)).select("geo_id", F.col("v").alias("truth"))
    found = forecast(train.join(fit, "geo_id", "left_semi"), horizon, seasonal).where(F.col("step") == horizon).join(truth, "geo_id").join(fit, "geo_id")
    error = lambda c: F.percentile(100 * F.abs(F.col(c) / F.col("truth") - 1), 0.5)
    return found.agg(F.count("*").alias("n"), error("forecast").alias("median_error"), error("naive").alias("naive_error"), F.avg(F.col("truth").between(F.col("low"), F.col("high")).cast("int")).alias("covered"))


_MONTHLY = "select geo_id, period, avg(v) v from cell where projected = 0 group by geo_id, period"


def forecast_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast(run(spark, sf_dir, _MONTHLY))


def forecast_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluated(run(spark, sf_dir, _MONTHLY), "2000-05", 12)


def backcast_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of earlier half-years by a fixed table of coefficients (an assumption, not a measurement)."""
    rates = spark.createDataFrame([(f"{1998 + i // 2}-H{1 + i % 2}", 0.52 + 0.06 * i) for i in range(9)], "half string, rate double")
    parts = run(spark, sf_dir, "select p_partkey, p_retailprice from part")
    return parts.crossJoin(F.broadcast(rates)).select("p_partkey", "half", F.round(F.col("p_retailprice") * F.col("rate"), 2).alias("price"))  # nine rows


BACKCAST_SQL = "select p_partkey, (1998 + i // 2)::varchar || '-H' || (1 + i % 2)::varchar half, round(p_retailprice * (0.52::double + 0.06::double * i), 2) price from part, range(9) t(i)"
