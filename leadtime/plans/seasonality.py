"""Seasonal components per site.

All fits run on pre-aggregated series: per site at most 168 hourly points
(week profile) or 366 daily points (year profile) or one point per day
(trend), so each ``applyInPandas`` group is bounded by the calendar, not by
the number of events.  The fit itself is a small ridge least-squares on a
Fourier basis in NumPy (a re-aim of the additive seasonal model).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadtime.operators import joins


def seasonal_means(df: DataFrame, site: str, ts: str, y: str) -> tuple[DataFrame, DataFrame]:
    """SQL-checkable seasonal lookups.

    weekly(site, dow) and daily(site, hour) are group means minus the site
    mean; yearly(site, month) likewise; holidays(site, month, dom) is the
    day mean minus site mean and yearly.  Returned in the two lookup shapes
    (site, dow, hour, weekly, daily) and (site, month, dom, yearly, holidays)
    over the combinations present in the data.
    """
    x = df.select(F.col(site).alias("site"), F.col(y).alias("y"), F.dayofweek(ts).alias("dow"),
                  F.hour(ts).alias("hour"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("dom"))
    base = x.groupBy("site").agg(F.avg("y").alias("__b"))
    wk = x.groupBy("site", "dow").agg(F.avg("y").alias("__w")).join(base, "site").select(
        "site", "dow", (F.col("__w") - F.col("__b")).alias("weekly"))
    dy = x.groupBy("site", "hour").agg(F.avg("y").alias("__d")).join(base, "site").select(
        "site", "hour", (F.col("__d") - F.col("__b")).alias("daily"))
    yr = x.groupBy("site", "month").agg(F.avg("y").alias("__m")).join(base, "site").select(
        "site", "month", (F.col("__m") - F.col("__b")).alias("yearly"))
    hd = (x.groupBy("site", "month", "dom").agg(F.avg("y").alias("__h")).join(base, "site").join(yr, ["site", "month"])
          .select("site", "month", "dom", (F.col("__h") - F.col("__b") - F.col("yearly")).alias("holidays")))
    combos_a = x.select("site", "dow", "hour").distinct()
    weekly = combos_a.join(wk, ["site", "dow"], "left").join(dy, ["site", "hour"], "left")
    yearly = hd.join(yr, ["site", "month"], "left").select("site", "month", "dom", "yearly", "holidays")
    return weekly.select("site", "dow", "hour", "weekly", "daily"), yearly


def _fourier(t: np.ndarray, period: float, k: int) -> np.ndarray:
    cols = []
    for j in range(1, k + 1):
        a = 2 * np.pi * j * t / period
        cols += [np.sin(a), np.cos(a)]
    return np.column_stack(cols) if cols else np.zeros((len(t), 0))


def _ridge(X: np.ndarray, y: np.ndarray, lam: float) -> np.ndarray:
    A = X.T @ X + lam * np.eye(X.shape[1])
    return np.linalg.solve(A, X.T @ y)


def fit_seasonality_week(df: DataFrame, site: str, ts: str, y: str, k_week: int = 3, k_day: int = 4,
                         lam: float = 1.0, group_cols: list[str] = ()) -> DataFrame:
    """Weekly and daily seasonal components per site.

    The series is first reduced (in Spark) to the mean per hour of week --
    at most 168 points per site -- then each site's points are fitted with a
    ridge regression on weekly (period 168 h) and daily (period 24 h)
    Fourier terms.  Output: (site, dow 1=Sunday, hour, weekly, daily).
    """
    keys = [*group_cols, site]
    how = ((F.dayofweek(ts) - 1) * 24 + F.hour(ts)).alias("how")
    pts = df.groupBy(*[F.col(k) for k in keys], how).agg(F.avg(y).alias("y"))
    out_schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields]
                           + ["dow int", "hour int", "weekly double", "daily double"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        t = pdf["how"].to_numpy(dtype=float)
        yy = pdf["y"].to_numpy(dtype=float)
        ok = ~np.isnan(yy)
        Xw, Xd = _fourier(t, 168.0, k_week), _fourier(t, 24.0, k_day)
        X = np.column_stack([np.ones_like(t), Xw, Xd])
        grid = np.arange(168, dtype=float)
        if ok.sum() < 2:
            wv = dv = np.zeros(168)
        else:
            beta = _ridge(X[ok], yy[ok], lam)
            nw = Xw.shape[1]
            wv = _fourier(grid, 168.0, k_week) @ beta[1:1 + nw]
            dv = _fourier(grid, 24.0, k_day) @ beta[1 + nw:]
        res = pd.DataFrame({"dow": (grid // 24 + 1).astype("int32"), "hour": (grid % 24).astype("int32"),
                            "weekly": wv, "daily": dv})
        for k in keys:
            res[k] = pdf[k].iloc[0]
        return res[[*keys, "dow", "hour", "weekly", "daily"]]

    return pts.groupBy(*keys).applyInPandas(fit, out_schema)


def fit_seasonality_year(df: DataFrame, site: str, ts: str, y: str, holidays: list[str] = (), k_year: int = 6,
                         lam: float = 1.0, group_cols: list[str] = ()) -> DataFrame:
    """Yearly component and holiday effects per site.

    Reduced to the mean per (month, day of month) -- at most 366 points per
    site; 29 Feb is filled with the mean of 28 Feb and 1 Mar; sites with
    fewer than 2 points return zeros.  Holiday indicators are the listed
    (month, day) pairs.  Output: (site, month, dom, yearly, holidays).
    """
    keys = [*group_cols, site]
    pts = df.groupBy(*[F.col(k) for k in keys], F.month(ts).alias("month"), F.dayofmonth(ts).alias("dom")).agg(
        F.avg(y).alias("y"))
    hol = sorted({(int(h[5:7]), int(h[8:10])) for h in holidays})
    out_schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields]
                           + ["month int", "dom int", "yearly double", "holidays double"])
    cal = pd.date_range("2024-01-01", "2024-12-31", freq="D")  # leap-year calendar: 366 slots

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        s = {(int(m), int(dd)): float(v) for m, dd, v in zip(pdf["month"], pdf["dom"], pdf["y"])}
        if (2, 29) not in s and (2, 28) in s and (3, 1) in s:
            s[(2, 29)] = (s[(2, 28)] + s[(3, 1)]) / 2
        slots = [(d.month, d.day) for d in cal]
        doy = np.array([i for i, md in enumerate(slots) if md in s], dtype=float)
        yy = np.array([s[md] for md in slots if md in s], dtype=float)
        grid = np.arange(366, dtype=float)
        H = np.array([[1.0 if slots[int(i)] == h else 0.0 for h in hol] for i in grid]) if hol else np.zeros((366, 0))
        if len(yy) < 2:
            yv = hv = np.zeros(366)
        else:
            Xy = _fourier(doy, 366.0, k_year)
            Xh = H[doy.astype(int)]
            beta = _ridge(np.column_stack([np.ones_like(doy), Xy, Xh]), yy, lam)
            ny = Xy.shape[1]
            yv = _fourier(grid, 366.0, k_year) @ beta[1:1 + ny]
            hv = H @ beta[1 + ny:] if hol else np.zeros(366)
        res = pd.DataFrame({"month": [m for m, _ in slots], "dom": [d for _, d in slots], "yearly": yv, "holidays": hv})
        res["month"] = res["month"].astype("int32")
        res["dom"] = res["dom"].astype("int32")
        for k in keys:
            res[k] = pdf[k].iloc[0]
        return res[[*keys, "month", "dom", "yearly", "holidays"]]

    return pts.groupBy(*keys).applyInPandas(fit, out_schema)


def seasonality_by_fold(df: DataFrame, bounds: DataFrame, site: str, ts: str, y: str,
                        holidays: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Fit D5/D6 on each fold's training span (and any extra span rows
    in ``bounds``) in one grouped job keyed by (fold, site)."""
    x = joins.assign_intervals(df, bounds, ts)
    return (fit_seasonality_week(x, site, ts, y, group_cols=["fold"]),
            fit_seasonality_year(x, site, ts, y, holidays, group_cols=["fold"]))


def apply_by_fold(df: DataFrame, weekly: DataFrame, yearly: DataFrame, folds: list[int], site: str,
                  ts: str) -> DataFrame:
    """Attach each fold's components with a ``_<fold>`` suffix."""
    out = df
    for f in folds:
        w = weekly.filter(F.col("fold") == f).drop("fold").withColumnRenamed(site, "site")
        yv = yearly.filter(F.col("fold") == f).drop("fold").withColumnRenamed(site, "site")
        out = joins.apply_seasonality(out, w, yv, site, ts, suffix=f"_{f}")
    return out


def trend_features(df: DataFrame, site: str, ts: str, y: str, shift_days: int = 7, min_days: int = 90,
                   window: int = 7) -> DataFrame:
    """Per-site trend / weekly season / residual of the daily mean,
    shifted forward ``shift_days``; a row only sees data at least that old.

    Every component looks back only: a missing day carries the last one on,
    the trend is the mean of the last ``window`` days, and the season is the
    weekday's mean residue so far.  Components start on a site's
    ``min_days``-th day.

    All of it is windows over the daily series (one row per site and day of
    its span, so a site's partition is bounded by the calendar), joined back
    on (site, day).
    """
    daily = df.groupBy(F.col(site).alias("__site"), F.to_date(ts).alias("__day")).agg(F.avg(y).alias("y")).filter("__day IS NOT NULL")
    span = daily.groupBy("__site").agg(F.min("__day").alias("lo"), F.max("__day").alias("hi"))
    days = span.select("__site", F.explode(F.sequence("lo", "hi")).alias("__day"))
    on = F.col("__site").eqNullSafe(F.col("s2")) & (F.col("__day") == F.col("d2"))
    full = days.join(daily.select(F.col("__site").alias("s2"), F.col("__day").alias("d2"), "y"), on, "left")
    back = Window.partitionBy("__site").orderBy("__day")
    carried = full.select("__site", "__day", F.last("y", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0)).alias("y"))
    comp = carried.select("__site", "__day", "y", F.avg("y").over(back.rowsBetween(1 - window, 0)).alias("trend"), F.row_number().over(back).alias("n"))
    by_weekday = Window.partitionBy("__site", F.dayofweek("__day")).orderBy("__day").rowsBetween(Window.unboundedPreceding, 0)
    comp = comp.withColumn("season", F.avg(F.col("y") - F.col("trend")).over(by_weekday)).filter(F.col("n") >= min_days)
    comp = comp.select("__site", F.date_add("__day", shift_days).alias("__day"), "trend", "season",
                       (F.col("y") - F.col("trend") - F.col("season")).alias("resid"))
    out = df.join(comp, (df[site] == comp["__site"]) & (F.to_date(df[ts]) == comp["__day"]), "left")
    return out.drop("__site", "__day")
