"""Composite feature operators.

Each takes column names as arguments and returns a DataFrame with the same
rows as its input plus feature columns.  Every feature is computed from
information available at an explicit cutoff (e.g. t - 2h), never later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtime.functions import timeops as tm
from leadtime.operators import joins, windows

_MIN = 60_000_000.0


def _minutes_between(a: Column, b: Column) -> Column:
    """(b - a) in minutes."""
    return (F.unix_micros(b) - F.unix_micros(a)) / F.lit(_MIN)


def prior_event_features(df: DataFrame, entity: str = "entity", sched: str = "sched", tie: str = "trip_id",
                         origin: str = "origin", dest: str = "dest", cancelled: str = "cancelled",
                         actual_dep: str = "actual_dep", sched_elapsed: str = "sched_elapsed",
                         actual_elapsed: str = "actual_elapsed", dep_delay: str = "delay_min",
                         sched_arr: str = "sched_arr", actual_arr: str = "actual_arr",
                         cutoff_h: float = 2.0, horizon_h: float = 24.0, cancelled_first: bool = False,
                         prefix: str = "prior_") -> DataFrame:
    """Features of the same entity's previous event, as known at
    ``sched - cutoff_h``.

    valid = prior destination is this origin, prior scheduled no earlier
    than cutoff - horizon, prior not cancelled (no prior -> not valid).
    Outputs: ``isdeparted``, ``depdelay_calc``, ``deptime_calc``,
    ``isdelayed_calc``, ``isarrived_calc``, ``arr_time_calc``,
    ``turnaround`` (minutes), ``sched_elapsed``/``true_elapsed`` (valid only)
    plus the raw lagged columns.  The lag is taken over
    (entity, day) partitions with a one-row halo, so an entity with a huge
    history is still spread over many tasks.
    """
    p = prefix
    lag_cols = [cancelled, origin, dest, sched, actual_dep, sched_elapsed, actual_elapsed, dep_delay,
                sched_arr, actual_arr]
    base = df
    order_tie = tie
    if cancelled_first:
        base = base.withColumn("__cf", -F.col(cancelled))
        order_tie = "__cf"
    lagged = _prior_rows(base, entity, sched, tie, order_tie, lag_cols, p)
    t2 = tm.hours_before(sched, cutoff_h)
    horizon = tm.hours_before(sched, cutoff_h + horizon_h)
    L = lambda c: F.col(f"{p}{c}")
    valid = F.coalesce((F.col(origin) == L(dest)) & (L(sched) >= horizon) & (L(cancelled) == 0), F.lit(False))
    departed = F.coalesce(L(actual_dep) <= t2, F.lit(False)) & valid
    in_air_late = F.coalesce((L(sched) <= t2) & (L(actual_dep) > t2), F.lit(False)) & valid
    depdelay = (F.when(departed, L(dep_delay).cast("double"))
                .when(in_air_late, _minutes_between(L(sched), t2)).otherwise(F.lit(0.0)))
    out = lagged.withColumns({
        f"{p}valid": valid.cast("int"),
        f"{p}sched_elapsed_v": F.when(valid, L(sched_elapsed).cast("double")),
        f"{p}true_elapsed_v": F.when(valid, L(actual_elapsed).cast("double")),
        f"{p}isdeparted": departed.cast("int"),
        f"{p}depdelay_calc": depdelay,
    })
    out = out.withColumns({
        f"{p}deptime_calc": tm.add_minutes(L(sched), L("depdelay_calc")),
        f"{p}isdelayed_calc": F.when((L("depdelay_calc") >= 15) | F.coalesce(L(cancelled) == 1, F.lit(False)), 1).otherwise(0),
        f"{p}isarrived_calc": (F.coalesce(L(actual_arr) <= t2, F.lit(False)) & valid).cast("int"),
    })
    arr = (F.when(L("isarrived_calc") == 1, L(actual_arr))
           .when(F.coalesce(L(actual_dep) <= t2, F.lit(False)), tm.add_minutes(L(actual_dep), L("sched_elapsed_v")))
           .otherwise(tm.add_minutes(L("deptime_calc"), L("sched_elapsed_v"))))
    out = out.withColumn(f"{p}arr_time_calc", arr)
    out = out.withColumn(f"{p}turnaround", F.when(valid, _minutes_between(L("arr_time_calc"), F.col(sched))))
    return out.drop("__cf") if cancelled_first else out


def _prior_rows(df, entity, sched, tie, order_tie, cols, prefix):
    if order_tie == tie:
        return windows.prior_event(df, entity, sched, tie, cols, prefix)
    # cancelled-first ordering: (sched, -cancelled, tie)
    h = windows.rows_halo(df.withColumn("__o2", F.struct(F.col(order_tie), F.col(tie))), [entity], sched, "__o2", back=1,
                          carry=cols)
    w = Window.partitionBy(entity, "__bk").orderBy(sched, "__o2")
    out = h.select("*", *[F.lag(c).over(w).alias(f"{prefix}{c}") for c in cols])
    return out.filter("__halo = 0").drop("__halo", "__bk", "__o2")


def trip_times(df: DataFrame, sched: str = "sched", delay: str = "delay_min", duration: str = "duration_min") -> DataFrame:
    """Derived times of a trip table: actual departure (F11), scheduled and
    actual arrival, scheduled and actual elapsed minutes."""
    return df.withColumns({
        "actual_dep": tm.actual_time(sched, delay),
        "sched_arr": tm.add_minutes(sched, F.col(duration).cast("double")),
        "sched_elapsed": F.col(duration).cast("double"),
        "actual_elapsed": F.col(duration).cast("double"),
    }).withColumn("actual_arr", tm.add_minutes("actual_dep", F.col(duration).cast("double")))


def lagged_daily(df: DataFrame, site: str, ts: str, delay: str, label: str, n_days: int = 30,
                 expose_same_day: bool = False) -> DataFrame:
    """D3: daily per-site mean delay and share delayed, averaged over the
    previous ``n_days`` daily rows (today excluded), joined back on
    (site, day).  The same-day values leak the label and are only returned
    with ``expose_same_day=True``."""
    day = F.to_date(ts)
    daily = df.groupBy(F.col(site).alias("__site"), day.alias("__day")).agg(
        F.avg(delay).alias("day_mean_delay"), F.avg(label).alias("day_prop_delayed"))
    w = Window.partitionBy("__site").orderBy("__day").rowsBetween(-n_days, -1)
    daily = daily.withColumns({"lag_mean_delay": F.avg("day_mean_delay").over(w),
                               "lag_prop_delayed": F.avg("day_prop_delayed").over(w)})
    if not expose_same_day:
        daily = daily.drop("day_mean_delay", "day_prop_delayed")
    out = df.join(daily, (df[site] == daily["__site"]) & (day == daily["__day"]), "left")
    return out.drop("__site", "__day")


def recency_features(df: DataFrame, site: str, sched: str, actual: str, delay: str, label: str,
                     cutoff_h: float = 2.0, span_h: float = 4.0, partition_extra: list[str] = ()) -> DataFrame:
    """Site recency statistics ``mean_dep_delay`` and ``prop_delayed``:
    over the site's rows scheduled in the last ``span_h`` hours, only those
    actually departed before the cutoff (W10, both in one frame)."""
    return windows.lagged_stat(df, [site, *partition_extra], sched, actual, None,
                               {"mean_dep_delay": delay, "prop_delayed": label}, span_s=span_h * 3600,
                               cutoff_s=cutoff_h * 3600)


def impute_spatial_temporal(df: DataFrame, cols: list[str], area: str, site: str, t: str, tie: str,
                            secs: float = 7200.0, n: int = 8, alpha: float = 0.5) -> DataFrame:
    """Two-step fill of measures: (1) latest value of the same area
    (geohash) within ``secs`` before; (2) exponential smoothing of the
    site's previous ``n`` rows.  Own values are never replaced.  Each step is
    one window over all columns, so shuffles don't grow with their number."""
    out = windows.ffill_range(df, [area], t, list(cols), secs)
    return windows.ema_fill(out, site, t, tie, list(cols), n, alpha)


def overwrite_from_area(df: DataFrame, col: str, area: str, t: str, tie: str, n: int = 6) -> DataFrame:
    """First version: last non-NULL in the area's last ``n`` rows
    including the row itself, overwriting."""
    return windows.ffill_rows(df, [area], t, tie, col, n - 1, include_self=True, overwrite=True)


def impute_from_route(df: DataFrame, route: list[str], t: str, tie: str, col: str, valid: str,
                      n: int = 10, hours: float = 72.0, out: str | None = None) -> DataFrame:
    """Replace values of invalid rows (``not coalesce(valid, false)``)
    by the route's last non-NULL valid value in the previous ``n`` rows,
    else by the route's mean over the previous ``hours`` hours."""
    o = out or f"{col}_filled"
    ok = F.coalesce(F.col(valid).cast("boolean"), F.lit(False))
    x = df.withColumn("__v", F.when(ok, F.col(col)))
    x = windows.ffill_rows(x, route, t, tie, "__v", n, out="__last")
    x = windows.range_mean_if(x, route, t, "__v", None, hours * 3600, out="__mean")
    return x.withColumn(o, F.when(ok, F.col(col)).otherwise(F.coalesce(F.col("__last"), F.col("__mean")))).drop(
        "__v", "__last", "__mean")


def holiday_distance(df: DataFrame, day: Column, holidays: DataFrame, day_col: str = "day",
                     week: int = 3) -> DataFrame:
    """days to each holiday (array, holiday order), the nearest, and
    whether any is within ``week`` days.  The calendar is gathered into one
    row in Spark and joined; the result holds a number per holiday and row,
    so it is meant for a calendar of a few hundred days at most."""
    cal = holidays.agg(F.array_sort(F.collect_list(F.col(day_col).cast("date"))).alias("__cal"))
    dist = F.transform("__cal", lambda h: F.abs(F.datediff(day, h)))
    out = df.join(cal)   # one row
    return out.withColumns({"days_each": dist, "days_to_holiday": F.array_min(dist),
                            "in_holiday_week": F.exists(dist, lambda x: x <= week).cast("int")}).drop("__cal")


def attach_zone(df: DataFrame, point_id: str, lat: str, lon: str, zones: DataFrame,
                z_id: str, z_lat: str, z_lon: str, zone: str, default: str = "Unknown") -> DataFrame:
    """zone name of the nearest known zone point (exact grid search,
    see ``joins.nearest``); points without coordinates get ``default``."""
    pts = df.select(point_id, lat, lon).distinct()
    nn = joins.nearest(pts, zones, point_id, lat, lon, z_id, z_lat, z_lon)
    zz = zones.select(F.col(z_id).alias("__zid"), F.col(zone).alias("__zone"))
    nn = nn.join(zz, nn[z_id] == zz["__zid"], "left").select(point_id, "__zone")
    out = df.join(nn, point_id, "left")
    return out.withColumn(zone, F.coalesce(F.col("__zone"), F.lit(default))).drop("__zone")


def clean_readings(readings: DataFrame, sites: DataFrame, key: str, t: str, feats: list[str], tie: str,
                   site_key: str, zone: str) -> DataFrame:
    """Reading clean flow: dedup (fewest NULLs per key and time),
    zone lookup, local -> UTC."""
    d = windows.dedup_least_null(readings, [key, t], feats, [tie])
    z = sites.select(F.col(site_key).alias("__sk"), F.col(zone).alias("__zone"))
    d = d.join(z, d[key] == z["__sk"], "left").drop("__sk")
    return d.withColumn(f"{t}_utc", tm.to_utc(t, "__zone")).withColumnRenamed("__zone", zone)


def enrich_events(trips: DataFrame, sites: DataFrame, stations: DataFrame, readings: DataFrame,
                  row_id: str = "trip_id", origin: str = "origin", dest: str = "dest", sched_local: str = "sched",
                  site_key: str = "site_id", reading_site: str = "site", read_ts: str = "read_ts",
                  reading_id: str = "reading_id", min_age_h: float = 2.0, max_age_h: float = 4.0) -> DataFrame:
    """Full enrichment flow.

    dedup -> origin/destination site attributes (J1) -> nearest weather
    station per site (J6, exact grid search) -> zone -> local schedule to
    UTC (F8) -> t-2h, t-4h (F10) -> as-of reading at the origin in
    [t-4h, t-2h] (J10).  Readings' times are UTC.
    """
    t = trips.dropDuplicates([row_id])
    st = joins.nearest(sites, stations, site_key, "lat", "lon", "station_id", "lat", "lon")
    dim = sites.join(st.withColumnRenamed("distance", "station_km"), site_key, "left")
    t = joins.lookup_two_roles(t, dim, site_key, {origin: "origin_", dest: "dest_"},
                               ["zone", "region", "station_id", "station_km"])
    t = t.withColumn("sched_utc", tm.to_utc(sched_local, "origin_zone"))
    t = t.withColumns({"t2_utc": tm.hours_before("sched_utc", min_age_h), "t4_utc": tm.hours_before("sched_utc", max_age_h)})
    r = readings.select(F.col(reading_site).alias("__rsite"), F.col(read_ts).alias("w_read_ts"),
                        F.col(reading_id).alias("w_reading_id"),
                        *[F.col(c).alias(f"w_{c}") for c in readings.columns if c not in (reading_site, read_ts, reading_id)])
    out = joins.asof_join(t, r, origin, "__rsite", "sched_utc", "w_read_ts", min_age_h * 3600, max_age_h * 3600,
                          row_id, tie="w_reading_id")
    return out


def feature_table(trips: DataFrame, sites: DataFrame, stations: DataFrame, readings: DataFrame,
                  holidays: DataFrame, row_id: str = "trip_id", entity: str = "entity", origin: str = "origin",
                  dest: str = "dest", sched: str = "sched", delay: str = "delay_min", cancelled: str = "cancelled",
                  duration: str = "duration_min", period: str | None = None) -> DataFrame:
    """
    enrichment with the as-of reading at the origin (D15), label (P5),
    derived times, prior-event features (D1), site recency statistics (D4),
    daily lagged site statistics (D3), holiday distance (F24), cyclic time
    encodings (F13/F14) and, when ``period`` is given, the previous period's
    network rank of the origin (D13).  One row per input trip."""
    from leadtime.operators.clean import label
    from leadtime.plans.features_graph import previous_period_rank
    from leadtime.sources.io import stage_to
    t = enrich_events(trips, sites, stations, readings, row_id=row_id, origin=origin, dest=dest, sched_local=sched)
    t = t.withColumn("label", label(delay, cancelled))
    t = trip_times(t, "sched_utc", delay, duration)
    # Materialise the enriched table once (Parquet in the shared checkpoint
    # folder): the window features and the network ranks below all read it.
    base = stage_to(t)
    t = prior_event_features(base, entity=entity, sched="sched_utc", tie=row_id, origin=origin, dest=dest,
                             cancelled=cancelled, dep_delay=delay)
    t = recency_features(t, origin, "sched_utc", "actual_dep", delay, "label")
    t = lagged_daily(t, origin, "sched_utc", delay, "label")
    t = holiday_distance(t, F.to_date("sched_utc"), holidays)
    hs, hc = tm.cyclic(F.hour("sched_utc"), 24)
    ds, dc = tm.cyclic(F.dayofweek("sched_utc"), 7)
    t = t.withColumns({"hour_sin": hs, "hour_cos": hc, "dow_sin": ds, "dow_cos": dc})
    if period:
        t = previous_period_rank(t, origin, dest, period, iters=10, graph_rows=base)
    return t
