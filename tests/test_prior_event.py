"""Hand-built aircraft rotation covering every branch of the prior-event
features (departed, still on the ground, late in the air, arrived,
wrong origin, cancelled prior, prior too old)."""

from datetime import datetime

import pytest

from leadtime.plans import features as ft

ROWS = [  # trip_id, entity, origin, dest, sched, cancelled, delay_min
    (1, 7, "A", "B", datetime(2024, 3, 1, 8, 0), 0, 10.0),
    (2, 7, "B", "C", datetime(2024, 3, 1, 11, 0), 0, 30.0),
    (3, 7, "C", "D", datetime(2024, 3, 1, 12, 0), 0, 120.0),
    (4, 7, "D", "E", datetime(2024, 3, 1, 15, 0), 0, 0.0),
    (5, 7, "X", "Y", datetime(2024, 3, 2, 9, 0), 0, 0.0),
    (6, 7, "Y", "Z", datetime(2024, 3, 2, 12, 0), 1, None),
    (7, 7, "Z", "W", datetime(2024, 3, 2, 16, 0), 0, 5.0),
    (8, 7, "W", "V", datetime(2024, 3, 4, 10, 0), 0, 0.0),
]
# trip_id -> (valid, isdeparted, depdelay_calc, isdelayed_calc, isarrived_calc, turnaround)
EXPECTED = {
    1: (0, 0, 0.0, 0, 0, None),
    2: (1, 1, 10.0, 0, 0, 110.0),
    3: (1, 0, 0.0, 0, 0, 0.0),
    4: (1, 0, 60.0, 1, 0, 60.0),
    5: (0, 0, 0.0, 0, 0, None),
    6: (1, 1, 0.0, 0, 1, 120.0),
    7: (0, 0, 0.0, 1, 0, None),
    8: (0, 0, 0.0, 0, 0, None),
}


@pytest.mark.parametrize("width", [86400.0, 3600.0])
def test_prior_event_branches(spark, width, monkeypatch):
    df = spark.createDataFrame(ROWS, "trip_id long, entity long, origin string, dest string, sched timestamp, "
                                     "cancelled int, delay_min double")
    df = df.withColumn("duration_min", df.cancelled * 0 + 60)
    t = ft.trip_times(df)
    from leadtime.operators import windows
    orig = windows.prior_event

    def narrow(*a, **k):
        k["width_s"] = width
        return orig(*a, **k)
    monkeypatch.setattr(windows, "prior_event", narrow)
    out = ft.prior_event_features(t)
    got = {r["trip_id"]: (r["prior_valid"], r["prior_isdeparted"], r["prior_depdelay_calc"], r["prior_isdelayed_calc"],
                          r["prior_isarrived_calc"], r["prior_turnaround"]) for r in out.collect()}
    assert got == EXPECTED
