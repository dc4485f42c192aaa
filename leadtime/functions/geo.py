"""Geographic expressions (F17-F19, F22): all native Spark SQL math."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadtime.functions._util import col

# Earth radius used by the reference, in km and in miles.
EARTH_RADIUS = {"km": 6371.0, "mi": 3956.0}
# Fixed value: the geohash base-32 alphabet (standard, public).
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def haversine(lat1, lon1, lat2, lon2, unit: str = "km") -> Column:
    """great-circle distance; 2R*asin(sqrt(a))."""
    r = EARTH_RADIUS[unit]
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    dlat = p2 - p1
    dlon = F.radians(col(lon2)) - F.radians(col(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * r) * F.asin(F.sqrt(a))


def euclidean(lat1, lon1, lat2, lon2) -> Column:
    """Euclidean distance in degrees."""
    return F.sqrt(F.pow(col(lat1) - col(lat2), 2) + F.pow(col(lon1) - col(lon2), 2))


def dms_to_decimal(d, m, s) -> Column:
    """degrees/minutes/seconds -> decimal degrees, sign of degrees kept."""
    mag = F.abs(col(d)) + col(m) / 60.0 + col(s) / 3600.0
    return F.when(col(d) < 0, -mag).otherwise(mag)


def geohash(lat, lon, precision: int) -> Column:
    """geohash of a point, computed natively.

    Latitude and longitude are quantised to ``floor(5n/2)`` and
    ``ceil(5n/2)`` bits (same as repeated bisection with ``>=`` going
    right), the bits are interleaved longitude-first and read five at a
    time against the base-32 alphabet.  No Python per row.
    """
    nbits = 5 * precision
    nlon = (nbits + 1) // 2
    nlat = nbits // 2
    qlat = F.least(F.floor((col(lat) + 90.0) / 180.0 * F.lit(float(1 << nlat))).cast("long"), F.lit((1 << nlat) - 1))
    qlon = F.least(F.floor((col(lon) + 180.0) / 360.0 * F.lit(float(1 << nlon))).cast("long"), F.lit((1 << nlon) - 1))
    chars = []
    for ci in range(precision):
        v = None
        for k in range(5):
            i = ci * 5 + k
            if i % 2 == 0:
                bit = F.shiftright(qlon, nlon - 1 - i // 2).bitwiseAND(1)
            else:
                bit = F.shiftright(qlat, nlat - 1 - i // 2).bitwiseAND(1)
            term = F.shiftleft(bit, 4 - k)
            v = term if v is None else v + term
        chars.append(F.substring(F.lit(GEOHASH_ALPHABET), (v + 1).cast("int"), 1))
    out = F.concat(*chars)
    return F.when(col(lat).isNotNull() & col(lon).isNotNull(), out)


def geohash_bbox(gh) -> Column:
    """bounding box (lat_min, lat_max, lon_min, lon_max) of a geohash.

    Decodes each character's 5 bits with higher-order functions.  The bits are
    the array that is folded, each with its axis, so a row's hash is split once
    and not once a bit; the fold gives the whole box as one value.
    """
    g = col(gh)
    vals = F.transform(F.split(g, ""), lambda ch: F.instr(F.lit(GEOHASH_ALPHABET), ch) - 1)
    bits = F.flatten(F.transform(vals, lambda v: F.array(*[F.shiftright(v, 4 - k).bitwiseAND(1) for k in range(5)])))
    # even places cut the longitude, odd ones the latitude
    cuts = F.transform(bits, lambda b, i: F.struct(b.alias("b"), ((i % 2) == 0).alias("lon")))
    init = F.struct(F.lit(-90.0).alias("lat_min"), F.lit(90.0).alias("lat_max"),
                    F.lit(-180.0).alias("lon_min"), F.lit(180.0).alias("lon_max"))

    def step(acc, x):
        lon_mid = (acc["lon_min"] + acc["lon_max"]) / 2
        lat_mid = (acc["lat_min"] + acc["lat_max"]) / 2
        return F.struct(
            F.when(~x["lon"] & (x["b"] == 1), lat_mid).otherwise(acc["lat_min"]).alias("lat_min"),
            F.when(~x["lon"] & (x["b"] == 0), lat_mid).otherwise(acc["lat_max"]).alias("lat_max"),
            F.when(x["lon"] & (x["b"] == 1), lon_mid).otherwise(acc["lon_min"]).alias("lon_min"),
            F.when(x["lon"] & (x["b"] == 0), lon_mid).otherwise(acc["lon_max"]).alias("lon_max"),
        )

    return F.when(F.length(g) > 0, F.aggregate(cuts, init, step))


def in_bbox(lat, lon, box) -> Column:
    """whether a point lies in a ``geohash_bbox`` (borders included).  The
    box is bound once: a filter on its fields would decode it for each."""
    return F.exists(F.array(col(box)), lambda b: (col(lat) >= b["lat_min"]) & (col(lat) <= b["lat_max"])
                    & (col(lon) >= b["lon_min"]) & (col(lon) <= b["lon_max"]))
