"""String, array and map expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadtime.functions._util import col

# METAR patterns (wind group, peak wind, hourly precipitation,
# station after the report type).
WIND_RE = r"\b(\d{3})(\d{2,3})(?:G(\d{2,3}))?KT\b"
PEAK_WIND_RE = r"PK WND (\d{3})(\d{2,3})/(\d{4})"
PRECIP_RE = r" P(\d+)"
STATION_RE = r"(?:METAR|SPECI)\s(\S+)"


def _num(s: Column) -> Column:
    """'' or unparsable -> NULL (ANSI cast would raise)."""
    return F.when(s != "", s).try_cast("double")


def station_code(c) -> Column:
    """last five characters of a station id."""
    return F.substring(col(c), -5, 5)


def metar_wind_speed(remark, current=None) -> Column:
    """wind speed from the remark's wind group; fills only NULLs."""
    parsed = _num(F.regexp_extract(col(remark), WIND_RE, 2))
    return parsed if current is None else F.coalesce(col(current), parsed)


def metar_gust(remark, current=None) -> Column:
    """gust = greatest(gust group, peak wind speed); NULLs skipped."""
    gust = _num(F.regexp_extract(col(remark), WIND_RE, 3))
    peak = _num(F.regexp_extract(col(remark), PEAK_WIND_RE, 2))
    parsed = F.greatest(gust, peak)
    return parsed if current is None else F.coalesce(col(current), parsed)


def metar_precip(raw, remark) -> Column:
    """hourly precipitation.

    NULL or '*' raw value -> ' P(dddd)' group of the remark x 0.01;
    otherwise 'T' (trace) -> 0.01 wherever it appears, then the first
    number in the string.
    """
    from_rem = _num(F.regexp_extract(col(remark), PRECIP_RE, 1)) * 0.01
    cleaned = F.regexp_replace(col(raw), "T", "0.01")
    first = _num(F.regexp_extract(cleaned, r"(\d+\.?\d*)", 1))
    return F.when(col(raw).isNull() | (col(raw) == "*"), from_rem).otherwise(first)


def metar_station(remark) -> Column:
    """station code after METAR/SPECI; '' -> NULL."""
    s = F.regexp_extract(col(remark), STATION_RE, 1)
    return F.when(s != "", s)


def split_pair(c, order: str = "lat,lon", sep: str = ",") -> tuple[Column, Column]:
    """split 'a,b' into (lat, lon); ``order`` says which comes first."""
    parts = F.split(col(c), sep)
    a = F.trim(F.element_at(parts, 1)).try_cast("double")
    b = F.trim(F.element_at(parts, 2)).try_cast("double")
    return (a, b) if order == "lat,lon" else (b, a)


def region_part(c, sep: str = "-") -> Column:
    """'US-TX' -> 'TX'."""
    return F.element_at(F.split(col(c), sep), 2)


def null_count(cols) -> Column:
    """number of NULLs over a list of columns."""
    return reduce(lambda a, b: a + b, [F.when(col(c).isNull(), 1).otherwise(0) for c in cols])


def first_non_null(cols) -> Column:
    """coalesce of alternative codes."""
    return F.coalesce(*[col(c) for c in cols])


def last_non_null(arr, n: int) -> Column:
    """drop NULLs, keep the last n, newest last."""
    f = F.filter(col(arr), lambda x: x.isNotNull())
    return F.slice(f, F.greatest(F.size(f) - (n - 1), F.lit(1)), n)


def entries_to_map(arr, key: str, value: str) -> Column:
    """array<struct> -> map."""
    return F.map_from_entries(F.transform(col(arr), lambda s: F.struct(s[key], s[value])))


def parse_adjacency(line) -> tuple[Column, Column]:
    """"node<TAB>{'nbr': n, ...}" -> (node, map<string,int>)."""
    parts = F.split(col(line), "\t", 2)
    node = F.element_at(parts, 1)
    js = F.regexp_replace(F.element_at(parts, 2), "'", '"')
    return node, F.from_json(js, "map<string,int>")


def positive_probability(v) -> Column:
    """probability of class 1 from an ML vector."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(col(v)).getItem(1)


def path_label(cols, sep: str = "-") -> Column:
    """route label by concatenation."""
    return F.concat_ws(sep, *[col(c) for c in cols])


def residual(y, p) -> Column:
    """F32: y - p."""
    return col(y).cast("double") - col(p).cast("double")


def map_series(fn, return_type: str = "double"):
    """Wrap a pandas Series -> Series function as a vectorised (Arrow)
    pandas UDF -- the hook for per-row logic that has no native form."""
    from pyspark.sql.functions import pandas_udf
    return pandas_udf(fn, return_type)
