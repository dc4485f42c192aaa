"""Views derived from the supplied test tables (see FIXTURES.md).

Each view exists twice: as a Spark plan over the Parquet tables and as a
DuckDB SQL text over the same tables, so every query can be checked
against an oracle.  All views are derived by Spark from the given tables;
their size grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtime.session import use_utc
from leadtime.sources.io import load

# The five zones assigned to sites by nation key modulo 5.
ZONES = ["America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles", "America/Phoenix"]
# Holiday dates of the test calendar.
HOLIDAYS = ["2024-01-01", "2024-01-15"]


class Fixtures:
    """Lazy access to base tables and derived views for one scale dir."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        use_utc(spark)
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return load(self.spark, self.dir, name)

    # -- event-derived views -------------------------------------------------
    def trips(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type").isin("click", "error", "purchase"))
        canc = F.when((F.col("event_type") == "error") & (F.col("event_id") % 10 == 0), 1).otherwise(0)
        return e.select(
            F.col("event_id").alias("trip_id"),
            F.col("user_id").alias("entity"),
            F.concat(F.lit("C"), (F.col("user_id") % 7).cast("string")).alias("carrier"),
            (F.col("event_id") % 5).alias("origin"),
            (F.expr("event_id div 5") % 5).alias("dest"),
            F.col("ts").cast("timestamp").alias("sched"),
            canc.alias("cancelled"),
            F.when(canc == 1, F.lit(None).cast("double")).otherwise(F.col("value") - 30).alias("delay_min"),
            (F.lit(30) + F.col("event_id") % 180).alias("duration_min"),
        )

    def readings(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type").isin("view", "signup"))
        i = F.col("event_id")
        remark = F.concat(
            F.lit("METAR K"), F.lpad((i % 5).cast("string"), 3, "A"), F.lit(" "),
            F.lpad(((i % 36) * 10).cast("string"), 3, "0"), F.lpad((i % 60).cast("string"), 2, "0"),
            F.when(i % 3 == 0, F.concat(F.lit("G"), F.lpad((i % 60 + 10).cast("string"), 2, "0"))).otherwise(F.lit("")),
            F.lit("KT"),
            F.when(i % 4 == 0, F.concat(F.lit(" P"), F.lpad((i % 30).cast("string"), 4, "0"))).otherwise(F.lit("")),
            F.when(i % 11 == 0, F.lit(" PK WND 28045/1530")).otherwise(F.lit("")),
        )
        return e.select(
            i.alias("reading_id"), (i % 5).alias("site"), F.col("ts").cast("timestamp").alias("read_ts"),
            F.when(i % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("wind"),
            remark.alias("remark"))

    def scored(self) -> DataFrame:
        e = self.table("events")
        p1 = F.round((F.col("value") % 97) / 97, 6)
        p2 = F.round((F.col("event_id") % 101) / 101, 6)
        p3 = F.round((F.col("user_id") % 11) / 11, 6)
        return e.select(
            "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"),
            F.when(F.col("value") >= 50, 1.0).otherwise(0.0).alias("outcome"),
            p1.alias("p1"), p2.alias("p2"), p3.alias("p3"),
            F.when(p1 >= 0.5, 1.0).otherwise(0.0).alias("pred1"),
            F.when(p2 >= 0.5, 1.0).otherwise(0.0).alias("pred2"),
            F.when(p3 >= 0.5, 1.0).otherwise(0.0).alias("pred3"))

    # -- dimension-like views ------------------------------------------------
    def sites(self) -> DataFrame:
        n = self.table("nation")
        zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (F.col("n_nationkey") % 5 + 1).cast("int"))
        lat = F.lit(25) + F.col("n_nationkey")
        lon = F.lit(-120) + F.lit(2) * F.col("n_nationkey")
        return n.select(
            F.col("n_nationkey").alias("site_id"), F.col("n_name").alias("site_name"),
            lat.cast("double").alias("lat"), lon.cast("double").alias("lon"), zone.alias("zone"),
            F.concat(lat.cast("string"), F.lit(","), lon.cast("string")).alias("coordinates"),
            F.concat(F.lit("US-"), F.col("n_regionkey").cast("string")).alias("region"))

    def stations(self) -> DataFrame:
        s = self.table("supplier")
        return s.select(
            F.col("s_suppkey").alias("station_id"), F.col("s_name").alias("station_name"),
            (F.lit(24) + F.col("s_suppkey") % 27 + 0.25).cast("double").alias("lat"),
            (F.lit(-121) + (F.col("s_suppkey") * 7) % 53).cast("double").alias("lon"))

    def hhmm(self) -> DataFrame:
        o = self.table("orders")
        h = F.col("o_orderkey") % 25
        return o.select(
            F.col("o_orderkey").alias("order_id"), F.to_date(F.col("o_orderdate")).alias("day"),
            F.when(h < 24, h * 100 + F.col("o_orderkey") % 60).otherwise(2400).cast("int").alias("hhmm"),
            (F.col("o_custkey") % 25).alias("site"))

    def edges_dense(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_suppkey")
        o = self.table("orders").select("o_orderkey", "o_custkey")
        c = self.table("customer").select("c_custkey", "c_nationkey")
        s = self.table("supplier").select("s_suppkey", "s_nationkey")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .join(c, o.o_custkey == c.c_custkey)
                .join(s, li.l_suppkey == s.s_suppkey)
                .select(F.col("c_nationkey").cast("string").alias("src"),
                        F.col("s_nationkey").cast("string").alias("dst")))

    def edges_trade(self) -> DataFrame:
        """Customer -> supplier multigraph over every line: its vertices grow
        with the tables, and suppliers have no out-links."""
        li = self.table("lineitem").select("l_orderkey", "l_suppkey")
        o = self.table("orders").select("o_orderkey", "o_custkey")
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src"),
            F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst"))

    def edges_sparse(self) -> DataFrame:
        """Route multigraph with dangling nodes over every order: sources
        0..35 (customer key mod 36), targets 0..39 (order key mod 40), so the
        targets 36..39 have no out-links."""
        o = self.table("orders")
        return o.select((F.col("o_custkey") % 36).cast("string").alias("src"),
                        (F.col("o_orderkey") % 40).cast("string").alias("dst"))

    def adjacency(self) -> DataFrame:
        """edges_sparse as text lines "src<TAB>{'dst': n, ...}" (dst sorted)."""
        e = self.edges_sparse().groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
        g = e.groupBy("src").agg(F.sort_array(F.collect_list(F.struct("dst", "n"))).alias("l"))
        body = F.array_join(F.transform("l", lambda s: F.concat(F.lit("'"), s["dst"], F.lit("': "), s["n"].cast("string"))), ", ")
        return g.select(F.concat(F.col("src"), F.lit("\t{"), body, F.lit("}")).alias("value"))

    def wide_nulls(self) -> DataFrame:
        li = self.table("lineitem")
        k = F.col("l_orderkey")
        return li.select(
            "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate",
            F.when(k % 3 == 0, None).otherwise(F.col("l_quantity")).alias("l_quantity"),
            F.when(k % 5 == 0, None).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
            F.when(k % 7 == 0, None).otherwise(F.col("l_discount")).alias("l_discount"),
            F.when(k % 11 == 0, None).otherwise(F.col("l_tax")).alias("l_tax"))

    def causes(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            "l_orderkey", "l_linenumber", "l_returnflag",
            F.col("l_quantity").alias("cause_a"), (F.col("l_discount") * 100).alias("cause_b"),
            (F.col("l_tax") * 100).alias("cause_c"), (F.col("l_extendedprice") / 1000).alias("cause_d"))

    def folds(self) -> DataFrame:
        """Four half-open 6-day intervals starting 2024-01-01, two days apart."""
        rows = [(i, f"2024-01-{1 + 8 * i:02d} 00:00:00", f"2024-01-{7 + 8 * i:02d} 00:00:00") for i in range(4)]
        return (self.spark.createDataFrame(rows, "fold int, lo string, hi string")
                .select("fold", F.col("lo").cast("timestamp").alias("lo"), F.col("hi").cast("timestamp").alias("hi")))

    def holidays(self) -> DataFrame:
        return self.spark.createDataFrame([(d,) for d in HOLIDAYS], "day string").select(F.to_date("day").alias("day"))

    def daily(self) -> DataFrame:
        o = self.table("orders")
        return (o.groupBy(F.col("o_orderpriority").alias("site"), F.to_date("o_orderdate").alias("day"))
                .agg(F.avg("o_totalprice").alias("y"), F.count(F.lit(1)).alias("n")))


# ----------------------------------------------------------------------------
# The same views in DuckDB SQL (used by oracle_sql()).
_ZONE_CASE = "CASE n_nationkey % 5 " + " ".join(f"WHEN {i} THEN '{z}'" for i, z in enumerate(ZONES)) + " END"

SQL = {
    "trips": """
SELECT event_id AS trip_id, user_id AS entity, 'C' || CAST(user_id % 7 AS VARCHAR) AS carrier,
       event_id % 5 AS origin, (event_id // 5) % 5 AS dest, ts AS sched,
       CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN 1 ELSE 0 END AS cancelled,
       CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN NULL ELSE value - 30 END AS delay_min,
       30 + event_id % 180 AS duration_min
FROM events WHERE event_type IN ('click', 'error', 'purchase')""",
    "readings": """
SELECT event_id AS reading_id, event_id % 5 AS site, ts AS read_ts,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS wind,
       'METAR K' || lpad(CAST(event_id % 5 AS VARCHAR), 3, 'A') || ' '
       || lpad(CAST((event_id % 36) * 10 AS VARCHAR), 3, '0') || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0')
       || CASE WHEN event_id % 3 = 0 THEN 'G' || lpad(CAST(event_id % 60 + 10 AS VARCHAR), 2, '0') ELSE '' END
       || 'KT'
       || CASE WHEN event_id % 4 = 0 THEN ' P' || lpad(CAST(event_id % 30 AS VARCHAR), 4, '0') ELSE '' END
       || CASE WHEN event_id % 11 = 0 THEN ' PK WND 28045/1530' ELSE '' END AS remark
FROM events WHERE event_type IN ('view', 'signup')""",
    "scored": """
SELECT event_id, user_id, event_type, ts,
       CASE WHEN value >= 50 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS outcome,
       round((value % 97) / 97, 6) AS p1, round((event_id % 101) / 101, 6) AS p2,
       round((user_id % 11) / 11, 6) AS p3,
       CASE WHEN round((value % 97) / 97, 6) >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pred1,
       CASE WHEN round((event_id % 101) / 101, 6) >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pred2,
       CASE WHEN round((user_id % 11) / 11, 6) >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pred3
FROM events""",
    "sites": f"""
SELECT n_nationkey AS site_id, n_name AS site_name, CAST(25 + n_nationkey AS DOUBLE) AS lat,
       CAST(-120 + 2 * n_nationkey AS DOUBLE) AS lon, {_ZONE_CASE} AS zone,
       CAST(25 + n_nationkey AS VARCHAR) || ',' || CAST(-120 + 2 * n_nationkey AS VARCHAR) AS coordinates,
       'US-' || CAST(n_regionkey AS VARCHAR) AS region
FROM nation""",
    "stations": """
SELECT s_suppkey AS station_id, s_name AS station_name, CAST(24 + s_suppkey % 27 + 0.25 AS DOUBLE) AS lat,
       CAST(-121 + (s_suppkey * 7) % 53 AS DOUBLE) AS lon
FROM supplier""",
    "hhmm": """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS day,
       CAST(CASE WHEN o_orderkey % 25 < 24 THEN (o_orderkey % 25) * 100 + o_orderkey % 60 ELSE 2400 END AS INTEGER) AS hhmm,
       o_custkey % 25 AS site
FROM orders""",
    "edges_dense": """
SELECT CAST(c.c_nationkey AS VARCHAR) AS src, CAST(s.s_nationkey AS VARCHAR) AS dst
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "edges_trade": """
SELECT 'c' || CAST(o_custkey AS VARCHAR) AS src, 's' || CAST(l_suppkey AS VARCHAR) AS dst
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "edges_sparse": """
SELECT CAST(o_custkey % 36 AS VARCHAR) AS src, CAST(o_orderkey % 40 AS VARCHAR) AS dst FROM orders""",
    "wide_nulls": """
SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
       CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
       CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
       CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_discount END AS l_discount,
       CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_tax END AS l_tax
FROM lineitem""",
    "causes": """
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity AS cause_a, l_discount * 100 AS cause_b,
       l_tax * 100 AS cause_c, l_extendedprice / 1000 AS cause_d
FROM lineitem""",
    "folds": "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, TIMESTAMP '2024-01-{1 + 8 * i:02d} 00:00:00', TIMESTAMP '2024-01-{7 + 8 * i:02d} 00:00:00')"
        for i in range(4)) + ") t(fold, lo, hi)",
    "holidays": "SELECT * FROM (VALUES " + ", ".join(f"(DATE '{d}')" for d in HOLIDAYS) + ") t(day)",
    "daily": """
SELECT o_orderpriority AS site, CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS y, count(*) AS n
FROM orders GROUP BY 1, 2""",
}


def with_views(names: list[str], body: str) -> str:
    """Prefix ``body`` with CTEs for the listed derived views."""
    ctes = ",\n".join(f"{n} AS ({SQL[n]})" for n in names)
    return f"WITH {ctes}\n{body}" if names else body
