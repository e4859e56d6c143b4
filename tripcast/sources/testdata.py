"""Adapter from the driver's TPC-H style tables to the trip model.

The test tables contain no trips; they are mapped onto the trip schema so the
whole catalogue runs over them and grows with them.

Fixed mapping (mirrored one-to-one by ``tripcast.plans.oracle``):

| trip model            | test tables                                            |
|-----------------------|--------------------------------------------------------|
| one trip              | one lineitem row (joined to its order, customer, supplier) |
| business              | l_linestatus 'F' -> 'Uber', 'O' -> 'Lyft'              |
| pickup_location       | s_nationkey (supplier of the line)                     |
| dropoff_location      | c_nationkey (customer of the order)                    |
| trip_length           | l_quantity                                             |
| time_of_day           | class of request hour; hour = o_orderkey mod 24        |
| date                  | Unix seconds of o_orderdate's day                      |
| passenger_fare        | l_extendedprice as DECIMAL(12,2)                       |
| driver_total_pay      | round(fare * (1 - l_discount), 2)                      |
| rideshare_profit      | round(fare * l_discount, 2)                            |
| dollars_per_mile      | pay / trip_length                                      |
| on_scene_to_dropoff   | synthetic: 300 + l_orderkey mod 3000 seconds, NULL where l_linenumber is 7 |
| hourly_rate           | pay * 3600 / on_scene_to_dropoff, 1 too high where l_orderkey mod 97 = 0 |
| other durations       | not present in the tables -> NULL                      |
| zone LocationID       | n_nationkey                                            |
| Borough / Zone        | r_name / n_name                                        |
| service_zone          | synthetic: n_nationkey mod 3 -> Boro Zone, Yellow Zone, EWR |
| waiting times         | events: request day = day of ts, request_to_pickup = value |
| waiting times, years  | orders: request day = o_orderdate, request_to_pickup = o_totalprice / 1000 |
| supplier-customer routes | zones are suppliers (s_suppkey) and customers (-1 - c_custkey) by name |

Pay and profit are rounded separately, so fare - pay = profit fails on the
rows where both halves round up, like the anomalies of the real data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.functions.calendar import time_of_day_class, unix_day_seconds
from tripcast.operators.broadcast import checked_broadcast
from tripcast.operators.spread import spread, task_count
from tripcast.operators.summary import summarise, with_date
from tripcast.schema import MONEY, TRIP_COLUMNS, ZONE_COLUMNS

# Labels of the synthetic mapping.
BUSINESS_BY_LINESTATUS = {"F": "Uber", "O": "Lyft"}
SERVICE_ZONES = ["Boro Zone", "Yellow Zone", "EWR"]
HOURS_PER_DAY = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def zones_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region -> zone lookup (LocationID, Borough, Zone, service_zone)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    sz = F.array(*[F.lit(s) for s in SERVICE_ZONES])
    return (nation.join(checked_broadcast(region), nation.n_regionkey == region.r_regionkey,
                        "inner")
            .select(F.col("n_nationkey").cast("int").alias("LocationID"),
                    F.col("r_name").alias("Borough"),
                    F.col("n_name").alias("Zone"),
                    F.element_at(sz, (F.pmod(F.col("n_nationkey"), F.lit(len(SERVICE_ZONES))) + 1)
                                 .cast("int")).alias("service_zone"))
            .select(*ZONE_COLUMNS))


def _business(c):
    expr = None
    for k, v in BUSINESS_BY_LINESTATUS.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(c)


def trips_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x customer x supplier -> typed trip table.

    Join order is chosen for scale: orders and customer meet first on
    ``custkey``, the narrow result meets lineitem on ``orderkey`` (lineitem
    shuffled once), then the supplier's nation is added.  Customer and
    supplier are broadcast when their row count is proven within the
    broadcast bound, else joined by shuffles (sort-merge, with AQE skew
    splitting for a hot key).  Only the columns the mapping uses are read.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_linestatus")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    order_side = orders.join(checked_broadcast(cust), orders.o_custkey == cust.c_custkey,
                             "inner").select(
        "o_orderkey", "o_orderdate", "c_nationkey")
    lines = li.join(order_side, li.l_orderkey == order_side.o_orderkey, "inner")
    lines = lines.join(checked_broadcast(supp), lines.l_suppkey == supp.s_suppkey, "inner")

    fare = F.col("l_extendedprice").cast(MONEY)
    disc = F.col("l_discount").cast("decimal(4,2)")
    pay = F.round(fare * (F.lit(1).cast("decimal(1,0)") - disc), 2).cast(MONEY)
    profit = F.round(fare * disc, 2).cast(MONEY)
    hour = F.pmod(F.col("o_orderkey"), F.lit(HOURS_PER_DAY))
    seconds = F.when(F.col("l_linenumber") != 7, (300 + F.pmod(F.col("l_orderkey"), F.lit(3000))).cast("double"))
    hourly = (F.try_divide(pay.cast("double") * 3600.0, seconds)
              + F.when(F.pmod(F.col("l_orderkey"), F.lit(97)) == 0, 1.0).otherwise(0.0))
    null_d = F.lit(None).cast("double")
    return lines.select(
        _business(F.col("l_linestatus")).alias("business"),
        F.col("s_nationkey").cast("int").alias("pickup_location"),
        F.col("c_nationkey").cast("int").alias("dropoff_location"),
        F.col("l_quantity").cast("double").alias("trip_length"),
        null_d.alias("request_to_pickup"),
        null_d.alias("total_ride_time"),
        null_d.alias("on_scene_to_pickup"),
        seconds.alias("on_scene_to_dropoff"),
        time_of_day_class(hour).alias("time_of_day"),
        unix_day_seconds("o_orderdate").alias("date"),
        fare.alias("passenger_fare"),
        pay.alias("driver_total_pay"),
        profit.alias("rideshare_profit"),
        hourly.alias("hourly_rate"),
        F.try_divide(pay.cast("double"), F.col("l_quantity").cast("double")).alias("dollars_per_mile"),
    ).select(*TRIP_COLUMNS)


def summary_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip summary of :func:`trips_from_tables`, within the same plan."""
    return with_date(summarise(trips_from_tables(spark, sf_dir)))


def waits_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (date, request_to_pickup, time_of_day): one ride request per
    event, waiting ``value`` seconds, requested on the day of ``ts``."""
    ev = table(spark, sf_dir, "events").select("ts", "value")
    return ev.select(unix_day_seconds("ts").alias("date"),
                     F.col("value").cast("double").alias("request_to_pickup"),
                     time_of_day_class(F.hour("ts")).alias("time_of_day"))


def waits_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> (date, request_to_pickup): waiting times over several years,
    so that a month filter has something to leave out."""
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    return o.select(unix_day_seconds("o_orderdate").alias("date"),
                    (F.col("o_totalprice").cast("double") / 1000.0).alias("request_to_pickup"))


def supplier_customer_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(business, pickup_location, dropoff_location) from the supplier to the
    customer of each line: routes so fine that most have one business only."""
    tasks = supplier_customer_tasks(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li, o = spread(li, tasks, "l_orderkey"), spread(o, tasks, "o_orderkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        _business(F.col("l_linestatus")).alias("business"), F.col("l_suppkey").cast("int").alias("pickup_location"),
        (-1 - F.col("o_custkey")).cast("int").alias("dropoff_location"))


def supplier_customer_tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """Tasks for the lines of :func:`supplier_customer_trips`."""
    return task_count(table(spark, sf_dir, "lineitem"))


def supplier_customer_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and customers as a zone lookup; it grows with the data, so the
    measured broadcast falls back to shuffle joins."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("LocationID"), F.col("s_name").alias("Zone"))
    c = table(spark, sf_dir, "customer").select((-1 - F.col("c_custkey")).cast("int").alias("LocationID"), F.col("c_name").alias("Zone"))
    none = F.lit(None).cast("string")
    return s.unionByName(c).select("LocationID", none.alias("Borough"), "Zone", none.alias("service_zone")).select(*ZONE_COLUMNS)


def event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> hour of request (0..23) for the time-of-day rule."""
    return table(spark, sf_dir, "events").select(F.hour("ts").alias("hour"))
