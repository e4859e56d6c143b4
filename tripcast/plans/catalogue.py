"""The query catalogue: every analysis of the source project as one DataFrame.

Each function takes already-loaded inputs (typed ``trips``, the ``zones``
lookup) plus its parameters and returns a lazy DataFrame.  Building a query
runs no job over the trips; the only jobs at build time are the (memoised)
row-count probes of lookups before they are broadcast, the rounds of
:func:`q20_pagerank`, which is iterative by nature, the bounds of
:func:`q16_top_routes_bounded`, and the search for heavy ids where a lookup is too large to
be broadcast.

Ordering: limited queries order by the metric and then by the key so ties
always resolve the same way; Q02-Q06, Q08, Q09, Q11 and Q12 return their rows in the
order the source reports them.  The sort is on the aggregate, never on trips.

Where a query counts, sums or averages, ``trips`` may also be a trip summary
(``tripcast.operators.summary``); the rows are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tripcast.functions import measures as ms
from tripcast.functions.calendar import iso_date, month_of, time_of_day_class
from tripcast.functions.exact import merged
from tripcast.functions.labels import route_label
from tripcast.operators import aggregate as agg
from tripcast.operators import graph as gr
from tripcast.operators.broadcast import DEFAULT_MAX_BROADCAST_ROWS
from tripcast.operators.compare import side_by_side_counts
from tripcast.operators.enrich import enrich, enrich_reported, id_ranges, unmatched_counts
from tripcast.operators.pagerank import DEFAULT_RESET, DEFAULT_TOL, pagerank
from tripcast.operators.quality import derived_metric_check
from tripcast.operators.spread import spread
from tripcast.operators.summary import KEYS
from tripcast.operators.topk import largest_groups, sample_rows, top_k, top_k_per_group
from tripcast.schema import ENRICHED_SCHEMA, ROLE_KEYS, assert_schema
from tripcast.sources.parquet import PARTITION_COLUMN

# Default parameters of the source analyses.
TOP_BOROUGHS_PER_MONTH = 5
TOP_BOROUGH_ROUTES = 30
TOP_ZONE_ROUTES = 10
TOP_PAGERANK = 5
LOW_VOLUME_BOUNDS = (0, 1000)
WAIT_THRESHOLD_SECONDS = 300.0
EVENING = "evening"
BUSINESS_COLUMNS = {"Uber": "uber_count", "Lyft": "lyft_count"}
BOROUGH_PAIR = ("Brooklyn", "Staten Island")
SAMPLE_ROWS = 10
# Columns that tell trips apart and print alike everywhere.
SAMPLE_KEY = ["business", "pickup_location", "dropoff_location", "date", "passenger_fare", "driver_total_pay"]


# --- Q01: enrichment -------------------------------------------------------

def q01_enriched(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips with pickup and dropoff zone attributes, date as yyyy-MM-dd."""
    out = enrich(trips, zones, split=True).withColumn("date", iso_date("date"))
    assert_schema(out, ENRICHED_SCHEMA)
    return out


def q01_enriched_sample(trips: DataFrame, zones: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """``n`` reproducible sample rows of the enriched table."""
    return sample_rows(q01_enriched(trips, zones), n, SAMPLE_KEY)


def q01_reported(trips: DataFrame, zones: DataFrame) -> tuple[DataFrame, Observation]:
    """:func:`q01_enriched` and the observation that holds, once the rows have been
    written, what :func:`q01_row_count` reports and the commonest unmatched ids."""
    out, seen = enrich_reported(trips, zones)
    return out.withColumn("date", iso_date("date")), seen


def q01_routes(trips: DataFrame, zones: DataFrame, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Business, zones and route of every trip, also where the lookup is too large
    to be broadcast: ids with many trips are joined map-side, the rest by a shuffle."""
    out = enrich(trips, zones, attrs=["Zone"], max_broadcast_rows=max_broadcast_rows, split=True)
    return out.select("business", "Pickup_Zone", "Dropoff_Zone", route_label("Pickup_Zone", "Dropoff_Zone").alias("Route"))


def q01_row_count(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Rows of the enriched table and the rows the inner joins drop."""
    return unmatched_counts(trips, zones)


# --- The stored summary --------------------------------------------------------

def trip_summary(summary: DataFrame) -> DataFrame:
    """A trip summary with its partial sums put together."""
    money = {c: ms.part(c, "sum") for c in ("driver_total_pay", "rideshare_profit")}
    length = merged(*[F.col(ms.part("trip_length", what)) for what in ("whole", "fraction", "odd")])
    return summary.select(PARTITION_COLUMN, *KEYS, F.col(ms.TRIPS).alias("trip_count"),
                          *[F.col(c).cast("double").alias(f"total_{name}") for name, c in money.items()],
                          length.alias("total_trip_length"))


# --- Q02-Q04: per business and month ----------------------------------------

def monthly_summary(trips: DataFrame, by_year: bool = False) -> DataFrame:
    """By business and month, in that order."""
    return agg.monthly_measures(trips, by_year=by_year).orderBy(
        F.asc_nulls_last("business"), F.asc_nulls_last("month"))


def q02_trips_per_business_month(trips: DataFrame) -> DataFrame:
    return monthly_summary(trips).select("business", "month", "business_date", "trip_count")


def q03_profit_per_business_month(trips: DataFrame) -> DataFrame:
    return monthly_summary(trips).select("business", "month", "business_date", "total_profit")


def q04_driver_pay_per_business_month(trips: DataFrame) -> DataFrame:
    return monthly_summary(trips).select("business", "month", "business_date",
                                         "total_driver_pay")


# --- Q05-Q07: top-k ---------------------------------------------------------

def _names_after_ids(pre: DataFrame, zones: DataFrame, roles: list[str], attrs: list[str],
                     keys: list[str], sums: dict[str, str],
                     cluster_by: str | None = None) -> DataFrame:
    """Second half of "aggregate below the lookup join": ``pre`` is already
    aggregated by zone ids (int keys, at most (zones)^2 rows); attach the
    names with the broadcast lookup and re-aggregate by name, because
    several ids may share one name.  ``sums`` maps output -> input column.
    ``cluster_by`` hash-partitions the (small) named rows by that key first,
    so a following window over the same key needs no further exchange."""
    named = enrich(pre, zones, roles=roles, attrs=attrs)
    if cluster_by:
        named = named.repartition(cluster_by)
    return named.groupBy(*keys).agg(*[F.sum(src).alias(out) for out, src in sums.items()])


def _top_boroughs(trips: DataFrame, zones: DataFrame, role: str, k: int) -> DataFrame:
    col = f"{role}_Borough"
    key = "pickup_location" if role == "Pickup" else "dropoff_location"
    pre = (trips.groupBy(key, month_of("date").cast("int").alias("Month"))
           .agg(ms.trips_in(trips).alias("n")))
    counts = _names_after_ids(pre, zones, [role], ["Borough"], [col, "Month"],
                              {"trip_count": "n"}, cluster_by="Month")
    best = [F.desc_nulls_last("trip_count"), F.asc_nulls_last(col)]
    return top_k_per_group(counts, ["Month"], best, k).orderBy(F.asc_nulls_last("Month"), *best)


def q05_top_pickup_boroughs(trips: DataFrame, zones: DataFrame,
                            k: int = TOP_BOROUGHS_PER_MONTH) -> DataFrame:
    return _top_boroughs(trips, zones, "Pickup", k)


def q06_top_dropoff_boroughs(trips: DataFrame, zones: DataFrame,
                             k: int = TOP_BOROUGHS_PER_MONTH) -> DataFrame:
    return _top_boroughs(trips, zones, "Dropoff", k)


_PAIR = ["pickup_location", "dropoff_location"]


def borough_routes_by_pay(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Route ('A to B' by borough) -> total driver pay, all routes.  Pay is
    summed exactly as DECIMAL per zone pair, then per route, then turned
    into a double once."""
    pre = trips.groupBy(*_PAIR).agg(ms.money_total(trips, "driver_total_pay").alias("pay"))
    named = enrich(pre, zones, attrs=["Borough"])
    return (named.select(route_label("Pickup_Borough", "Dropoff_Borough").alias("Route"), "pay")
            .groupBy("Route").agg(F.sum("pay").cast("double").alias("total_profit")))


def q07_top_routes_by_pay(trips: DataFrame, zones: DataFrame,
                          k: int = TOP_BOROUGH_ROUTES) -> DataFrame:
    return top_k(borough_routes_by_pay(trips, zones),
                 [F.desc_nulls_last("total_profit"), F.asc_nulls_last("Route")], k)


# --- Q08-Q10: averages by time of day -------------------------------------------

def time_of_day_averages(trips: DataFrame) -> DataFrame:
    return agg.averages_by(trips)


def q08_avg_pay_by_time_of_day(trips: DataFrame) -> DataFrame:
    return time_of_day_averages(trips).select("time_of_day", "average_drive_total_pay").orderBy(
        F.desc_nulls_last("average_drive_total_pay"), F.asc_nulls_last("time_of_day"))


def q09_avg_length_by_time_of_day(trips: DataFrame) -> DataFrame:
    return time_of_day_averages(trips).select("time_of_day", "average_trip_length").orderBy(
        F.desc_nulls_last("average_trip_length"), F.asc_nulls_last("time_of_day"))


def q10_earning_per_mile(trips: DataFrame) -> DataFrame:
    return time_of_day_averages(trips).select("time_of_day", "average_earning_per_mile")


def q10_avg_dollars_per_mile(trips: DataFrame) -> DataFrame:
    """Average of the per-trip rate, the other way to look at Q10."""
    return trips.groupBy("time_of_day").agg(ms.double_avg(trips, "dollars_per_mile").alias("average_dollars_per_mile"))


# --- Q11-Q12: waiting times -------------------------------------------------

def q11_daily_wait(requests: DataFrame, month: int = 1) -> DataFrame:
    """Average request_to_pickup per day of the given month, by day."""
    return agg.daily_average(requests, "request_to_pickup", month, "average_wait").orderBy(
        F.asc_nulls_last("day"))


def q12_wait_anomaly_days(requests: DataFrame, threshold: float = WAIT_THRESHOLD_SECONDS,
                          month: int = 1) -> DataFrame:
    """Days of the month whose average wait exceeds ``threshold`` seconds."""
    return agg.above_threshold(q11_daily_wait(requests, month), "average_wait", threshold)


# --- Q13-Q15: filters ---------------------------------------------------------

def pickups_by_borough_and_time(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips per (Pickup_Borough, time_of_day): counted per pickup id first,
    names attached to the counts."""
    pre = trips.groupBy("pickup_location", "time_of_day").agg(ms.trips_in(trips).alias("n"))
    return _names_after_ids(pre, zones, ["Pickup"], ["Borough"],
                            ["Pickup_Borough", "time_of_day"], {"trip_count": "n"})


def q13_low_volume_pickups(trips: DataFrame, zones: DataFrame,
                           bounds: tuple[int, int] = LOW_VOLUME_BOUNDS) -> DataFrame:
    """(Pickup_Borough, time_of_day) groups with lower < trips < upper
    (both bounds strict, as in the source)."""
    return pickups_by_borough_and_time(trips, zones).filter(
        agg.within_bounds("trip_count", bounds[0], bounds[1]))


def q13_below_average_pickups(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """(Pickup_Borough, time_of_day) groups with fewer trips than the mean
    group, a low-volume bound that follows the data's size.  The mean is a window
    over the few groups, so trips are derived and counted once."""
    counts = pickups_by_borough_and_time(trips, zones).withColumn("mean", F.avg("trip_count").over(Window.partitionBy(F.lit(0))))
    return counts.filter((F.col("trip_count") > 0) & (F.col("trip_count") < F.col("mean"))).drop("mean")


def q14_pickups_at_time_of_day(trips: DataFrame, zones: DataFrame,
                               time_of_day: str = EVENING) -> DataFrame:
    """Trips per pickup borough at one time of day (filter pushed to the scan)."""
    return pickups_by_borough_and_time(
        trips.filter(F.col("time_of_day") == time_of_day), zones)


def q15_borough_pair_trips(trips: DataFrame, zones: DataFrame,
                           pair: tuple[str, str] = BOROUGH_PAIR) -> DataFrame:
    """Trips from borough pair[0] to borough pair[1]:
    Pickup_Borough, Dropoff_Borough, Pickup_Zone (one row per trip)."""
    return _borough_pair(_with_pair_ranges(trips, zones, pair).select(*_PAIR), zones, pair).select(
        "Pickup_Borough", "Dropoff_Borough", "Pickup_Zone")


def _with_pair_ranges(trips: DataFrame, zones: DataFrame, pair: tuple[str, str]) -> DataFrame:
    """Stored trips, restricted to the id ranges of the two boroughs: the scan
    skips the row groups that hold none of them (``sources.parquet`` keeps
    a month's rows in the order of a space-filling curve)."""
    if PARTITION_COLUMN not in trips.columns:
        return trips
    for (role, key), borough in zip(ROLE_KEYS.items(), pair):
        within = id_ranges(zones, F.col("Borough") == borough, key)
        trips = trips if within is None else trips.filter(within)
    return trips


def _borough_pair(trips: DataFrame, zones: DataFrame, pair: tuple[str, str]) -> DataFrame:
    return enrich(trips, zones, attrs=["Borough", "Zone"]).filter(
        (F.col("Pickup_Borough") == pair[0]) & (F.col("Dropoff_Borough") == pair[1]))


def q15_borough_pair_sample(trips: DataFrame, zones: DataFrame,
                            pair: tuple[str, str] = BOROUGH_PAIR,
                            n: int = SAMPLE_ROWS) -> DataFrame:
    """``n`` reproducible sample trips of :func:`q15_borough_pair_trips`, told
    apart by the trip columns."""
    rows = _borough_pair(_with_pair_ranges(trips, zones, pair).select(*SAMPLE_KEY), zones, pair)
    return sample_rows(rows, n, SAMPLE_KEY).select("Pickup_Borough", "Dropoff_Borough", "Pickup_Zone")


def q15_borough_pair_count(trips: DataFrame, zones: DataFrame,
                           pair: tuple[str, str] = BOROUGH_PAIR) -> DataFrame:
    per_pair = _with_pair_ranges(trips, zones, pair).groupBy(*_PAIR).agg(ms.trips_in(trips).alias("n"))
    return _borough_pair(per_pair, zones, pair).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("trip_count"))


# --- Q16: zone routes per business ---------------------------------------------

def zone_routes_by_business(trips: DataFrame, zones: DataFrame,
                            columns: dict[str, str] | None = None, tasks: int | None = None) -> DataFrame:
    """Route ('Zone A to Zone B') -> one count per business and the total.
    Businesses missing on a route count 0.  Counted per zone-id pair first
    (int keys, one pass over the trips), then named and re-aggregated per
    route name.  Where routes are nearly as many as trips, counting before the
    shuffle only takes memory: with ``tasks`` trips, pairs and routes are dealt over
    that many tasks and counted there."""
    cols = columns or BUSINESS_COLUMNS
    pre = side_by_side_counts(spread(trips, tasks, *_PAIR), _PAIR, "business", cols)
    named = enrich(pre, zones, attrs=["Zone"], tasks=tasks)
    routed = named.select(route_label("Pickup_Zone", "Dropoff_Zone").alias("Route"),
                          *cols.values(), "total_count")
    return spread(routed, tasks, "Route").groupBy("Route").agg(*[F.sum(c).alias(c) for c in cols.values()],
                                       F.sum("total_count").alias("total_count"))


def q16_top_zone_routes(trips: DataFrame, zones: DataFrame, k: int = TOP_ZONE_ROUTES,
                        columns: dict[str, str] | None = None, tasks: int | None = None) -> DataFrame:
    return top_k(zone_routes_by_business(trips, zones, columns, tasks),
                 [F.desc_nulls_last("total_count"), F.asc_nulls_last("Route")], k)


def q16_top_routes_bounded(trips: DataFrame, zones: DataFrame, k: int = TOP_ZONE_ROUTES,
                           columns: dict[str, str] | None = None) -> DataFrame:
    """:func:`q16_top_zone_routes` where routes are nearly as many as trips: those that
    cannot be among the first ``k`` are left out before trips are grouped."""
    cols = columns or BUSINESS_COLUMNS
    named = enrich(trips.select("business", *_PAIR), zones, attrs=["Zone"], split=True)
    rows = named.select("business", route_label("Pickup_Zone", "Dropoff_Zone").alias("Route"))
    rows = largest_groups(rows, ["Route"], k, F.col("business").isin(list(cols)))
    return top_k(side_by_side_counts(rows, ["Route"], "business", cols), [F.desc_nulls_last("total_count"), F.asc_nulls_last("Route")], k)


# --- Q17-Q20: graph -------------------------------------------------------------

def q17_vertices(zones: DataFrame) -> DataFrame:
    return gr.vertices_from_zones(zones)


def q17_edges(trips: DataFrame) -> DataFrame:
    return gr.trip_edges(trips)


def q17_vertices_sample(zones: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    return sample_rows(q17_vertices(zones), n)


def q17_edges_sample(trips: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """``n`` distinct edges."""
    return sample_rows(q17_edge_weights(trips).select("src", "dst"), n)


def q17_edge_weights(trips: DataFrame) -> DataFrame:
    return gr.trip_edge_weights(trips)


def q17_dangling_edges(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Weighted edges and trips whose src or dst is not a vertex (dropped by
    the triplet, motif and PageRank joins)."""
    return gr.dangling_edge_count(gr.build_graph(zones, trips))


def q18_triplets(trips: DataFrame, zones: DataFrame, flat: bool = True) -> DataFrame:
    g = gr.build_graph(zones, trips)
    return gr.triplets_flat(g) if flat else gr.triplets(g)


def q18_triplets_nested(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Every field of the nested triplets, read out of their structs."""
    names = {"src": ["id", "Borough", "Zone", "service_zone"], "edge": ["src", "dst", "weight"],
             "dst": ["id", "Borough", "Zone", "service_zone"]}
    return q18_triplets(trips, zones, flat=False).select(
        *[F.col(f"{s}.{f}").alias(f"{s}_{f}") for s, fields in names.items() for f in fields])


def q18_triplets_sample(trips: DataFrame, zones: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    return sample_rows(q18_triplets(trips, zones), n, ["src_id", "dst_id"])


def q19_pairs_sample(trips: DataFrame, zones: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    return sample_rows(q19_same_borough_service_zone_pairs(trips, zones), n, ["src_id", "dst_id"])


def q19_same_borough_service_zone_pairs(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return gr.same_attribute_pairs(gr.build_graph(zones, trips))


def q19_pair_count(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return gr.pair_summary(q19_same_borough_service_zone_pairs(trips, zones))


def q20_pagerank(trips: DataFrame, zones: DataFrame, reset: float = DEFAULT_RESET,
                 tol: float = DEFAULT_TOL, digits: int | None = 6) -> DataFrame:
    g = gr.build_graph(zones, trips)
    pr = pagerank(g.vertices, g.edges, reset=reset, tol=tol)
    return pr if digits is None else pr.withColumn("pagerank", F.round("pagerank", digits))


def q20_pagerank_top(trips: DataFrame, zones: DataFrame, k: int = TOP_PAGERANK,
                     reset: float = DEFAULT_RESET, tol: float = DEFAULT_TOL,
                     digits: int | None = 6) -> DataFrame:
    """The ``k`` highest ranks: ordered by the full value, rounded last."""
    best = top_k(q20_pagerank(trips, zones, reset, tol, digits=None),
                 [F.desc_nulls_last("pagerank"), F.asc_nulls_last("id")], k)
    return best if digits is None else best.withColumn("pagerank", F.round("pagerank", digits))


# --- Q21-Q22: documented rules ------------------------------------------------------

def q21_time_of_day_rule(hours: DataFrame) -> DataFrame:
    """Requests per hour with the time-of-day class the rule assigns."""
    return (hours.groupBy("hour").agg(F.count(F.lit(1)).alias("requests"))
            .select(F.col("hour").cast("int").alias("hour"),
                    time_of_day_class("hour").alias("time_of_day"), "requests"))


def q22_derived_metric_check(trips: DataFrame) -> DataFrame:
    return derived_metric_check(trips)
