"""DuckDB SQL twins of the registered queries (the correctness oracle).

The CTEs ``zones``, ``trips``, ``enriched`` and ``waits`` restate the test
table mapping of ``tripcast.sources.testdata`` in SQL; each query body then
restates its catalogue query.  Money is summed as DECIMAL and converted to
DOUBLE once, doubles are summed as wide integers and rounded once, exactly like
the Spark side.
"""

from __future__ import annotations

from tripcast.plans.registry import TEST_BOROUGH_PAIR, TEST_LOW_VOLUME_BOUNDS, TEST_WAIT_THRESHOLD

_TOD = """CASE WHEN {h} BETWEEN 6 AND 11 THEN 'morning'
              WHEN {h} BETWEEN 12 AND 16 THEN 'afternoon'
              WHEN {h} BETWEEN 17 AND 19 THEN 'evening'
              WHEN {h} IS NOT NULL THEN 'night' END"""


def _day(col: str) -> str:
    return f"(DATE '1970-01-01' + CAST(floor({col} / 86400) AS INTEGER))"


def _month(col: str = "date") -> str:
    return f"CAST(month({_day(col)}) AS INTEGER)"


def _dayofmonth(col: str = "date") -> str:
    return f"CAST(day({_day(col)}) AS INTEGER)"


def _unix_day(ts: str) -> str:
    return f"CAST(date_diff('day', DATE '1970-01-01', CAST({ts} AS DATE)) AS BIGINT) * 86400"


def _exact_sum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(20,2))) AS DOUBLE)"


def _exact_avg(x: str) -> str:
    return (f"(CAST(sum(CAST({x} AS DECIMAL(20,2))) AS DOUBLE) / "
            f"NULLIF(CAST(count({x}) AS DOUBLE), 0))")


def _exact_double_sum(x: str) -> str:
    """Sum of doubles as an integer in units of 2^-62, read as a DOUBLE through its text."""
    unit = 1 << 62
    return (f"(CAST(CAST(sum(CAST(floor({x}) AS HUGEINT)) * {unit} + "
            f"sum(CAST(floor(({x} - floor({x})) * {unit}::DOUBLE) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / {unit}::DOUBLE)")


def _exact_double_avg(x: str) -> str:
    return f"({_exact_double_sum(x)} / CAST(count({x}) AS DOUBLE))"


_SECONDS = "(CASE WHEN l.l_linenumber <> 7 THEN CAST(300 + l.l_orderkey % 3000 AS DOUBLE) END)"
_FARE = "CAST(l.l_extendedprice AS DECIMAL(12,2))"
_DISC = "CAST(l.l_discount AS DECIMAL(4,2))"
_PAY = f"CAST(round({_FARE} * (1 - {_DISC}), 2) AS DECIMAL(12,2))"
_PROFIT = f"CAST(round({_FARE} * {_DISC}, 2) AS DECIMAL(12,2))"

CTES = f"""
zones AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS LocationID, r.r_name AS Borough, n.n_name AS Zone,
         CASE n.n_nationkey % 3 WHEN 0 THEN 'Boro Zone' WHEN 1 THEN 'Yellow Zone' ELSE 'EWR' END
           AS service_zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
trips AS (
  SELECT CASE l.l_linestatus WHEN 'F' THEN 'Uber' WHEN 'O' THEN 'Lyft' ELSE l.l_linestatus END
           AS business,
         CAST(s.s_nationkey AS INTEGER) AS pickup_location,
         CAST(c.c_nationkey AS INTEGER) AS dropoff_location,
         CAST(l.l_quantity AS DOUBLE) AS trip_length,
         CAST(NULL AS DOUBLE) AS request_to_pickup,
         CAST(NULL AS DOUBLE) AS total_ride_time,
         CAST(NULL AS DOUBLE) AS on_scene_to_pickup,
         {_SECONDS} AS on_scene_to_dropoff,
         {_TOD.format(h='(o.o_orderkey % 24)')} AS time_of_day,
         {_unix_day('o.o_orderdate')} AS date,
         {_FARE} AS passenger_fare,
         {_PAY} AS driver_total_pay,
         {_PROFIT} AS rideshare_profit,
         CAST({_PAY} AS DOUBLE) * 3600.0::DOUBLE / {_SECONDS}
           + CASE WHEN l.l_orderkey % 97 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hourly_rate,
         CAST({_PAY} AS DOUBLE) / CAST(l.l_quantity AS DOUBLE) AS dollars_per_mile
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
enriched AS (
  SELECT t.*,
         pz.Borough AS Pickup_Borough, pz.Zone AS Pickup_Zone, pz.service_zone AS Pickup_service_zone,
         dz.Borough AS Dropoff_Borough, dz.Zone AS Dropoff_Zone, dz.service_zone AS Dropoff_service_zone
  FROM trips t
  JOIN zones pz ON t.pickup_location = pz.LocationID
  JOIN zones dz ON t.dropoff_location = dz.LocationID
),
waits AS (
  SELECT {_unix_day('ts')} AS date, CAST(value AS DOUBLE) AS request_to_pickup
  FROM events
),
monthly AS (
  SELECT business, {_month()} AS month, count(*) AS trip_count,
         {_exact_sum('rideshare_profit')} AS total_profit,
         {_exact_sum('driver_total_pay')} AS total_driver_pay
  FROM trips GROUP BY 1, 2
),
tod AS (
  SELECT time_of_day,
         {_exact_avg('driver_total_pay')} AS average_drive_total_pay,
         {_exact_double_avg('trip_length')} AS average_trip_length
  FROM trips GROUP BY 1
),
daily AS (
  SELECT {_dayofmonth()} AS day, {_exact_double_avg('request_to_pickup')} AS average_wait,
         count(request_to_pickup) AS trip_count
  FROM waits WHERE {_month()} = 1 GROUP BY 1
),
order_waits AS (
  SELECT {_unix_day('o_orderdate')} AS date, CAST(o_totalprice AS DOUBLE) / 1000.0::DOUBLE AS request_to_pickup
  FROM orders
),
borough_times AS (
  SELECT Pickup_Borough, time_of_day, count(*) AS trip_count FROM enriched GROUP BY 1, 2
),
fine_routes AS (
  SELECT concat_ws(' to ', coalesce(s.s_name, 'Unknown'), coalesce(c.c_name, 'Unknown')) AS Route,
         count(*) FILTER (WHERE l.l_linestatus = 'F') AS uber_count,
         count(*) FILTER (WHERE l.l_linestatus = 'O') AS lyft_count
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1
),
edge_weights AS (
  SELECT pickup_location AS src, dropoff_location AS dst, count(*) AS weight
  FROM trips GROUP BY 1, 2
),
triplets AS (
  SELECT a.LocationID AS src_id, a.Borough AS src_Borough, a.Zone AS src_Zone,
         a.service_zone AS src_service_zone, e.weight,
         b.LocationID AS dst_id, b.Borough AS dst_Borough, b.Zone AS dst_Zone,
         b.service_zone AS dst_service_zone
  FROM edge_weights e JOIN zones a ON e.src = a.LocationID JOIN zones b ON e.dst = b.LocationID
),
pairs AS (
  SELECT src_id, dst_id, dst_Borough AS Borough, dst_service_zone AS service_zone,
         weight AS trip_count
  FROM triplets WHERE src_Borough = dst_Borough AND src_service_zone = dst_service_zone
),
zone_routes AS (
  SELECT concat_ws(' to ', coalesce(Pickup_Zone, 'Unknown'), coalesce(Dropoff_Zone, 'Unknown'))
           AS Route,
         count(*) FILTER (WHERE business = 'Uber') AS uber_count,
         count(*) FILTER (WHERE business = 'Lyft') AS lyft_count
  FROM enriched GROUP BY 1
)"""

_PAGERANK = """
pr_v AS (SELECT DISTINCT CAST(LocationID AS BIGINT) AS id FROM zones),
pr_e AS (
  SELECT e.src, e.dst, CAST(e.weight AS DOUBLE) AS w FROM edge_weights e
  WHERE e.src IN (SELECT id FROM pr_v) AND e.dst IN (SELECT id FROM pr_v)
),
pr_share AS (
  SELECT e.src, e.dst, e.w / d.outdeg AS p
  FROM pr_e e JOIN (SELECT src, sum(w) AS outdeg FROM pr_e GROUP BY src) d ON e.src = d.src
),
pr(it, id, rank, delta, active) AS (
  SELECT 0, id, (1.0 - 0.17) * (0.17 / (1.0 - 0.17)), (1.0 - 0.17) * (0.17 / (1.0 - 0.17)), true
  FROM pr_v
  UNION ALL
  SELECT s.it + 1, s.id,
         CASE WHEN m.msg IS NULL THEN s.rank ELSE s.rank + (1.0 - 0.17) * m.msg END,
         CASE WHEN m.msg IS NULL THEN s.delta
              ELSE (s.rank + (1.0 - 0.17) * m.msg) - s.rank END,
         m.msg IS NOT NULL
  FROM pr s
  LEFT JOIN (
    SELECT x.dst, sum(q.delta * x.p) AS msg
    FROM pr q JOIN pr_share x ON x.src = q.id
    WHERE q.active AND q.delta > 0.01
    GROUP BY x.dst
  ) m ON m.dst = s.id
  WHERE EXISTS (SELECT 1 FROM pr q JOIN pr_share x ON x.src = q.id
                WHERE q.active AND q.delta > 0.01)
),
pr_final AS (
  SELECT id, rank FROM pr WHERE it = (SELECT max(it) FROM pr)
),
pagerank AS (
  SELECT CAST(id AS INTEGER) AS id,
         rank * ((SELECT CAST(count(*) AS DOUBLE) FROM pr_final)
                 / (SELECT sum(rank) FROM pr_final)) AS pagerank
  FROM pr_final
)"""


def _q(body: str, recursive: bool = False) -> str:
    if recursive:
        return f"WITH RECURSIVE {CTES},{_PAGERANK}\n{body}"
    return f"WITH {CTES}\n{body}"


def _money_cols(prefix: str = "") -> str:
    return ", ".join(
        f"CAST({prefix}{c} AS DOUBLE) AS {c}"
        for c in ("passenger_fare", "driver_total_pay", "rideshare_profit"))


def _top_boroughs(role: str, key: str, k: int = 5) -> str:
    return f"""
SELECT {role}_Borough, Month, trip_count FROM (
  SELECT {role}_Borough, Month, trip_count,
         row_number() OVER (PARTITION BY Month
                            ORDER BY trip_count DESC NULLS LAST, {role}_Borough ASC NULLS LAST) AS rn
  FROM (SELECT z.Borough AS {role}_Borough, {_month('t.date')} AS Month, count(*) AS trip_count
        FROM trips t JOIN zones z ON t.{key} = z.LocationID GROUP BY 1, 2)
) WHERE rn <= {k}"""


_SAMPLE_KEY = ("business", "pickup_location", "dropoff_location", "date", "passenger_fare", "driver_total_pay")


def _sample_order(*columns: str) -> str:
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"ORDER BY md5(concat_ws('|', {texts})) LIMIT 10"


def _routes(limit: int) -> str:
    return f"""
SELECT concat_ws(' to ', coalesce(Pickup_Borough, 'Unknown'), coalesce(Dropoff_Borough, 'Unknown'))
         AS Route,
       {_exact_sum('driver_total_pay')} AS total_profit
FROM enriched GROUP BY 1
ORDER BY total_profit DESC NULLS LAST, Route ASC NULLS LAST LIMIT {limit}"""


_ISO_DATE = f"strftime({_day('date')}, '%Y-%m-%d')"
_LO, _HI = TEST_LOW_VOLUME_BOUNDS
_B1, _B2 = TEST_BOROUGH_PAIR

ORACLE_SQL: dict[str, str] = {
    "q01_enriched": _q(f"""
SELECT business, pickup_location, dropoff_location, trip_length, request_to_pickup,
       total_ride_time, on_scene_to_pickup, on_scene_to_dropoff, time_of_day,
       strftime({_day('date')}, '%Y-%m-%d') AS date,
       {_money_cols()}, hourly_rate, dollars_per_mile,
       Pickup_Borough, Pickup_Zone, Pickup_service_zone,
       Dropoff_Borough, Dropoff_Zone, Dropoff_service_zone
FROM enriched"""),
    "q01_enriched_sample": _q(f"""
SELECT business, pickup_location, dropoff_location, trip_length, request_to_pickup,
       total_ride_time, on_scene_to_pickup, on_scene_to_dropoff, time_of_day,
       strftime({_day('date')}, '%Y-%m-%d') AS date,
       {_money_cols()}, hourly_rate, dollars_per_mile,
       Pickup_Borough, Pickup_Zone, Pickup_service_zone,
       Dropoff_Borough, Dropoff_Zone, Dropoff_service_zone
FROM (SELECT * FROM enriched
      {_sample_order(*(_ISO_DATE if c == "date" else c for c in _SAMPLE_KEY))})"""),
    "q01_row_count": _q("""
SELECT count(*) AS trips,
       count(*) FILTER (WHERE pz.LocationID IS NULL) AS pickup_unmatched,
       count(*) FILTER (WHERE dz.LocationID IS NULL) AS dropoff_unmatched,
       count(*) FILTER (WHERE pz.LocationID IS NOT NULL AND dz.LocationID IS NOT NULL)
         AS enriched_rows
FROM trips t
LEFT JOIN zones pz ON t.pickup_location = pz.LocationID
LEFT JOIN zones dz ON t.dropoff_location = dz.LocationID"""),
    "q02_trips_per_business_month": _q("""
SELECT business, month, concat_ws('-', business, CAST(month AS VARCHAR)) AS business_date,
       trip_count FROM monthly"""),
    "q03_profit_per_business_month": _q("""
SELECT business, month, concat_ws('-', business, CAST(month AS VARCHAR)) AS business_date,
       total_profit FROM monthly"""),
    "q04_driver_pay_per_business_month": _q("""
SELECT business, month, concat_ws('-', business, CAST(month AS VARCHAR)) AS business_date,
       total_driver_pay FROM monthly"""),
    "q02_04_monthly_summary": _q("""
SELECT business, month, concat_ws('-', business, CAST(month AS VARCHAR)) AS business_date,
       trip_count, total_profit, total_driver_pay FROM monthly"""),
    "q02_04_monthly_summary_by_year": _q(f"""
SELECT business, month, concat_ws('-', business, CAST(month AS VARCHAR)) AS business_date,
       trip_count, total_profit, total_driver_pay
FROM (SELECT business,
             CAST(year({_day('date')}) * 100 + month({_day('date')}) AS INTEGER) AS month,
             count(*) AS trip_count,
             {_exact_sum('rideshare_profit')} AS total_profit,
             {_exact_sum('driver_total_pay')} AS total_driver_pay
      FROM trips GROUP BY 1, 2)"""),
    "q05_top_pickup_boroughs": _q(_top_boroughs("Pickup", "pickup_location")),
    "q06_top_dropoff_boroughs": _q(_top_boroughs("Dropoff", "dropoff_location")),
    "q05_top3_pickup_boroughs": _q(_top_boroughs("Pickup", "pickup_location", 3)),
    "q06_top3_dropoff_boroughs": _q(_top_boroughs("Dropoff", "dropoff_location", 3)),
    "q07_top_routes_by_pay": _q(_routes(30)),
    "q07_top10_routes_by_pay": _q(_routes(10)),
    "q08_avg_pay_by_time_of_day": _q("SELECT time_of_day, average_drive_total_pay FROM tod"),
    "q09_avg_length_by_time_of_day": _q("SELECT time_of_day, average_trip_length FROM tod"),
    "q10_earning_per_mile": _q("""
SELECT time_of_day, average_drive_total_pay / NULLIF(average_trip_length, 0) AS average_earning_per_mile FROM tod"""),
    "q10_avg_dollars_per_mile": _q(f"""
SELECT time_of_day, {_exact_double_avg('dollars_per_mile')} AS average_dollars_per_mile FROM trips GROUP BY 1"""),
    "q11_january_daily_wait": _q("SELECT day, average_wait, trip_count FROM daily"),
    "q11_january_daily_wait_orders": _q(f"""
SELECT {_dayofmonth()} AS day, {_exact_double_avg('request_to_pickup')} AS average_wait,
       count(request_to_pickup) AS trip_count
FROM order_waits WHERE {_month()} = 1 GROUP BY 1"""),
    "q12_wait_anomaly_days": _q(f"""
SELECT day, average_wait, trip_count FROM daily
WHERE average_wait > {TEST_WAIT_THRESHOLD}"""),
    "q13_below_average_pickups": _q("""
SELECT Pickup_Borough, time_of_day, trip_count FROM borough_times
WHERE trip_count < (SELECT avg(trip_count) FROM borough_times)"""),
    "q13_low_volume_pickups": _q("""
SELECT Pickup_Borough, time_of_day, count(*) AS trip_count
FROM enriched GROUP BY 1, 2 HAVING count(*) > 0 AND count(*) < 1000"""),
    "q13_low_volume_pickups_2000": _q(f"""
SELECT Pickup_Borough, time_of_day, count(*) AS trip_count
FROM enriched GROUP BY 1, 2 HAVING count(*) > {_LO} AND count(*) < {_HI}"""),
    "q14_evening_pickups": _q("""
SELECT z.Borough AS Pickup_Borough, t.time_of_day, count(*) AS trip_count
FROM trips t JOIN zones z ON t.pickup_location = z.LocationID
WHERE t.time_of_day = 'evening' GROUP BY 1, 2"""),
    "q15_borough_pair_trips": _q(f"""
SELECT Pickup_Borough, Dropoff_Borough, Pickup_Zone FROM enriched
WHERE Pickup_Borough = '{_B1}' AND Dropoff_Borough = '{_B2}'"""),
    "q15_borough_pair_sample": _q(f"""
SELECT Pickup_Borough, Dropoff_Borough, Pickup_Zone FROM enriched
WHERE Pickup_Borough = '{_B1}' AND Dropoff_Borough = '{_B2}'
{_sample_order(*_SAMPLE_KEY)}"""),
    "q15_borough_pair_count": _q(f"""
SELECT count(*) AS trip_count FROM enriched
WHERE Pickup_Borough = '{_B1}' AND Dropoff_Borough = '{_B2}'"""),
    "q16_top_zone_routes": _q("""
SELECT Route, uber_count, lyft_count, uber_count + lyft_count AS total_count
FROM zone_routes WHERE uber_count + lyft_count > 0
ORDER BY total_count DESC NULLS LAST, Route ASC NULLS LAST LIMIT 10"""),
    "q16_zone_routes": _q("""
SELECT Route, uber_count, lyft_count, uber_count + lyft_count AS total_count
FROM zone_routes WHERE uber_count + lyft_count > 0"""),
    "q16_supplier_customer_routes": _q("""
SELECT Route, uber_count, lyft_count, uber_count + lyft_count AS total_count
FROM fine_routes WHERE uber_count + lyft_count > 0"""),
    "q16_top_supplier_customer_routes": _q("""
SELECT Route, uber_count, lyft_count, uber_count + lyft_count AS total_count
FROM fine_routes WHERE uber_count + lyft_count > 0
ORDER BY total_count DESC NULLS LAST, Route ASC NULLS LAST LIMIT 10"""),
    "q17_vertices_sample": _q(f"""
SELECT LocationID AS id, Borough, Zone, service_zone FROM zones
{_sample_order('LocationID', 'Borough', 'Zone', 'service_zone')}"""),
    "q17_edges_sample": _q(f"SELECT src, dst FROM edge_weights {_sample_order('src', 'dst')}"),
    "q18_triplets_nested": _q("""
SELECT src_id, src_Borough, src_Zone, src_service_zone, src_id AS edge_src, dst_id AS edge_dst,
       weight AS edge_weight, dst_id, dst_Borough, dst_Zone, dst_service_zone FROM triplets"""),
    "q18_triplets_sample": _q(f"SELECT * FROM triplets {_sample_order('src_id', 'dst_id')}"),
    "q19_pairs_sample": _q(f"SELECT * FROM pairs {_sample_order('src_id', 'dst_id')}"),
    "q17_vertices": _q("""
SELECT LocationID AS id, Borough, Zone, service_zone FROM zones"""),
    "q17_edges": _q("SELECT pickup_location AS src, dropoff_location AS dst FROM trips"),
    "q17_edge_weights": _q("SELECT src, dst, weight FROM edge_weights"),
    "q17_dangling_edges": _q("""
SELECT count(*) FILTER (WHERE a.LocationID IS NULL OR b.LocationID IS NULL) AS dangling_edges,
       CAST(coalesce(sum(CASE WHEN a.LocationID IS NULL OR b.LocationID IS NULL
                              THEN e.weight END), 0) AS BIGINT) AS dangling_trips
FROM edge_weights e
LEFT JOIN zones a ON e.src = a.LocationID
LEFT JOIN zones b ON e.dst = b.LocationID"""),
    "q18_triplets": _q("SELECT * FROM triplets"),
    "q19_same_borough_service_zone_pairs": _q("SELECT * FROM pairs"),
    "q19_pair_count": _q("""
SELECT count(*) AS pair_count, CAST(coalesce(sum(trip_count), 0) AS BIGINT) AS trip_count
FROM pairs"""),
    "q20_pagerank": _q("SELECT id, round(pagerank, 6) AS pagerank FROM pagerank", recursive=True),
    "q20_pagerank_top5": _q("""
SELECT id, round(pagerank, 6) AS pagerank FROM (
  SELECT id, pagerank FROM pagerank ORDER BY pagerank DESC NULLS LAST, id ASC NULLS LAST LIMIT 5)""",
                            recursive=True),
    "q21_time_of_day_rule": _q(f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour, {_TOD.format(h='CAST(hour(ts) AS INTEGER)')}
         AS time_of_day, count(*) AS requests
FROM events GROUP BY 1, 2"""),
    "q22_derived_metric_check": _q("""
SELECT count(*) AS trips,
       count(passenger_fare - driver_total_pay = rideshare_profit) AS profit_checked,
       count(*) FILTER (WHERE NOT (passenger_fare - driver_total_pay = rideshare_profit))
         AS profit_mismatch,
       count(abs(dollars_per_mile - CAST(driver_total_pay AS DOUBLE) / NULLIF(trip_length, 0))
             <= 0.005000001) AS per_mile_checked,
       count(*) FILTER (WHERE NOT (abs(dollars_per_mile - CAST(driver_total_pay AS DOUBLE)
                                       / NULLIF(trip_length, 0)) <= 0.005000001)) AS per_mile_mismatch,
       count(abs(hourly_rate - CAST(driver_total_pay AS DOUBLE)
                 / NULLIF(on_scene_to_dropoff / 3600.0, 0)) <= 0.005000001) AS hourly_checked,
       count(*) FILTER (WHERE NOT (abs(hourly_rate - CAST(driver_total_pay AS DOUBLE)
                                       / NULLIF(on_scene_to_dropoff / 3600.0, 0)) <= 0.005000001))
         AS hourly_mismatch
FROM trips"""),
}

ORACLE_SQL["q01_supplier_customer_trips"] = """
SELECT CASE l.l_linestatus WHEN 'F' THEN 'Uber' WHEN 'O' THEN 'Lyft' ELSE l.l_linestatus END AS business,
       s.s_name AS Pickup_Zone, c.c_name AS Dropoff_Zone,
       concat_ws(' to ', coalesce(s.s_name, 'Unknown'), coalesce(c.c_name, 'Unknown')) AS Route
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN customer c ON o.o_custkey = c.c_custkey"""
ORACLE_SQL["trip_summary"] = _q(f"""
SELECT CAST(year({_day('date')}) * 100 + month({_day('date')}) AS INTEGER) AS year_month, business, pickup_location,
       dropoff_location, time_of_day, count(*) AS trip_count,
       {_exact_sum('driver_total_pay')} AS total_driver_total_pay, {_exact_sum('rideshare_profit')} AS total_rideshare_profit,
       {_exact_double_sum('trip_length')} AS total_trip_length
FROM trips GROUP BY 1, 2, 3, 4, 5""")
ORACLE_SQL["q16_top_supplier_customer_routes_bounded"] = ORACLE_SQL["q16_top_supplier_customer_routes"]
# The summary changes how a query is answered, not its rows.
for _name in ("q01_row_count", "q02_04_monthly_summary", "q05_top3_pickup_boroughs", "q07_top10_routes_by_pay",
              "q08_avg_pay_by_time_of_day", "q10_earning_per_mile", "q10_avg_dollars_per_mile", "q13_below_average_pickups",
              "q15_borough_pair_count", "q16_zone_routes", "q18_triplets"):
    ORACLE_SQL[f"{_name}_by_summary"] = ORACLE_SQL[_name]
