"""Role-playing zone dimension: one lookup joined once per trip role.

The zone lookup is joined on ``pickup_location`` and then on
``dropoff_location``.  Each join gets its own copy of the lookup whose
columns are already renamed for the role (``Pickup_Borough`` ...) and whose
key carries the trip column's name, so the two joins can never bind the
wrong ``LocationID`` and the join is a plain equi-join on one name.

The lookup is tiny (a few hundred ids) and is broadcast after a size check,
so enrichment is a map-side hash join fused into the scan's codegen stage: no
shuffle of the fact table, and a hot zone holding a third of all trips costs
nothing extra.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripcast.functions.measures import trips_in
from tripcast.operators.broadcast import DEFAULT_MAX_BROADCAST_ROWS, checked_broadcast, fits_broadcast
from tripcast.operators.split_join import heavy_keys, split_join
from tripcast.operators.spread import spread
from tripcast.schema import ROLE_KEYS, ZONE_ATTRS


def zone_role(zones: DataFrame, role: str, attrs: Iterable[str] = ZONE_ATTRS) -> DataFrame:
    """Lookup copy for one role: key renamed to the trip column, attributes
    prefixed with the role."""
    key = ROLE_KEYS[role]
    return zones.select(F.col("LocationID").cast("int").alias(key),
                        *[F.col(a).alias(f"{role}_{a}") for a in attrs])


def lookup_side(zones: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """The lookup as it should enter a join: broadcast when proven small."""
    return checked_broadcast(zones, max_rows)


def enrich(trips: DataFrame, zones: DataFrame,
           roles: Iterable[str] = ("Pickup", "Dropoff"),
           attrs: Iterable[str] = ZONE_ATTRS,
           how: str = "inner",
           max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, split: bool = False,
           tasks: int | None = None) -> DataFrame:
    """Add ``<Role>_<attr>`` columns for every role, keeping the trip columns
    first and in their original order.

    ``how='inner'`` drops trips whose key is NULL or unknown (the source
    semantics); use :func:`unmatched_counts` to report how many.  A lookup
    above ``max_broadcast_rows`` is joined by a shuffle (sort-merge) instead,
    with ``split`` after its heavy ids were taken out (``operators.split_join``),
    with ``tasks`` over that many tasks.
    """
    roles = list(roles)
    attrs = list(attrs)
    side = lookup_side(zones, max_broadcast_rows)
    out = trips
    small = fits_broadcast(zones, max_broadcast_rows) if split or tasks else True
    split = split and not small
    for role in roles:
        if split:
            out = split_join(out, zone_role(zones, role, attrs), ROLE_KEYS[role], how, heavy_keys(trips, ROLE_KEYS[role]))
        else:
            key, n = ROLE_KEYS[role], None if small else tasks
            out = spread(out, n, key).join(spread(zone_role(side, role, attrs), n, key), on=key, how=how)
    trip_cols = [c for c in trips.columns]
    added = [f"{r}_{a}" for r in roles for a in attrs]
    return out.select(*trip_cols, *added)


def enrich_reported(trips: DataFrame, zones: DataFrame, attrs: Iterable[str] = ZONE_ATTRS,
                    commonest: int = 10) -> tuple[DataFrame, Observation]:
    """:func:`enrich`, and an observation for :func:`unmatched_report`, filled by the
    action that uses the rows: what is not matched is counted on the way, the
    commonest ids by a frequent-items sketch."""
    hits = {role: f"_{role}_hit" for role in ROLE_KEYS}
    out = trips
    for role, key in ROLE_KEYS.items():
        side = zone_role(lookup_side(zones), role, attrs).withColumn(hits[role], F.lit(True))
        out = out.join(side, key, "left")
    missing = {role: F.col(hit).isNull() for role, hit in hits.items()}
    seen = Observation()
    ids = [F.expr(f"approx_top_k(CASE WHEN {hits[role]} IS NULL THEN {key} END, {commonest + 1})")
           .alias(f"{role.lower()}_unmatched_ids") for role, key in ROLE_KEYS.items()]
    out = out.observe(seen, F.count(F.lit(1)).alias("trips"), F.count_if(missing["Pickup"]).alias("pickup_unmatched"),
                      F.count_if(missing["Dropoff"]).alias("dropoff_unmatched"),
                      F.count_if(~missing["Pickup"] & ~missing["Dropoff"]).alias("enriched_rows"), *ids)
    added = [f"{r}_{a}" for r in ROLE_KEYS for a in attrs]
    return out.filter(~missing["Pickup"] & ~missing["Dropoff"]).select(*trips.columns, *added), seen


def unmatched_report(seen: Observation) -> dict:
    """trips, pickup_unmatched, dropoff_unmatched and enriched_rows, as
    :func:`unmatched_counts` counts them, and pickup_unmatched_ids and
    dropoff_unmatched_ids, the commonest (id, trips) that have no zone."""
    got = dict(seen.get)
    for role in ROLE_KEYS:
        name = f"{role.lower()}_unmatched_ids"
        got[name] = [(r["item"], r["count"]) for r in got[name] or () if r["item"] is not None]  # no item: matched, or no id
    return got


def id_ranges(zones: DataFrame, condition: Column, key: str, most: int = 64) -> Column | None:
    """Condition that the trip column ``key`` lies in one of at most ``most`` ranges
    that cover the ids of the zones with ``condition``, for the scan to skip by.
    It lets ids between them through, so a join still has to follow.  None for
    a lookup that is not proven small."""
    if not fits_broadcast(zones):
        return None
    ids = sorted(r[0] for r in zones.filter(condition).select(F.col("LocationID").cast("int")).dropna().distinct().collect())
    if not ids:
        return F.lit(False)
    # Cut at the widest gaps between neighbours.
    gaps = sorted((a - b, i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if b - a > 1)[:most - 1]
    cuts = sorted(i for _, i in gaps)
    out = None
    for lo, hi in zip([0, *(i + 1 for i in cuts)], [*cuts, len(ids) - 1]):
        c = F.col(key)
        one = c == ids[lo] if lo == hi else (c >= ids[lo]) & (c <= ids[hi])
        out = one if out is None else out | one
    return out


def unmatched_counts(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """One row: trips, and trips whose pickup / dropoff key finds no zone
    (NULL keys included).  These are the rows an inner enrichment drops.

    Trips are first counted per (pickup, dropoff) key pair (int keys, partial
    aggregation), so the lookups are joined to at most (zones+1)^2 rows."""
    side = lookup_side(zones.select("LocationID"))
    keyed = (trips.groupBy("pickup_location", "dropoff_location")
             .agg(trips_in(trips).alias("_n")))
    for role, key in ROLE_KEYS.items():
        ids = side.select(F.col("LocationID").cast("int").alias(key),
                          F.lit(True).alias(f"_{role}_hit"))
        keyed = keyed.join(ids, on=key, how="left")
    n = F.col("_n")
    pick_miss = F.col("_Pickup_hit").isNull()
    drop_miss = F.col("_Dropoff_hit").isNull()
    zero = F.lit(0).cast("long")
    return keyed.agg(
        F.coalesce(F.sum(n), zero).alias("trips"),
        F.coalesce(F.sum(F.when(pick_miss, n)), zero).alias("pickup_unmatched"),
        F.coalesce(F.sum(F.when(drop_miss, n)), zero).alias("dropoff_unmatched"),
        F.coalesce(F.sum(F.when(~pick_miss & ~drop_miss, n)), zero).alias("enriched_rows"),
    )
