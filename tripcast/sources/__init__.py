"""Sources (CSV / Parquet / test-table adapter) and sinks."""

from tripcast.sources.csv import read_trips_csv, read_zones_csv, reject_counts
from tripcast.sources.parquet import read_trips_parquet, write_trips_parquet
from tripcast.sources.sinks import (write_chart_csv, write_csv, write_parquet,
                                    write_per_business_csv)
from tripcast.sources.testdata import (trips_from_tables, waits_from_events,
                                       zones_from_tables)

__all__ = [
    "read_trips_csv", "read_zones_csv", "reject_counts", "read_trips_parquet",
    "write_trips_parquet", "write_chart_csv", "write_csv", "write_parquet",
    "write_per_business_csv", "trips_from_tables",
    "waits_from_events", "zones_from_tables",
]
