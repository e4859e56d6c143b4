"""tripcast: trip-record analytics expressed as Spark DataFrame plans.

Layers:

* ``sources``   – typed ingest of the trip fact table and the zone lookup
                  (CSV with reject counting, Parquet, the test-table adapter)
                  and the sinks.
* ``functions`` – column expressions (calendar, money, labels).
* ``operators`` – reusable DataFrame operators (enrichment, aggregation,
                  top-k, side-by-side counts, quality checks, graph, PageRank).
* ``plans``     – the query catalogue built from the operators, plus the
                  DuckDB SQL twins used as an oracle.
* ``streaming`` – incremental ingest of newly landed trip files.
"""

from tripcast.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
