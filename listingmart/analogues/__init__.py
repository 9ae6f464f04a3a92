"""Registered queries: every operator of the inventory run on the supplied tables.

The supplied tables hold no job listings, so each operator runs on an
analogue (SURVEY §7.5) over whole tables: part names stand in for labels,
orders for listings, events for cumulative counters, documents for texts.
Each key has a Spark implementation that calls the library operator and an
equivalent DuckDB query (``ORACLE``). One module per SURVEY §2 section; they
register into ``QUERIES`` / ``ORACLE`` on import, in this order.
"""

from listingmart.analogues import functions as _functions  # noqa: F401  (2.10, F22)
from listingmart.analogues import predicates as _predicates  # noqa: F401  (2.3)
from listingmart.analogues import joins as _joins  # noqa: F401  (2.4)
from listingmart.analogues import aggregates as _aggregates  # noqa: F401  (2.5)
from listingmart.analogues import windows as _windows  # noqa: F401  (2.6)
from listingmart.analogues import ordering as _ordering  # noqa: F401  (2.7, 2.8)
from listingmart.analogues import merge_keys as _merge_keys  # noqa: F401  (2.9)
from listingmart.analogues import scans as _scans  # noqa: F401  (2.1)
from listingmart.analogues import composites as _composites  # noqa: F401  (2.13, 2.2)
from listingmart.analogues.registry import ORACLE, QUERIES, _iso_sql, with_iso_dates

# Date columns leave every registered query as ISO text (see ``registry.iso_date``).
for _k in list(QUERIES):
    QUERIES[_k] = (lambda f: lambda spark, sf: with_iso_dates(f(spark, sf)))(QUERIES[_k])
for _k in ["counter_to_delta_full", "counter_to_delta_incremental", "upsert_daily_metrics"]:
    ORACLE[_k] = _iso_sql(ORACLE[_k], ["day"])

__all__ = ["QUERIES", "ORACLE"]
