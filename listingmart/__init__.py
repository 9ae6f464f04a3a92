"""listingmart: a Spark-native batch engine for multi-source job-listing data.

Landed JSON pages are flattened, de-duplicated, keyed, translated and
standardised, upserted into date-partitioned staging tables, split into a
star schema (dimensions with unknown members, a fact, many-to-many bridges, a
daily counter fact) and published as gold views and stored summaries.

Everything is DataFrame / SQL expressions, so Catalyst prunes, pushes down and
plans the shuffles; no per-row Python functions are used.
"""

from listingmart.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
