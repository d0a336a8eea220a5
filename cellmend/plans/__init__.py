"""Registered queries: each one with the SQL that must give the same rows."""

from cellmend.plans.catalog import CATALOG, oracles, queries  # noqa: F401
from cellmend.plans import (  # noqa: F401  (importing registers the queries)
    integrity_queries, cell_queries, cleaning_queries, drift_queries,
    table_queries, inventory_queries, header_queries, file_queries, stream_queries,
)
