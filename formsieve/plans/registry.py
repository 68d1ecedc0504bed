"""All queries of the core and their SQL."""

from __future__ import annotations

from formsieve.plans import catalog, catalog_runs, catalog_stats, catalog_tables, oracle

QUERIES = {**catalog.QUERIES, **catalog_runs.QUERIES, **catalog_stats.QUERIES, **catalog_tables.QUERIES}
ORACLE_SQL = {**oracle.ORACLE_SQL, **catalog_runs.ORACLE_SQL, **catalog_stats.ORACLE_SQL, **catalog_tables.ORACLE_SQL}
