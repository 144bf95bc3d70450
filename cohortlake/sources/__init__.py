"""Sources and sinks: parquet tables, the fixture adapter, full-refresh writes."""

from cohortlake.sources.sink import overwrite_catalog_table, overwrite_table
from cohortlake.sources.tables import CatalogTables, JdbcTables, TableSet, read_table, read_tables

__all__ = ["CatalogTables", "JdbcTables", "TableSet", "overwrite_catalog_table", "overwrite_table", "read_table",
           "read_tables"]
