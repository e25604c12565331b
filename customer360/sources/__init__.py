"""Sources (parquet / JDBC tables, test adapters) and sinks (dated datasets)."""

from customer360.sources.tables import TableSet, read_jdbc, read_tables

__all__ = ["TableSet", "read_jdbc", "read_tables"]
