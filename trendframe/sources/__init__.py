from trendframe.sources.tables import Tables, normalise, read_tables, write_table, write_tables

__all__ = ["Tables", "normalise", "read_tables", "write_table", "write_tables"]
