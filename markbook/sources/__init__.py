"""Sources (logical tables, stand-in views) and sinks."""

from .tables import Tables, catalog_tables, read_tables, with_user_column

__all__ = ["Tables", "catalog_tables", "read_tables", "with_user_column"]
