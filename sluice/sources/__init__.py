"""Sources: CSV files, catalog tables, JDBC, and the provided test tables."""

from sluice.sources.files import append_new_files, land_orders_csv, read_catalog_table, read_orders_csv, with_provenance, write_orders_csv
from sluice.sources.jdbc import jdbc_options, postgres_url, read_jdbc, read_postgres

__all__ = [
    "append_new_files",
    "jdbc_options",
    "land_orders_csv",
    "postgres_url",
    "read_catalog_table",
    "read_jdbc",
    "read_orders_csv",
    "read_postgres",
    "with_provenance",
    "write_orders_csv",
]
