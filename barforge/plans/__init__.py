"""Registered plans over the driver's tables (``catalog``) and their DuckDB
twins (``oracle``)."""
