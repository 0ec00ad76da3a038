"""Checks of every operator on the driver's tables: input mapping, Spark queries, DuckDB twins."""
