"""roadrisk: crash-risk analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers/writers (CSV, Parquet, GeoJSON) and the crash-shaped fixture view
functions  column-expression builders (coercion, severity, recodes, labels, geometry)
operators  DataFrame operators (cleaning, spatial join, DBSCAN, risk tables, ML, ...)
plans      registered report queries and their DuckDB oracle SQL
"""

__all__ = ["session"]
