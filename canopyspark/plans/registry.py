"""Queries of the raster, geometry and record operators by name, and SQL for the same rows."""

from canopyspark.plans import mosaic_queries, raster_queries, record_queries

_ALL = raster_queries.QUERIES | mosaic_queries.QUERIES | record_queries.QUERIES
QUERIES = {name: query for name, (query, _) in _ALL.items()}
ORACLES = {name: sql for name, (_, sql) in _ALL.items() if sql}
