"""Named queries over the driver's tables, and the DuckDB SQL that they are held against."""
