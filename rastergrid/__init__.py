"""Raster tile, catalog and grid analytics expressed as Spark DataFrames."""
