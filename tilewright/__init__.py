"""Spark jobs for chart catalogs and web-map tiles."""
