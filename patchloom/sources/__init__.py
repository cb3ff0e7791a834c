"""Scans: tables, SQL text, CSV, image files and tiled rasters."""
