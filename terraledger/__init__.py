"""Geospatial capacity analytics as Spark DataFrame operators."""
