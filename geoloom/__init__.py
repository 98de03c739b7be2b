"""Geospatial siting, coverage and patch-dataset analytics as Spark DataFrame jobs."""
