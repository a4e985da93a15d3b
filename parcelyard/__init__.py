"""Spark jobs that turn dirty logistics extracts into checked tables and reports."""
