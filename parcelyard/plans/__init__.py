"""Whole jobs: the refresh, the reports and the quality profiles."""
