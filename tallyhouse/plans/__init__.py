"""Whole jobs: loading the star, computing the report, refreshing it."""
