"""Tallyhouse: a star schema and an incremental customer x month report on Spark."""
