"""Incremental forms of the scheduled append job."""
