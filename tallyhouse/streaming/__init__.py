"""Incremental landing and the marts kept up to date by it."""
