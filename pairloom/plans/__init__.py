"""Whole jobs, and the named queries with their SQL."""
