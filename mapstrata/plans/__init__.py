"""Whole jobs (load, dedup, validate) and the registered queries."""
