"""Operators over layers: ingest, tables, dedup, checks, lookups."""
