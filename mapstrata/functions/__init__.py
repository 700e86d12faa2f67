"""Column functions: geometry, projection, tolerant casts, source text."""
