"""Views over the given tables in the shapes the operators expect, and the registered queries with their SQL checks."""
