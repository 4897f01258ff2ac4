"""Operators Spark does not ship as one call: exact distributed NTILE and
the data-quality checks (unique keys, relation profile)."""
