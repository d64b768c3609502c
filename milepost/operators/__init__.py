"""Relational operators on DataFrames: row picking, joins, aggregates, set operations."""
