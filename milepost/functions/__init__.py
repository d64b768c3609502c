"""Scalar column expressions: dates, text, statistics and rule combinators."""
