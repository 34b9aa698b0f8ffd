"""Operators for preparing training data, as Spark jobs. Nothing outside this package imports it."""
