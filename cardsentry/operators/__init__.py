"""Batch operators: each one is a function DataFrame(s) -> DataFrame."""
