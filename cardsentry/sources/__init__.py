"""Readers and writers: driver tables, JSON landing zones, versioned Parquet tables."""
