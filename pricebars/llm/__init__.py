"""Operators for large text corpora: joins, search, scans, sharding, tokens."""
