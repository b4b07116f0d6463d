"""Readers, the event contract and parquet tables."""
