"""Incremental processing of arriving records."""
