"""Stores, merges and the daily pipelines."""
