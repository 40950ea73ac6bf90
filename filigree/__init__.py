"""Batch analytics over company snapshots and tagged filings, written as
PySpark DataFrame functions."""
