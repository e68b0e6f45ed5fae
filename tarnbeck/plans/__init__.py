"""Whole plans: ingestion end to end, and the registered queries."""
