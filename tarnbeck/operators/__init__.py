"""Stages of ingestion, each a function from DataFrame to DataFrame."""
