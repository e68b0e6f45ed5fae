"""Continuous arrival."""
