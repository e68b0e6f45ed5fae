"""Operators for building training corpora; nothing else in tarnbeck imports this package."""
