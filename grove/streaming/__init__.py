"""Scoring unbounded tables."""
