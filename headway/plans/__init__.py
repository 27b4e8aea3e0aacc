"""Metric aggregates, score assembly and the end-to-end analysis."""
