"""Compositions of operators: scoring, batch processing, reports."""
