"""Structured Streaming sources and the micro-batch job."""
