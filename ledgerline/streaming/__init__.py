"""Structured Streaming entry points for landing folders."""
