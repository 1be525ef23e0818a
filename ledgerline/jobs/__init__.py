"""Composite jobs (G1-G18): configuration + glue over the operators."""
