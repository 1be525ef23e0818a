"""Landed-file and JDBC readers, freshness gates and sinks."""
