"""DataFrame -> DataFrame operators (joins, dedupe, windows, lifecycle)."""
