"""Column-level helpers: dates, report windows, text and numbers."""
