"""Column-level functions: typing, dates, keys and text."""
