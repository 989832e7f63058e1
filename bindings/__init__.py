"""The operators bound to the given tables, each next to its independent SQL."""
