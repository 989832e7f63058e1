"""Column expressions: casts, document checks, pseudonyms and derived measures."""
