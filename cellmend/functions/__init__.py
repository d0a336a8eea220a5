"""Column expressions: classifiers, cleaners, normalisers, semantic types."""
