"""Column functions: ``Column -> Column``, built-in expressions only."""
