"""Column functions: ``Column -> Column``, all built from Spark's own expressions."""
