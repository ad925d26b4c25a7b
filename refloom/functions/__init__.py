"""Scalar functions as Column expressions, with Arrow UDFs only where Spark has no primitive."""
