"""Column builders. Each returns an expression of built-in functions; none is a UDF."""
