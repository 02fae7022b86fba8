"""Column-level functions; all are built-in expressions, none is a UDF."""
