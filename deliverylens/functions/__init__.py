"""Column-level helpers. Every function returns a Column or a DataFrame built
only from built-in Spark SQL functions, so it stays inside whole-stage codegen."""
