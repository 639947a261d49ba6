"""Column expressions shared by the operators (all built-in Spark SQL functions, no Python UDF)."""
