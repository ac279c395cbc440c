"""Column-level building blocks; everything here stays inside Spark's generated code."""
