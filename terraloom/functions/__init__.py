"""Column-level building blocks: every function takes and returns Spark columns."""
