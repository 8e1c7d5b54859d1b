"""Code graphs and change events as Spark tables."""
