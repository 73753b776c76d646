"""Column functions: every one returns a Spark Column built from JVM expressions."""
