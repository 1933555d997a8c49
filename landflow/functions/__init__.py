"""Column builders: every function maps Columns to a Column and runs in the JVM."""
