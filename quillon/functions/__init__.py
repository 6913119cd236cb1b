"""Column functions: each takes and gives Columns and stays in the JVM."""
