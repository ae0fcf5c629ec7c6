"""Column expressions: every function here takes and returns Columns and stays in the JVM."""
