"""Transit performance analytics as plain Spark DataFrame functions."""
