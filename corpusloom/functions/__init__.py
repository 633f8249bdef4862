"""Column functions: everything stays inside the JVM."""
