"""Column expressions; all of them stay inside the JVM."""
