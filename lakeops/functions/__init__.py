"""Column expressions; all of them are built-in functions evaluated in the JVM."""
