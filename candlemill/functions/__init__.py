"""Column expressions used by several operators; all of them run in the JVM."""
