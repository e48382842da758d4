"""Column expressions: Column in, Column out, all evaluated on the JVM."""
