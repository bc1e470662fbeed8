"""Column functions: everything here maps columns to columns, on the JVM."""
