"""Column functions: no row leaves the JVM, but for HTML entities."""
