"""Column functions: cleaning, conversion and small formulas. All are JVM expressions."""
