"""Column expressions: money, dates, identifiers. All JVM built-ins, no Python UDF."""
