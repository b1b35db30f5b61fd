"""Column expressions: numbers, text, dates and keys. All run JVM-side, there are no UDFs."""
