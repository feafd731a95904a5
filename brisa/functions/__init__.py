"""Column expressions: time, text, numbers and binning. All of them stay inside the JVM."""
