"""Spark operators for the data work of a file, document and billing platform."""
