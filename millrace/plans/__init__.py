"""Domain pipelines built from the operators."""
