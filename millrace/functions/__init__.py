"""Column functions and row normalisation."""
