"""Whole programs built from the operators, and the queries the driver runs."""
