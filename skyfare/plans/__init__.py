"""Composed jobs built from the operators."""
