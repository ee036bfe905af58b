"""Recommendation flows built from the operators."""
