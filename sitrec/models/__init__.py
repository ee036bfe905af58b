"""Factorization machines, ALS and the smaller learners."""
