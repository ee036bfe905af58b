"""Readers and writers of ratings, features and run artefacts."""
