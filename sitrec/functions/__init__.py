"""Column helpers that stay inside Catalyst."""
