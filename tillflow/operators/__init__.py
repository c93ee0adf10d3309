"""Cleaning, star schema, loading and maintenance."""
