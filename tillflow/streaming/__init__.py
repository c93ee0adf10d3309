"""App events and raw files as streams."""
