"""Retail analytics on Spark: clean sales drops, a star schema, app events and business queries."""
