"""Reading drops, writing tables and reports."""
