"""Gold marts and regional analytics."""
