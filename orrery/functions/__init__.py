"""functions."""
