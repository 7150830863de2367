"""textloom functions."""
