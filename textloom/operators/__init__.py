"""textloom operators."""
