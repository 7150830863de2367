"""textloom sources."""
