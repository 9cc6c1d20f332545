"""Reading pages of raw JSON and reading and writing tables."""
