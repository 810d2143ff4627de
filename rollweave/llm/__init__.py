"""Training-data operators: extraction, dedup, mixing, scoring, tokenising and search."""
