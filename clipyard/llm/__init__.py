"""Training-data operators: search, tokenisation, deduplication, scoring and packing."""
