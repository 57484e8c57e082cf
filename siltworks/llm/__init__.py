"""Training-data operators: scoring, deduplication, filtering, formatting and packing."""
