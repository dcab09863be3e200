"""Training-data operators: deduplication, packing, mixing, classification and search."""
