"""Training-data operators: sharding, mixing, dedup, filtering, packing, extraction."""
