"""Training-data operators: sharding, packing, deduplication, filters, language ID, token files."""
