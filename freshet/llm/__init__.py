"""Training-data operators: sharding, scans, deduplication, tokens, archives and language models."""
