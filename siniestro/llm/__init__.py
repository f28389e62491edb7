"""Training-data operators: search, deduplication, scans, tokens, language models."""
