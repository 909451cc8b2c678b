"""Operators for training-data pipelines: search, deduplication, tokens, personal data, languages, archives, licences, packing."""
