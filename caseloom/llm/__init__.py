"""Operators for building training data: language, mixing, search, privacy, toxicity, dedup, tokens, packing."""
