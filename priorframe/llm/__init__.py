"""Operators of a training-data pipeline: scoring, dedupe, sharding, mixing, tokens."""
