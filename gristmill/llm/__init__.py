"""Operators of a training-data pipeline: dedupe, quality, sharding, archives, tokens, secrets."""
