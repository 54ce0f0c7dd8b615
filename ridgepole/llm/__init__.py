"""Operators of a training-data pipeline: search, sharding, dedup, counts, mixing, packing, chat."""
