"""Operators of a training-data pipeline: filters, dedup, mixing, scoring and packing of documents."""
