"""Operators of a training-data pipeline: scoring, filtering, joining, mixing and writing documents."""
