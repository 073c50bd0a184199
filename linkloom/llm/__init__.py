"""Operators for training-data pipelines: linkage without keys, tokens, mixes and sentences."""
