"""Operators of a training-data pipeline: tokens, duplicates, languages, mixing, archives, secrets."""
