"""Operators of a training-data pipeline: de-duplication, quality, tokens, packing, chat text."""
