"""Operators for training-data pipelines: dedup, language, quality, licences, packing, chat."""
