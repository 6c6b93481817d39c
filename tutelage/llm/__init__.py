"""Operators of a training-data pipeline: packing, near duplicates, quality, archives, privacy, extraction.

Nothing outside this folder imports it.
"""
