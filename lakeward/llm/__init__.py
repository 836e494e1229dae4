"""Operators for training-data pipelines: scans, extraction, search,
fingerprints, near-duplicates, packing, language, mixing, archives, toxicity.

Nothing else in the library imports this subpackage.
"""
