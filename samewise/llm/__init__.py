"""Training-data operators: tokens, dedup, quality, scans, packing, language models.

Nothing else in the library imports this subpackage.
"""
