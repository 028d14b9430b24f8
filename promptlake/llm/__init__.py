"""Training-data operators: quality, extraction, deduplication, mixing, sharding.

Nothing else in the library imports this subpackage.
"""
