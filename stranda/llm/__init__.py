"""Training-data operators: extraction, deduplication, scanning, encoding, packing and sharding.

Nothing else in the library imports this subpackage.
"""
