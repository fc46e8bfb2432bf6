"""Training-data operators: packing, sharding, secrets, search, toxicity, quality, mixing, near and substring duplicates.

Nothing else in the library imports this subpackage.
"""
