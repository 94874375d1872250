"""Operators for preparing training text: near-duplicate joins, tokenising, filters, packing, sharding, search."""
