"""Operators over DataFrames that hold all snapshots at once."""
