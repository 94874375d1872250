"""Whole jobs: the backfill of every layer, and training with evaluation."""
