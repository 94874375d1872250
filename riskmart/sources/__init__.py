"""Snapshot calendar, storage of snapshot tables, and scratch space on the shared folder."""
