"""Reusable joins, merges and ranks."""
