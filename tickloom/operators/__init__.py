"""Reusable DataFrame operators: parse, clean, de-duplicate, rank, key, join, write."""
