"""Reusable DataFrame shapes the plans are composed from."""
