"""Reusable DataFrame operators: row quality, time intervals, keys and constraints."""
