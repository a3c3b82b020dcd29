"""Exhaustive, accountable reading of capped sources, as DataFrame transformations."""
