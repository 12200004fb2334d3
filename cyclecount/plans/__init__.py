"""Composed plans: the demo inputs, the registered queries and their SQL oracles."""
