"""Operators for preparing training text: filters, near-copies, mixing and token files."""
