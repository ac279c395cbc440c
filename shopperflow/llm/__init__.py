"""Operators for preparing training text: near copies, repeated passages, quality, personal data, tokens."""
