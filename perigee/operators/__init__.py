"""Reusable DataFrame operators and the three feed extractors."""
