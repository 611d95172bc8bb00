"""Whole jobs put together from operators and sources."""
