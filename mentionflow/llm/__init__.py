"""Operators of a training-data pipeline. ``queries`` holds the thin queries and their SQL."""
