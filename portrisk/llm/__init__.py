"""Operators and pipeline for preparing training text."""
