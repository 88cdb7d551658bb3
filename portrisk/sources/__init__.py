"""Feeds, raw days, curated tables and their control rows."""
