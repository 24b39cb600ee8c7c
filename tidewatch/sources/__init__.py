"""Feeds, files, the broker and the schema registry."""
