"""Readers: mail files, Markdown files, JSON Lines."""
