"""Readers, line parsers, result writers and saved models."""
