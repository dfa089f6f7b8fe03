"""Readers: XML trees, dictionaries, rule lists, order packets."""
