"""Operators over sheets, tiles, pixels and requests."""
