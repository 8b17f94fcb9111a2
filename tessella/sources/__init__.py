"""Rasters, archives, manifests and tile trees in; tiles, documents and folders out."""
