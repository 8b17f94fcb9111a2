"""Stateful assembly of seam tiles and running request totals."""
