"""Compositions: Silver, Gold, run documents and the batch itself."""
