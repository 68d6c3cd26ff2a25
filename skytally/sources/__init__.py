"""Readers: landed feeds, reference files, lake tables, run documents and job logs."""
