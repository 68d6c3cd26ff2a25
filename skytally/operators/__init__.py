"""Dataset-level operators: quality, de-duplication, enrichment, dimensions, KPIs, profiles."""
