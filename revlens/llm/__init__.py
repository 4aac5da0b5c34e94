"""Training-data pipeline operators (dedup, filtering, scoring, packing, token files)."""
